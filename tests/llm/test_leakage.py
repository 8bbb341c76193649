import random

import numpy as np
import pytest

from fareloom.llm.leakage import PASSAGE, RUN, STRIDES, ItemIndex, WindowIndex, _Hashes, blocks_of, fingerprints, leaked_items, words_of

BASE = [f"w{i}" for i in range(400)]


def brute(docs, items):
    out = set()
    for d, text in docs:
        words = words_of(text)
        runs = {tuple(words[i : i + RUN]) for i in range(len(words) - RUN + 1)}
        long = {tuple(words[i : i + PASSAGE]) for i in range(len(words) - PASSAGE + 1)}
        for q, item in items:
            own = words_of(item)
            r = {tuple(own[i : i + RUN]) for i in range(len(own) - RUN + 1)}
            p = {tuple(own[i : i + PASSAGE]) for i in range(len(own) - PASSAGE + 1)}
            if d is not None and q is not None and r and (p & long or len(r & runs) * 2 >= len(r)):
                out.add((d, q))
    return out


def case(seed):
    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choices(BASE, k=rnd.randint(3, 60)))) for i in range(25)] + [(98, ""), (99, None)]
    docs = []
    for d in range(150):
        words = rnd.choices(BASE, k=rnd.randint(0, 60))
        if d % 2:
            own = words_of(rnd.choice(items[:25])[1])
            at, size = rnd.randrange(len(own)), rnd.choice([6, 11, 12, 13, 40])
            part = own[at : at + size]
            if d % 3 == 0:
                part = [x for i, x in enumerate(own) if i % rnd.choice([7, 9, 11, 30])]
            cut = rnd.randint(0, len(words))
            words[cut:cut] = part
        docs.append((d, " ".join(x.upper() if d % 5 == 0 else x for x in words)))
    docs += [(500, None), (501, ""), (502, "   "), (None, items[0][1]), (503, items[3][1]), (503, items[3][1])]
    return docs, items


@pytest.mark.parametrize("limit", [32_000_000, 900])
def test_same_pairs_as_brute_force(spark, limit):
    docs, items = case(limit)
    d = spark.createDataFrame([(a, t, "x") for a, t in docs], "doc_id bigint, text string, item_id string").repartition(3)
    i = spark.createDataFrame([(a, t, 1) for a, t in items], "item_id bigint, text string, doc_id int")
    got = [tuple(r) for r in leaked_items(d, i, most_chars=limit).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items)
    assert leaked_items(d.limit(0), i, most_chars=limit).count() == 0
    assert leaked_items(d, i.limit(0), most_chars=limit).count() == 0


def test_every_print_within_the_radius_is_found():
    rnd = np.random.default_rng(1)
    index = WindowIndex(rnd.integers(0, 2**63, 600, dtype=np.uint64), rnd.integers(0, 20, 600))
    some = index.prints[rnd.integers(0, len(index.prints), 500)]
    for flips in range(5):
        moved = some.copy()
        for n in range(len(moved)):
            for bit in rnd.choice(64, flips, replace=False):
                moved[n] ^= np.uint64(1) << np.uint64(bit)
        at, _ = index.candidates(moved)
        near = [(np.bitwise_count(index.prints ^ m) <= 3).sum() for m in moved]
        assert np.array_equal(np.bincount(at, minlength=500) > 0, np.array(near) > 0)


@pytest.mark.parametrize("size", [19, 20, 47, 90, 170, 900])
def test_a_whole_item_lies_under_a_window_wherever_it_stands(size):
    rnd = random.Random(size)
    item = [f"i{n}" for n in range(size)]
    index = ItemIndex([(5, " ".join(item))])
    (stride,) = index.windows
    assert stride in STRIDES and 5 * stride - 1 <= size
    hashes = _Hashes()
    for before in range(2 * stride):
        words = rnd.choices(BASE, k=before) + item + rnd.choices(BASE, k=30)
        found = index.pairs(np.array([hashes[w] for w in words], dtype=np.uint64), np.zeros(len(words), dtype=np.int64), ("windows",))
        assert found.tolist() == [0]


def test_the_ways_alone_and_rare_runs(spark):
    item = [f"i{n}" for n in range(60)]
    common = [f"c{n}" for n in range(60)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(common + item[:20])), (3, " ".join(common + item[20:40])), (4, " ".join(common + item[40:]))], "item_id bigint, text string")
    docs = spark.createDataFrame([(10, " ".join(item)), (11, " ".join(item[:14])), (12, " ".join(common[:10] + ["x"] + common[10:20]))], "doc_id bigint, text string")
    pairs = lambda **x: {tuple(r) for r in leaked_items(docs, items, **x).collect()}
    every = {(10, 1), (10, 2), (10, 3), (10, 4), (11, 1), (11, 2)}
    assert pairs() == pairs(ways=("anchors",)) == every
    assert pairs(ways=("windows",)) == {(10, 1)}
    assert pairs(rare=True) == every


def test_forty_thousand_items_take_one_scan(spark):
    rows = [(i, " ".join(f"v{i}q{n}" for n in range(12))) for i in range(40_000)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, "so it goes and " + rows[i * 7][1] + " then on") for i in range(300)] + [(999, "nothing of it is in here at all")], "doc_id bigint, text string")
    found = leaked_items(docs, items, most_chars=800_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == plan.count("Scan ExistingRDD") == 1
    assert {tuple(r) for r in found.collect()} == {(i, i * 7) for i in range(300)}


def test_items_that_share_a_run_do_not_pile_up():
    shared = " ".join(f"s{n}" for n in range(8))
    index = ItemIndex([(i, f"{shared} a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}") for i in range(3000)])
    hashes = _Hashes()
    words = (shared + " x").split() * 4000
    doc = np.repeat(np.arange(4000), 9)
    assert len(index.pairs(np.array([hashes[w] for w in words], dtype=np.uint64), doc)) == 0


def test_blocks_cover_all_bits():
    prints = np.array([0x0123456789ABCDEF], dtype=np.uint64)
    assert [int(b[0]) for b in blocks_of(prints, 3)] == [0xCDEF, 0x89AB, 0x4567, 0x0123]


def test_words():
    assert words_of("Dur­ante 2⁠4 ＡＢＣ ﬁn_x") == ["durante", "24", "abc", "fin", "x"]
    assert words_of(None) == [] and len(fingerprints(np.empty(0, dtype=np.uint64), 4)) == 0


def test_a_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(40))
    filler = " ".join(f"f{i % 5000}" for i in range(320_000))
    docs = spark.createDataFrame([(1, filler + " " + item), (2, filler)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    assert [tuple(r) for r in leaked_items(docs, items).collect()] == [(1, 7)]
