import math

import numpy as np
import pytest

from fareloom.llm.quantiles import Sketch, combine, estimates, sketch_groups

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def off(values, estimate, share):
    """How many ranks an estimate is away from its share."""
    rank = max(1, math.ceil(share * len(values) - 1e-9))
    return max(0, (values < estimate).sum() + 1 - rank, rank - (values <= estimate).sum())


@pytest.mark.parametrize("size,width", [(16, 2), (16, 3), (64, 8)])
@pytest.mark.parametrize("kind", ["random", "sorted", "reversed", "ties", "lumps"])
def test_bound_holds(size, width, kind):
    rnd = np.random.default_rng(1)
    v = rnd.normal(size=20_000)
    v = {"random": v, "sorted": np.sort(v), "reversed": np.sort(v)[::-1], "ties": rnd.integers(0, 3, 20_000).astype(float), "lumps": np.concatenate([np.full(9000, 1.0), v[:11_000]])}[kind]
    sketch = Sketch(size, width)
    for part in np.array_split(v, 37):
        sketch.add(part.copy())
    found, error = sketch.quantiles(SHARES)
    assert sketch.count == len(v)
    assert error < len(v) * (math.log(len(v) / size, width) + 2) / size
    for s, f in zip(SHARES, found, strict=True):
        assert off(v, f, s) <= error


def test_merged_sketches_keep_their_bound():
    rnd = np.random.default_rng(2)
    every, whole = [], Sketch(32, 4)
    for i in range(25):
        v = rnd.normal(i, 3, size=rnd.integers(1, 3000))
        every.append(v)
        part = Sketch(32, 4)
        part.add(v)
        levels, buffers, loose, *rest = part.row()
        whole.merge(levels, buffers, loose, *rest)
    v = np.concatenate(every)
    found, error = whole.quantiles(SHARES)
    assert whole.count == len(v) and whole.low == v.min() and whole.high == v.max()
    assert max(off(v, f, s) for s, f in zip(SHARES, found, strict=True)) <= error < 0.2 * len(v)


def test_few_values_are_exact():
    s = Sketch()
    s.add(np.array([3.0, 1.0, 2.0]))
    assert s.quantiles([0.0, 0.5, 1.0]) == ([1.0, 2.0, 3.0], 0)


def test_groups_over_partitions_and_their_combination(spark):
    rnd = np.random.default_rng(3)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"g{i % 7}", i % 4, float(x)) for i, x in enumerate(rnd.normal(size=6000))]
    rows += [("hot", 0, None), ("hot", 0, float("nan")), ("hot", 0, float("inf")), ("only bad", 1, float("-inf"))]
    df = spark.createDataFrame(rows, "g string, load int, value double").repartition(9).withColumnsRenamed({"g": "grp"})
    sketches, nodes = sketch_groups(df, "concat_ws('/', grp, load)", "value", 64, 4)
    assert nodes == 9
    per_load = combine(sketches, "grp", nodes, 64, 4)
    every = combine(per_load.selectExpr("grp", "cast(element_at(split(grp, '/'), -1) as bigint) node", "levels", "buffers", "loose", "count", "error", "low", "high"), "substring_index(grp, '/', 1)", 4, 64, 4)
    got = {r.grp: r for r in estimates(every.where("grp not in ('0','1','2','3')"), SHARES, 64, 4).collect()}
    data = {}
    for g, _, v in rows:
        if g and v is not None and math.isfinite(v):
            data.setdefault(g, []).append(v)
    assert set(got) == set(data)
    for g, values in data.items():
        v = np.array(values)
        assert got[g].n == len(v) and got[g].low == v.min()
        assert max(off(v, f, s) for s, f in zip(SHARES, got[g].found, strict=True)) <= got[g].rank_error
    assert estimates(combine(sketch_groups(df.limit(0), "grp", "value")[0], "grp", 1), [0.5]).count() == 0


def test_many_nodes_use_a_tree(spark):
    df = spark.range(0, 40_000, 1, 150).selectExpr("'a' as grp", "double(id) as v")
    sketches, nodes = sketch_groups(df, "grp", "v")
    got = estimates(combine(sketches, "grp", nodes), [0.5]).collect()
    assert nodes == 150 and len(got) == 1 and got[0].n == 40_000
    assert abs(got[0].found[0] - 20_000) <= got[0].rank_error + 1
