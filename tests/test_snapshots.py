import random

from fareloom.operators.snapshots import BITS, snapshot_changes, snapshot_residues


def test_same_as_comparing_dicts(spark):
    rnd = random.Random(3)
    snaps = {}
    for g in ("A", "B", None):
        state = {f"d{i}": (f"t{i}", "m1") for i in range(30)}
        for v in sorted(rnd.sample(range(1, 12), 5)):
            for k in rnd.sample(sorted(state), 4):
                state[k] = (rnd.choice(["t1", None, "t9"]), rnd.choice(["m1", "m2", None]))
            for k in rnd.sample(sorted(state), 2):
                del state[k]
            state[f"d{rnd.randrange(60)}"] = ("t0", "m0")
            snaps[g, v] = dict(state)
    rows = [(g, v, k, t, m, rnd.random(), "x") for (g, v), s in snaps.items() for k, (t, m) in s.items()]
    rows += [(g, v, k, t, m, 0.5, "y") for g, v, k, t, m, _, _ in rows[::3]] + [("A", 1, None, "t", "m", 0.1, "x")]
    df = spark.createDataFrame(rows, "g string, version int, k string, t string, m string, pay double, change string").repartition(3)
    plain = df.where("g is not null and k is not null").select("g", "version", "k", "t", "m").distinct()
    residues = {tuple(r) for r in snapshot_residues(df, ["g"], "version", "k", ["t", "m"]).collect()}
    for g in ("A", "B"):
        versions = sorted({r.version for r in df.where(f"g = '{g}'").select("version").distinct().collect()})
        for a, b in zip(versions, versions[1:], strict=False):
            old, new = (plain.where(f"g = '{g}' and version = {v}").select("k", "t", "m") for v in (a, b))
            assert {tuple(r) for r in new.exceptAll(old).collect()} == {r[2:5] for r in residues if r[:2] == (g, b) and r[5] == "new"}
            assert {tuple(r) for r in old.exceptAll(new).collect()} == {r[2:5] for r in residues if r[:2] == (g, b) and r[5] == "old"}
    got = {(r.g, r.version, r.k, r.change) for r in snapshot_changes(df, ["g"], "version", "k", ["t", "m"]).collect()}
    want = set()
    snaps.setdefault(("A", 1), {})
    for g in ("A", "B"):
        versions = sorted(v for q, v in snaps if q == g)
        for a, b in zip(versions, versions[1:], strict=False):
            old, new = snaps[g, a], snaps[g, b]
            for k in old.keys() | new.keys():
                if old.get(k) != new.get(k):
                    want.add((g, b, k, "added" if k not in old else "removed" if k not in new else "changed"))
    assert {x for x in got if x[0]} == want


def test_contradicting_rows_nulls_and_empty(spark):
    df = spark.createDataFrame([("A", 1, "a", "x"), ("A", 2, "a", "x"), ("A", 2, "a", "y"), ("A", 5, "b", None), ("A", 5, "a", "y"), ("A", 5, "a", "x"), ("A", 7, None, "z")], "g string, v int, k string, c string")
    got = sorted((r.version, r.k, r.change) for r in snapshot_changes(df, ["g"], "v", "k", ["c"]).collect())
    assert got == [(2, "a", "changed"), (5, "b", "added"), (7, "a", "removed"), (7, "b", "removed")]
    assert snapshot_changes(df.limit(0), ["g"], "v", "k", ["c"]).count() == 0
    assert snapshot_changes(df.where("v = 1"), ["g"], "v", "k", ["c"]).count() == 0


def test_more_snapshots_than_one_number_holds(spark):
    many = 3 * BITS + 7
    rows = [("A", v, "steady", "x") for v in range(many)] + [("A", v, "odd", "x") for v in range(1, many, 2)] + [("A", v, "moves", f"{v // BITS}") for v in range(many)]
    df = spark.createDataFrame(rows, "g string, v int, k string, c string")
    got = {(r.version, r.k, r.change) for r in snapshot_changes(df, ["g"], "v", "k", ["c"]).collect()}
    want = {(v, "odd", "added" if v % 2 else "removed") for v in range(1, many)} | {(v, "moves", "changed") for v in range(BITS, many, BITS)}
    assert got == want
