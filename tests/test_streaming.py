import random

import pandas as pd
import pytest

from fareloom.operators.intervals import periods_and_gaps
from fareloom.streaming.periods import current_periods, fold_batch, stream_periods


@pytest.mark.parametrize("bucket", [700, 100_000])
def test_stream_ends_where_the_batch_does(spark, tmp_path, bucket):
    rnd = random.Random(9)
    parts = []
    for _ in range(3):
        parts.append([(rnd.choice(["a", "b"]), s := rnd.randrange(5000), s + rnd.randrange(120)) for _ in range(150)])
    parts[2] += parts[0][:50] + [(None, 1, 2), ("a", None, 3), ("a", 9, 1)]
    schema = "k string, s bigint, e bigint"
    seen = []

    def sink(df, batch):
        seen.extend((batch, *r) for r in df.collect())

    source, check = tmp_path / "in", tmp_path / "check"
    source.mkdir()
    stream = spark.readStream.schema(schema).parquet(str(source))
    query = stream_periods(stream, "k", "s", "e", bucket).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(check)).start()
    try:
        for i, part in enumerate(parts):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
            for f in (tmp_path / f"w{i}").glob("*.parquet"):
                f.rename(source / f"{i}-{f.name}")
            query.processAllAvailable()
    finally:
        query.stop()
    changes = spark.createDataFrame(seen, "batch bigint, key string, change string, kind string, start bigint, end bigint")
    every = spark.createDataFrame([r for p in parts for r in p], schema)
    for kind in ("period", "gap"):
        want = {(r.key, r.start, r.end) for r in periods_and_gaps(every, "k", "s", "e", bucket).where(f"kind = '{kind}'").collect()}
        assert {tuple(r) for r in current_periods(changes, kind).collect()} == want
    assert len({b for b, *_ in seen}) == 3


class State:
    def __init__(self):
        self.exists, self.get = False, None

    def update(self, new):
        self.exists, self.get = True, new


def changes(fold, state, *rows):
    frame = pd.DataFrame({"starts": [[s] for s, _ in rows], "ends": [[e] for _, e in rows]})
    return [tuple(r) for part in fold(("k",), iter([frame]), state) for r in part.itertuples(index=False)]


def test_periods_across_midnight_are_one_and_gaps_change():
    fold, state = fold_batch(None), State()
    first = changes(fold, state, (86_300, 86_500), (172_700, 172_900), (259_300, 259_400))
    assert ("k", "put", "gap", 86_500, 172_700) in first and len(first) == 5
    assert changes(fold, state, (86_450, 86_600)) == [
        ("k", "drop", "gap", 86_500, 172_700), ("k", "drop", "period", 86_300, 86_500), ("k", "put", "gap", 86_600, 172_700), ("k", "put", "period", 86_300, 86_600),
    ]
    assert changes(fold, state, (86_600, 172_700)) == [
        ("k", "drop", "gap", 86_600, 172_700), ("k", "drop", "period", 86_300, 86_600), ("k", "drop", "period", 172_700, 172_900), ("k", "put", "period", 86_300, 172_900),
    ]
    assert changes(fold, state, (172_000, 172_001)) == []


def test_what_ended_long_ago_can_be_forgotten():
    fold, state = fold_batch(1000), State()
    changes(fold, state, (0, 10), (20, 30), (5000, 5010))
    assert state.get == ([5000], [5010], 4010)
    assert changes(fold, state, (25, 40), (4500, 4600)) == [("k", "put", "gap", 4600, 5000), ("k", "put", "period", 4500, 4600), ("k", "late", "period", 25, 40)]
