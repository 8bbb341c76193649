"""Continuous periods and the gaps between them, per entity.

The operator keeps an ordered map of disjoint intervals in keyed state; each
insertion finds its overlaps by binary search, merges them and mends the gaps
beside them. It is folded twice.

First a key of the state is an entity *and* a stretch of time (``bucket_seconds``
of the start), so that an entity with a third of all rows is many keys. Input
partitions fold their own rows before the shuffle, so what is shuffled for a key is at
most one list of disjoint intervals per input partition, and a key never holds more
than ``bucket_seconds / 2`` intervals, whatever the number of rows.

Then the stretches of an entity are put, in the order of time, into one map with its
gaps. What ended before the stretch at hand can't change any more and leaves the map as it
goes, so the map holds a stretch or two; an entity has as many stretches as the calendar has, not as many as it has rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a fold before the shuffle takes in before it passes its maps on.
HELD = 200_000


class IntervalMap:
    """Disjoint intervals in order; intervals that overlap or touch are one."""

    __slots__ = ("ends", "starts")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        self.starts: list[int] = starts if starts is not None else []
        self.ends: list[int] = ends if ends is not None else []

    def insert(self, start: int, end: int) -> None:
        """Add [start, end]: what it overlaps or touches lies between two binary searches."""
        starts, ends = self.starts, self.ends
        if not ends or start > ends[-1]:
            starts.append(start)
            ends.append(end)
            return
        low = bisect_left(ends, start)
        high = bisect_right(starts, end)
        if low < high:
            start, end = min(start, starts[low]), max(end, ends[high - 1])
        starts[low:high] = [start]
        ends[low:high] = [end]

    def __len__(self) -> int:
        return len(self.starts)


class GapMap(IntervalMap):
    """An interval map that also keeps the gaps: ``gaps[i]`` lies between the intervals i and i + 1."""

    __slots__ = ("gaps",)

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        super().__init__(starts, ends)
        self.gaps: list[tuple[int, int]] = list(zip(self.ends, self.starts[1:], strict=False))

    def insert(self, start: int, end: int) -> None:
        """Add [start, end]; of the gaps only those beside it change."""
        starts, ends = self.starts, self.ends
        if not ends or start > ends[-1]:
            if ends:
                self.gaps.append((ends[-1], start))
            starts.append(start)
            ends.append(end)
            return
        low = bisect_left(ends, start)
        high = bisect_right(starts, end)
        if low < high:
            start, end = min(start, starts[low]), max(end, ends[high - 1])
        starts[low:high] = [start]
        ends[low:high] = [end]
        beside = [(ends[low - 1], start)] if low else []
        if low + 1 < len(starts):
            beside.append((end, starts[low + 1]))
        self.gaps[max(low - 1, 0) : high] = beside

    def settled(self, before: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Takes out and gives the periods, and the gaps after them, that no insertion from ``before`` on can touch. The last period always stays.

        What is in the map must have started before ``before``, so that the period after a gap that is given can't come to start earlier.
        """
        count = min(bisect_left(self.ends, before), len(self.ends) - 1) if self.ends else 0
        periods, gaps = list(zip(self.starts[:count], self.ends[:count], strict=True)), self.gaps[:count]
        del self.starts[:count], self.ends[:count], self.gaps[:count]
        return periods, gaps


_SCHEMA = pa.schema([("key", pa.string()), ("bucket", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
_DDL = "key string, bucket bigint, starts array<bigint>, ends array<bigint>"


def _batch(maps: list[tuple[tuple[str, int], IntervalMap]]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([k[0] for k, _ in maps], pa.string()),
            pa.array([k[1] for k, _ in maps], pa.int64()),
            pa.array([m.starts for _, m in maps], pa.list_(pa.int64())),
            pa.array([m.ends for _, m in maps], pa.list_(pa.int64())),
        ],
        schema=_SCHEMA,
    )


def _fold_rows(bucket_seconds: int):
    """Rows of one input partition, in any order, to a map per key."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], IntervalMap] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for key, start, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at = (key, start // bucket_seconds)
                kept = held.get(at)
                if kept is None:
                    held[at] = IntervalMap([start], [end])
                else:
                    kept.insert(start, end)
            if rows > HELD:
                yield _batch(list(held.items()))
                held, rows = {}, 0
        if held:
            yield _batch(list(held.items()))

    return fold


def _fold_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maps sorted by key to one map per key; one key is in memory at a time."""
    now: tuple[str, int] | None = None
    kept = IntervalMap()
    done: list[tuple[tuple[str, int], IntervalMap]] = []
    for batch in batches:
        for key, bucket, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (key, bucket) != now:
                if now is not None:
                    done.append((now, kept))
                now, kept = (key, bucket), IntervalMap(starts, ends)
            else:
                for start, end in zip(starts, ends, strict=True):
                    kept.insert(start, end)
        if len(done) > 5000:
            yield _batch(done)
            done = []
    if now is not None:
        done.append((now, kept))
    if done:
        yield _batch(done)


_OUT = pa.schema([("key", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _join_stretches(bucket_seconds: int):
    """Stretches sorted by key and bucket to periods and gaps; a stretch or two of one key are in memory at a time."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, GapMap()
        keys: list[str] = []
        kinds: list[str] = []
        starts: list[int] = []
        ends: list[int] = []

        def give(key: str, kind: str, some: list[tuple[int, int]]) -> None:
            keys.extend([key] * len(some))
            kinds.extend([kind] * len(some))
            starts.extend(s for s, _ in some)
            ends.extend(e for _, e in some)

        def close() -> None:
            give(now, "period", list(zip(kept.starts, kept.ends, strict=True)))
            give(now, "gap", kept.gaps)

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(keys, pa.string()), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], schema=_OUT)

        for part in batches:
            for key, bucket, ss, es in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                if key != now:
                    if now is not None:
                        close()
                    now, kept = key, GapMap(ss, es)
                else:
                    periods, gaps = kept.settled(bucket * bucket_seconds)
                    give(key, "period", periods)
                    give(key, "gap", gaps)
                    for start, end in zip(ss, es, strict=True):
                        kept.insert(start, end)
            if len(keys) > 50_000:
                yield batch()
                for x in (keys, kinds, starts, ends):
                    x.clear()
        if now is not None:
            close()
        if keys:
            yield batch()

    return fold


def fold_partitions(df: DataFrame, key: str, start: str, end: str, bucket_seconds: int) -> DataFrame:
    """``key, bucket, starts, ends``: the disjoint intervals of a key and stretch in each input partition; nothing is shuffled."""
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    return rows.where("key is not null and s is not null and e is not null and e >= s").mapInArrow(_fold_rows(bucket_seconds), _DDL)


def periods_and_gaps(df: DataFrame, key: str, start: str, end: str, bucket_seconds: int = 86_400) -> DataFrame:
    """``key, kind, start, end`` with kind ``period`` or ``gap``.

    ``key`` is text, ``start`` and ``end`` are whole seconds. Rows with a null in
    any of the three and rows whose end is before their start count for nothing;
    repeated rows change nothing; other columns are not read. An entity with one
    period has no gap; an empty table gives an empty result.
    """
    folded = fold_partitions(df, key, start, end, bucket_seconds)
    stretches = folded.repartition("key", "bucket").sortWithinPartitions("key", "bucket").mapInArrow(_fold_maps, _DDL)
    return stretches.repartition("key").sortWithinPartitions("key", "bucket").mapInArrow(_join_stretches(bucket_seconds), "key string, kind string, start bigint, end bigint")
