"""Percentiles of very large columns by deterministic buffer collapsing.

A sketch holds sorted buffers of ``size`` values with a weight each. Values fill a
buffer of weight 1; as soon as ``width`` buffers of one level are there, they are
merged, each value standing for its weight, and ``size`` evenly spaced positions are
kept as one buffer of the next level, which weighs ``width`` times as much. A collapse
that gives weight w moves no rank by more than w / 2, so the sketch adds up a bound
that always holds: for n values about n * log(n / size, width) / (2 * size). Nothing is drawn at random.

Sketches of partitions, loads or days combine in the same way and add their bounds,
so a result over all loads is made from the loads' stored sketches, not from rows.
Sketches are combined along a tree, so that no task receives more than a bounded
number of them, however many partitions a hot group is spread over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values per buffer and buffers per collapse. The relative rank error is below 0.4 % up to 10^9 values.
SIZE, WIDTH = 1024, 8
#: Values held by a task before it passes its sketches on, and sketches combined by one group of a tree level.
HELD, FAN_IN = 4_000_000, 64


class Sketch:
    """Weighted sorted buffers of one group."""

    __slots__ = ("count", "error", "high", "levels", "loose", "low", "pending", "size", "turn", "width")

    def __init__(self, size: int = SIZE, width: int = WIDTH) -> None:
        self.size, self.width = size, width
        self.levels: list[list[np.ndarray]] = []
        self.loose: list[np.ndarray] = []
        self.pending = self.count = self.error = self.turn = 0
        self.low, self.high = math.inf, -math.inf

    def add(self, values: np.ndarray) -> None:
        """Add finite values, in any order."""
        if not len(values):
            return
        self.count += len(values)
        self.low, self.high = min(self.low, float(values.min())), max(self.high, float(values.max()))
        self._fill(values)

    def _fill(self, values: np.ndarray) -> None:
        self.loose.append(values)
        self.pending += len(values)
        if self.pending >= self.size:
            every = np.concatenate(self.loose)
            whole = len(every) // self.size * self.size
            for buffer in np.sort(every[:whole].reshape(-1, self.size), axis=1):
                self._put(buffer, 0)
            self.loose, self.pending = [every[whole:]], len(every) - whole

    def _put(self, buffer: np.ndarray, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(buffer)
        if len(self.levels[level]) >= self.width:
            full, self.levels[level] = self.levels[level], []
            self._put(self._collapse(full, self.width ** (level + 1)), level + 1)

    def _collapse(self, buffers: list[np.ndarray], weight: int) -> np.ndarray:
        """Equal weights: of the merged values every ``width``-th is kept, from a middle position; of an even width's two middles in turn."""
        merged = np.sort(np.concatenate(buffers), kind="stable")
        middle = (self.width - 1) // 2
        if self.width % 2 == 0:
            middle += self.turn
            self.turn ^= 1
        self.error += weight // 2
        return merged[middle :: self.width]

    def merge(self, levels: list[int], buffers: np.ndarray, loose: np.ndarray, count: int, error: int, low: float, high: float) -> None:
        """Add another sketch of the same size and width."""
        self.count += count
        self.error += error
        self.low, self.high = min(self.low, low), max(self.high, high)
        if len(loose):
            self._fill(loose)
        for level, buffer in zip(levels, buffers.reshape(-1, self.size), strict=True):
            self._put(buffer, level)

    def quantiles(self, shares: list[float]) -> tuple[list[float], int]:
        """The value at rank ceil(share * count) of each, and how many ranks it may be off at most."""
        values = [np.sort(np.concatenate(self.loose))] if self.pending else []
        weights = [np.ones(len(values[0]), dtype=np.int64)] if values else []
        heaviest = 1
        for level, buffers in enumerate(self.levels):
            for buffer in buffers:
                heaviest = self.width**level
                values.append(buffer)
                weights.append(np.full(self.size, heaviest, dtype=np.int64))
        v, w = np.concatenate(values), np.concatenate(weights)
        order = np.argsort(v, kind="stable")
        upto = np.cumsum(w[order])
        ranks = [min(self.count, max(1, math.ceil(s * self.count - 1e-9))) for s in shares]
        at = np.minimum(np.searchsorted(upto, ranks), len(v) - 1)
        # A value stands for `heaviest` ranks at most.
        return [float(v[order[i]]) for i in at], self.error + heaviest - 1

    def row(self) -> tuple:
        levels = [i for i, b in enumerate(self.levels) for _ in b]
        buffers = [b for own in self.levels for b in own]
        return (levels, np.concatenate(buffers) if buffers else np.empty(0), np.concatenate(self.loose) if self.loose else np.empty(0), self.count, self.error, self.low, self.high)


_STATE = "levels array<int>, buffers array<double>, loose array<double>, count bigint, error bigint, low double, high double"
_TYPES = [pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
_NAMES = ["levels", "buffers", "loose", "count", "error", "low", "high"]


def _arrow(groups: list[str], nodes: list[int], sketches: list[Sketch]) -> pa.RecordBatch:
    rows = [s.row() for s in sketches]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
    return pa.record_batch([pa.array(groups, pa.string()), pa.array(nodes, pa.int64()), *columns], names=["grp", "node", *_NAMES])


def _sketch_rows(size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node = TaskContext.get().partitionId()
        held: dict[str, Sketch] = {}
        values = 0
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            names, number = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            data = batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(number, kind="stable")
            borders = np.searchsorted(number[order], np.arange(len(names) + 1))
            data = data[order]
            for i, name in enumerate(names):
                sketch = held.get(name)
                if sketch is None:
                    sketch = held[name] = Sketch(size, width)
                sketch.add(data[borders[i] : borders[i + 1]])
            values += len(data)
            if values > HELD:
                yield _arrow(list(held), [node] * len(held), list(held.values()))
                held, values = {}, 0
        if held:
            yield _arrow(list(held), [node] * len(held), list(held.values()))

    return run


def _merge_rows(size: int, width: int):
    """Rows sorted by group and node to one sketch each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        sketch = Sketch(size, width)
        done: list[tuple[tuple[str, int], Sketch]] = []
        for batch in batches:
            groups, nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            columns = {n: batch.column(2 + i) for i, n in enumerate(_NAMES)}
            for i, key in enumerate(zip(groups, nodes, strict=True)):
                if key != now:
                    if now is not None:
                        done.append((now, sketch))
                    now, sketch = key, Sketch(size, width)
                sketch.merge(
                    columns["levels"][i].as_py(),
                    *(columns[n][i].values.to_numpy(zero_copy_only=False) for n in ("buffers", "loose")),
                    *(columns[n][i].as_py() for n in ("count", "error", "low", "high")),
                )
            if len(done) > 200:
                yield _arrow([k[0] for k, _ in done], [k[1] for k, _ in done], [s for _, s in done])
                done = []
        if now is not None:
            done.append((now, sketch))
        if done:
            yield _arrow([k[0] for k, _ in done], [k[1] for k, _ in done], [s for _, s in done])

    return run


def combine(sketches: DataFrame, group: str, nodes: int, size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """One sketch per ``group`` (an expression over the columns): a tree of levels over at most ``nodes`` node numbers.

    Each level puts at most ``FAN_IN`` nodes of a group together, so a task never merges an unbounded number of sketches.
    """
    state = sketches.select(F.expr(group).alias("grp"), "node", *_NAMES)
    while True:
        nodes = math.ceil(nodes / FAN_IN)
        state = state.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("bigint") if nodes > 1 else F.lit(0).cast("bigint"))
        state = state.repartition("grp", "node").sortWithinPartitions("grp", "node", "count", "error", "low", "high").mapInArrow(_merge_rows(size, width), f"grp string, node bigint, {_STATE}")
        if nodes <= 1:
            return state


def sketch_groups(df: DataFrame, group: str, values: str, size: int = SIZE, width: int = WIDTH) -> tuple[DataFrame, int]:
    """One sketch per input partition and group of the finite numbers of ``values``, and the number of nodes that gave them."""
    rows = df.select(F.expr(group).alias("grp"), F.expr(values).cast("double").alias("v"))
    rows = rows.where("grp is not null and v is not null and not isnan(v) and abs(v) != double('infinity')")
    nodes = rows.rdd.getNumPartitions()
    return rows.mapInArrow(_sketch_rows(size, width), f"grp string, node bigint, {_STATE}"), nodes


def _estimate(shares: list[float], size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row in batch.to_pylist():
                s = Sketch(size, width)
                s.merge(row["levels"], np.array(row["buffers"]), np.array(row["loose"], dtype=float), row["count"], 0, row["low"], row["high"])
                s.error = row["error"]
                found, error = s.quantiles(shares)
                for c, x in zip(out, (row["grp"], s.count, error, s.low, s.high, found), strict=True):
                    c.append(x)
            types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["grp", "n", "rank_error", "low", "high", "found"])

    return run


def estimates(sketches: DataFrame, shares: list[float], size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """``grp, n, rank_error, low, high, found``: the estimates for ``shares`` and how many ranks each may be off.

    ``low`` and ``high`` are exact. A group without finite values has no row; repeated rows and ties count as often as they occur.
    """
    return sketches.select("grp", *_NAMES).mapInArrow(_estimate(shares, size, width), "grp string, n bigint, rank_error bigint, low double, high double, found array<double>")
