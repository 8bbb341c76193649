"""Merged periods and gaps of a stream of intervals, kept as an interval map in keyed state.

The state of an entity is its ordered map of disjoint intervals over all time, so periods that cross
midnight, or any other border, are whole. A hot entity is folded in many tasks first: each micro-batch is
folded by partition, entity and day before the shuffle, as in the batch operator, and what reaches the entity's state is
bounded by the calendar, not by its rows. What comes out are changes: ``drop`` a period or gap, ``put`` a period or gap,
which a sink can apply in any order within a batch. Late and repeated rows need no watermark: they
merge into the map wherever they belong. Where state must not grow for ever, ``forget`` lets go of what ended long ago.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fareloom.operators.intervals import GapMap, fold_partitions

OUT = "key string, change string, kind string, start bigint, end bigint"
STATE = "starts array<bigint>, ends array<bigint>, horizon bigint"


def _contents(kept: GapMap) -> set[tuple[str, int, int]]:
    return {("period", s, e) for s, e in zip(kept.starts, kept.ends, strict=True)} | {("gap", s, e) for s, e in kept.gaps}


def fold_batch(forget: int | None):
    """Inserts the new intervals of one key; gives what is no more and what is new."""

    def fold(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, horizon = state.get if state.exists else ([], [], None)
        kept = GapMap(list(starts), list(ends))
        before, late = _contents(kept), []
        for batch in batches:
            for ss, es in zip(batch["starts"], batch["ends"], strict=True):
                for start, end in zip(ss, es, strict=True):
                    if horizon is not None and start < horizon:
                        late.append(("late", "period", int(start), int(end)))
                    else:
                        kept.insert(int(start), int(end))
        after = _contents(kept)
        if forget is not None and kept.ends:
            horizon = max(kept.ends[-1] - forget, horizon if horizon is not None else kept.ends[-1] - forget)
            kept.settled(horizon)
        state.update((kept.starts, kept.ends, horizon))
        changes = [("drop", *x) for x in sorted(before - after)] + [("put", *x) for x in sorted(after - before)] + late
        yield pd.DataFrame([(key[0], *c) for c in changes], columns=["key", "change", "kind", "start", "end"])

    return fold


def stream_periods(df: DataFrame, key: str, start: str, end: str, bucket_seconds: int = 86_400, forget: int | None = None) -> DataFrame:
    """The changes of each micro-batch; rows as in :func:`fareloom.operators.intervals.periods_and_gaps`.

    With ``forget``, periods that ended more than so many seconds before an entity's newest end leave its state (the newest never does);
    what starts before that comes out as ``late`` and is merged nowhere.
    """
    folded = fold_partitions(df, key, start, end, bucket_seconds)
    return folded.select("key", "starts", "ends").groupBy("key").applyInPandasWithState(fold_batch(forget), OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def current_periods(changes: DataFrame, kind: str = "period") -> DataFrame:
    """The periods (or gaps) that a table of changes, with the number of the batch in ``batch``, leaves: those whose last change is ``put``."""
    last = F.max_by("change", F.struct("batch", F.col("change") == "put"))
    own = changes.where((F.col("kind") == kind) & F.col("change").isin("put", "drop"))
    return own.groupBy("key", "start", "end").agg(last.alias("change")).where("change = 'put'").select("key", "start", "end")
