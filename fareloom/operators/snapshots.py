"""What changed between consecutive full snapshots.

``EXCEPT ALL`` in both directions takes away the rows that two snapshots share;
only what is left, the residue, is put together by key and labelled. All pairs of
consecutive snapshots go through one plan. A row is on the new side of its own snapshot's pair and on the old side
of the next one's. It isn't doubled for that: per state (a key with its compared values) the pairs on whose new
side it is are the bits of one number, those on whose old side it is the bits of another. What is in the first and not in the second
is ``new EXCEPT old`` of every pair at once, and the other way round. Building the numbers combines before the
shuffle, so a state that never changes is shuffled as a row per input partition at most, however many snapshots hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import written

#: Pairs of snapshots that one number holds.
BITS = 62
#: Snapshots up to which their list is broadcast; a longer one is joined by Spark's own choice.
LISTED = 100_000


def _listed(keyed: DataFrame, group: list[str], version: str) -> DataFrame:
    """One row per group: ``_g``, a number for it, and ``_versions`` in order. Written, so that the numbers stay."""
    known = keyed.select(*group, version).where(" and ".join(f"`{c}` is not null" for c in [*group, version])).distinct()
    per = known.groupBy(*group).agg(F.sort_array(F.collect_list(version)).alias("_versions"))
    return written(per.withColumn("_g", F.monotonically_increasing_id()), "snapshots")


def _sides(keyed: DataFrame, listed: DataFrame, group: list[str], version: str, key: str, compared: list[str]) -> DataFrame:
    """``_g, _block, key, compared..., _new, _old``: the pairs, numbered by their later snapshot, on whose sides a state is."""
    each = listed.select(*group, "_g", F.size("_versions").alias("_n"), F.posexplode("_versions").alias("_i", version))
    pair = lambda i, new, old: f"named_struct('_block', {i} div {BITS}, '_new', {new}, '_old', {old})"
    bit = lambda i: f"shiftleft(1L, int({i} % {BITS}))"
    each = each.select(*group, version, "_g", F.expr(f"inline(array({pair('_i', f'if(_i > 0, {bit("_i")}, 0L)', '0L')}, {pair('(_i + 1)', '0L', f'if(_i + 1 < _n, {bit("(_i + 1)")}, 0L)')}))"))
    each = each.groupBy(*group, version, "_g", "_block").agg(F.bit_or("_new").alias("_new"), F.bit_or("_old").alias("_old")).where("_new | _old != 0")
    if (listed.agg(F.sum(F.size("_versions"))).first()[0] or 0) <= LISTED:
        each = F.broadcast(each)
    placed = keyed.where(F.col(key).isNotNull()).join(each, [*group, version])
    return placed.groupBy("_g", "_block", key, *compared).agg(F.bit_or("_new").alias("_new"), F.bit_or("_old").alias("_old"))


def _each_pair(of: DataFrame, listed: DataFrame, what: str) -> DataFrame:
    """A row per pair whose bit is set in ``_off``: ``what`` may use ``i``, its bit, and gives the columns of ``x`` beside ``v``, the later version."""
    some = of.join(listed, "_g")
    return some.withColumn("x", F.expr(f"explode(transform(filter(sequence(0, {BITS - 1}), i -> shiftright(_off, i) & 1 = 1), i -> named_struct('v', _versions[_block * {BITS} + i], 'what', {what})))"))


def snapshot_residues(df: DataFrame, group: list[str], version: str, key: str, compared: list[str]) -> DataFrame:
    """``*group, version, key, compared..., side``: the rows of both differences for every pair; ``side`` is ``new`` or ``old``, ``version`` the later one.

    What counts as a row, and nulls, are as in :func:`snapshot_changes`.
    """
    keyed = df.select(*group, version, key, *compared)
    listed = _listed(keyed, group, version)
    off = _sides(keyed, listed, group, version, key, compared).withColumn("_off", F.expr("_new ^ _old")).where("_off != 0")
    return _each_pair(off, listed, "if(shiftright(_new, i) & 1 = 1, 'new', 'old')").select(*group, F.col("x.v").alias("version"), key, *compared, F.col("x.what").alias("side"))


def snapshot_changes(df: DataFrame, group: list[str], version: str, key: str, compared: list[str]) -> DataFrame:
    """``*group, version, key, change`` with change ``added``, ``removed`` or ``changed``.

    Within ``group`` each version is compared with the next lower one that occurs; the lowest yields nothing.
    Two states of a key differ when any of ``compared`` differs, null being a value of its own; other columns are not read.
    Repeated rows are one. A key with several different rows in a snapshot is compared by the set of them.
    Rows with a null key name nobody, but still make their snapshot exist; rows with a null group or version belong to no snapshot.
    The rows that differ are those of :func:`snapshot_residues`; a key with a residue is labelled by the sides it has any row on.
    """
    keyed = df.select(*group, version, key, *compared)
    listed = _listed(keyed, group, version)
    sides = _sides(keyed, listed, group, version, key, compared)
    keys = sides.groupBy("_g", "_block", key).agg(F.bit_or("_new").alias("_new"), F.bit_or("_old").alias("_old"), F.bit_or(F.expr("_new ^ _old")).alias("_off")).where("_off != 0")
    label = "case when shiftright(_old, i) & 1 = 0 then 'added' when shiftright(_new, i) & 1 = 0 then 'removed' else 'changed' end"
    return _each_pair(keys, listed, label).select(*group, F.col("x.v").alias("version"), key, F.col("x.what").alias("change"))
