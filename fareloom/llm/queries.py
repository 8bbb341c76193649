"""The queries p1, p8, p9 and p10, and SQL that says the same where SQL can."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.leakage import leaked_items
from fareloom.llm.quantiles import combine, estimates, sketch_groups
from fareloom.llm.spam import spam_shares
from fareloom.llm.tokens import encode_corpus
from fareloom.operators.skew import key_percentiles
from fareloom.session import written
from fareloom.sources.tables import table

#: The folder of the public vocabularies, the same on every machine.
TOKENIZERS = os.environ.get("FARELOOM_TOKENIZERS", "/opt/tokenizers")
SHARES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
_SEP = "\u001f"


def _load_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """A stored sketch per measure, zone and load."""
    trips = table(spark, folder, "monthly_taxi_trip").where("PULocationID is not null")
    long = trips.select("load_id", "PULocationID", F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("driver_pay", "trip_miles")))))
    group = f"concat_ws('{_SEP}', measure, PULocationID, coalesce(load_id, ''))"
    sketches, nodes = sketch_groups(long, group, "value")
    return written(combine(sketches, "grp", nodes), "sketches")


def _over_loads(stored: DataFrame) -> DataFrame:
    """The sketches of all loads, from those of the single ones."""
    load = F.element_at(F.split("grp", _SEP), 3)
    loads = max(1, stored.select(load.alias("l")).distinct().count())
    numbered = stored.withColumn("node", F.pmod(F.xxhash64(load), F.lit(loads)))
    return combine(numbered, f"substring_index(grp, '{_SEP}', 2)", loads)


def _named(found: DataFrame) -> DataFrame:
    part = F.split("grp", _SEP)
    return found.select(
        F.get(part, F.lit(0)).alias("measure"), F.get(part, F.lit(1)).cast("int").alias("PULocationID"), F.get(part, F.lit(2)).alias("load_id"), "n", "rank_error", "low", "high",
        *(F.get("found", F.lit(i)).alias(f"p{round(s * 100)}") for i, s in enumerate(SHARES)),
    )


def p1_zone_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of pay and miles per zone and load, and over all loads (``load_id`` null), with the most ranks each may be off.

    Rows without a zone belong to no group; rows without a load are those of the load ``''``; null, NaN and infinite values don't count.
    """
    stored = _load_sketches(spark, folder)
    return _named(estimates(stored, SHARES)).unionByName(_named(estimates(_over_loads(stored), SHARES)))


def p1_rank_check(spark: SparkSession, folder: str) -> DataFrame:
    """For the percentiles over all loads: does the exact rank of each estimate keep the stated bound? Beside it the exact median."""
    trips = table(spark, folder, "monthly_taxi_trip")
    long = trips.select("PULocationID", F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("driver_pay", "trip_miles")))))
    long = long.where("PULocationID is not null and value is not null and not isnan(value) and abs(value) != double('infinity')")
    key = ["measure", "PULocationID"]
    # Counting by value first keeps the join small where a zone holds most rows.
    counted = long.groupBy(*key, "value").agg(F.count("*").alias("c"))
    found = _named(estimates(_over_loads(_load_sketches(spark, folder)), SHARES))
    names = [f"p{round(s * 100)}" for s in SHARES]
    sums = []
    for name in names:
        sums += [F.coalesce(F.sum(F.when(F.col("value") < F.col(name), F.col("c"))), F.lit(0)).alias(f"{name}_less"), F.sum(F.when(F.col("value") <= F.col(name), F.col("c"))).alias(f"{name}_upto")]
    ranked = counted.join(found, key).groupBy(*key, "n", "rank_error").agg(*sums)
    within = F.lit(True)
    for s, name in zip(SHARES, names, strict=True):
        rank = F.greatest(F.lit(1), F.ceil(F.col("n") * s))
        within = within & (F.greatest(F.col(f"{name}_less") + 1 - rank, rank - F.col(f"{name}_upto"), F.lit(0)) <= F.col("rank_error"))
    exact = key_percentiles(counted.select(F.col("measure").alias("key_column"), F.col("PULocationID").cast("string").alias("key_value"), "value", F.col("c").alias("n")), [50])
    exact = exact.select(F.col("key_column").alias("measure"), F.col("key_value").cast("int").alias("PULocationID"), F.col("value").alias("exact_p50"))
    return ranked.join(exact, key).select(*key, "n", "exact_p50", within.alias("within_bound"), (F.col("rank_error") <= F.greatest(F.lit(0), F.col("n") * 0.01)).alias("bound_below_1_percent"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that carry an evaluation item."""
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_item_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents carry each item."""
    return p9_found(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are pages of keywords, links or tags."""
    return spam_shares(table(spark, folder, "documents")).where("spam").select("doc_id")


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share of each document that is no writing."""
    return spam_shares(table(spark, folder, "documents")).select("doc_id", F.round("share", 6).alias("share"), "spam")


QUERIES = {f.__name__: f for f in (p1_zone_percentiles, p1_rank_check, p8_ids, p9_found, p9_item_leaks, p10_found, p10_shares)}

ORACLE = {
    "p1_rank_check": """
WITH long AS (
  SELECT PULocationID, 'driver_pay' AS measure, driver_pay AS value FROM monthly_taxi_trip
  UNION ALL SELECT PULocationID, 'trip_miles', trip_miles FROM monthly_taxi_trip)
SELECT measure, PULocationID, count(*) AS n, quantile_disc(value, 0.5) AS exact_p50, true AS within_bound, true AS bound_below_1_percent
FROM long WHERE PULocationID IS NOT NULL AND isfinite(value) GROUP BY ALL""",
}
