"""Column expressions that several operators share. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_id(c: Column) -> Column:
    """Trimmed and upper-cased; null where that leaves nothing (such an id names nobody)."""
    text = F.upper(F.trim(c))
    return F.when(text != "", text)


def seconds(c: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock timestamp (fractions are cut off downwards)."""
    return F.unix_seconds(c.cast("timestamp"))


def stamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of seconds since 1970."""
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss")


def finite(c: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite; never null."""
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False))


def unusable(c: Column) -> Column:
    """The opposite of :func:`finite`."""
    return ~finite(c)


def within(c: Column, low: str, high: str) -> Column:
    """Whether a timestamp lies from ``low`` up to but not including ``high``; null for null.

    The bounds, not the column, take the type of the other side, so the filter reaches the scan.
    """
    return (c >= F.lit(low).cast("timestamp_ntz")) & (c < F.lit(high).cast("timestamp_ntz"))


#: Amounts from here on have no whole number of cents of 64 bits.
CENTS_END = 9.2e16


def cents(c: Column) -> Column:
    """A money amount as whole cents, rounded; null for amounts that are not finite.

    Whole numbers make every sum independent of the order of its terms. A finite amount whose cents don't fit 64 bits fails the
    query rather than being left out; so does a sum that doesn't.
    """
    beyond = F.raise_error(F.concat(F.lit("no whole cents of 64 bits: "), c.cast("string"))).cast("bigint")
    return F.when(finite(c), F.when(F.abs(c) < F.lit(CENTS_END), F.round(c * 100).cast("bigint")).otherwise(beyond))


def natural_key(columns: list[str], occurrence: Column | None = None) -> Column:
    """SHA-256 of the columns' values as text, nulls marked, with the number of the occurrence where rows repeat."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    if occurrence is not None:
        parts.append(occurrence.cast("string"))
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def seed_of(*parts: Column, base: int = 0) -> Column:
    """A number from 0 up to 2^60 that depends on the parts alone: the seed of an entity's random draws."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(base), *parts), 256), 1, 15), 16, 10).cast("bigint")


def bucket_of(c: Column, buckets: int, seed: int = 0) -> Column:
    """A bucket from 0 that any engine with SHA-256 computes alike."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), c), 256), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def json_key(columns: list[str]) -> Column:
    """SHA-256 of the columns as one JSON object, nulls included: unlike joined text it can't run two values together."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in columns)), {"ignoreNullFields": "false"}), 256)


def hash_bucket(c: Column, buckets: int, seed: int = 0) -> Column:
    """A bucket from 0 by the engine's own 64-bit hash: quicker than :func:`bucket_of`, for where no other engine need agree."""
    return F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(buckets))


def hashed_years(c: Column, seed: int = 0, span: int = 11) -> Column:
    """A whole number from 0 up to ``span`` that depends on an id alone, by the engine's 32-bit hash (widened first, so that adding the seed can't overflow)."""
    return F.pmod(F.hash(c).cast("bigint") + seed, F.lit(span))


def uuid5(namespace: str, name: Column) -> Column:
    """The name-based (SHA-1) UUID of a text in a namespace, which is a UUID itself."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12))


def before_last(c: Column, mark: str) -> Column:
    """The text before the last ``mark``; all of it where there is none."""
    return F.regexp_replace(c, f"{mark}[^{mark}]*$", "")


def money(c: Column) -> Column:
    """``$1,234.50``, a minus before the sign."""
    return F.concat(F.when(c < 0, "-$").otherwise("$"), F.format_number(F.abs(c), 2))


def percent(c: Column) -> Column:
    """A share as ``12.3%``."""
    return F.concat(F.format_number(c * 100, 1), F.lit("%"))
