"""Reading files into typed tables. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from json import loads

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, base: str | None = None) -> DataFrame:
    """One or several Parquet paths; with ``base`` the folders below it become partition columns again. A given schema must be that of the files: names that they lack, or that have another type, fail."""
    if schema:
        own = spark.read.option("basePath", base).parquet(*([paths] if isinstance(paths, str) else paths)) if base else spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
        kinds = {f.name: f.dataType for f in own.schema}
        wrong = [f.name for f in schema if kinds.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"files lack, or have as another type: {wrong}")
    reader = spark.read.schema(schema) if schema else spark.read
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def csv_text(spark: SparkSession, paths: str | list[str], columns: list[str], base: str | None = None) -> DataFrame:
    """CSV with a header, every column as text, blank fields null. Columns that the header lacks fail. With ``base`` the folders below it (``area=X/month=Y``) become columns."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    df = (reader.option("basePath", base) if base else reader).csv(paths)
    missing = [c for c in columns if c not in df.columns]
    if missing or len({c.lower() for c in df.columns}) != len(df.columns):
        raise ValueError(f"header lacks {missing} or repeats a name: {df.columns}")
    return df.select(*(blank_to_null(F.col(c)).alias(c) for c in columns))


def latest_sql(table: str, key: list[str], version: str, columns: list[str]) -> str:
    """SQL for a database that reads the rows of the newest version of each key only."""
    names = ", ".join(f"t.{c}" for c in columns)
    on = " AND ".join(f"t.{k} = v.{k}" for k in [*key, version])
    return f"(SELECT {names} FROM {table} t JOIN (SELECT {', '.join(key)}, max({version}) AS {version} FROM {table} GROUP BY {', '.join(key)}) v ON {on}) latest"


def once_more(read: Callable[[], DataFrame]) -> DataFrame:
    """Reads again once when connecting fails; the second failure is final."""
    try:
        return read()
    except Exception:  # noqa: BLE001 - whatever the driver of the database throws
        return read()


def jdbc(spark: SparkSession, url: str, table: str, split_by: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A database table, in ``parts`` parallel reads by ranges of a number column; filters and columns are pushed to the database. ``table`` may be a query in brackets (:func:`latest_sql`)."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_by:
        reader = reader.options(partitionColumn=split_by, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return once_more(reader.load)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    text = F.trim(c)
    return F.when(text != "", text)


def join_key(c: Column) -> Column:
    """Trimmed, inner blanks as one, upper case, null when blank: the form in which names are compared."""
    return blank_to_null(F.upper(F.regexp_replace(c, r"\s+", " ")))


def optional_number(c: Column, low: float = 0.0, high: float = float("inf")) -> tuple[Column, Column]:
    """``(value, bad)``: a number between the bounds or null for blank; ``bad`` where there is text that is none."""
    text = blank_to_null(c)
    number = text.try_cast("double")
    good = number.isNotNull() & ~F.isnan(number) & number.between(low, high)
    return F.when(good, number), text.isNotNull() & ~F.coalesce(good, F.lit(False))


def nested_names(c: Column) -> Column:
    """JSON ``{make: {model: "2010 (A, B) / 2018 (C)"}}`` as an array of (make, model, year, product)."""
    makes = F.map_entries(F.from_json(c, "map<string,map<string,string>>"))
    models = F.flatten(F.transform(makes, lambda m: F.transform(F.map_entries(m["value"]), lambda x: F.struct(m["key"].alias("make"), x["key"].alias("model"), x["value"].alias("text")))))
    groups = F.flatten(F.transform(models, lambda m: F.transform(F.split(m["text"], r"\s*/\s*"), lambda g: F.struct(m["make"].alias("make"), m["model"].alias("model"), g.alias("g")))))
    return F.flatten(
        F.transform(
            groups,
            lambda x: F.transform(
                F.filter(F.transform(F.split(F.regexp_extract(x["g"], r"\((.*)\)", 1), ","), lambda p: F.trim(p)), lambda p: p != ""),
                lambda p: F.struct(x["make"].alias("make"), x["model"].alias("model"), F.regexp_extract(x["g"], r"(\d{4})", 1).try_cast("int").alias("year"), p.alias("product")),
            ),
        )
    )


def strip_markup(c: Column) -> Column:
    """Text without tags, entities for blanks and repeated blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"<[^<>]*>", " "), "&nbsp;", " "), r"\s+", " "))


def alias(c: Column, names: dict[str, str]) -> Column:
    """The canonical name of a spelling, null for an unknown one."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.try_element_at(table, F.lower(F.trim(c)))


def known_alias(c: Column, names: dict[str, str]) -> Column:
    """The canonical name of a spelling; an unknown one fails the query, null stays null."""
    found = alias(c, names)
    return F.when(c.isNotNull() & found.isNull(), F.raise_error(F.concat(F.lit("unknown name: "), c)).cast("string")).otherwise(found)


def model_year(c: Column, low: int = 1980, high: int = 2100) -> tuple[Column, Column]:
    """``(year, bad)``: a whole year between the bounds, or null for blank; ``bad`` where there is text that is none."""
    text = blank_to_null(c.cast("string"))
    year = F.when(text.rlike(r"^[0-9]{4}$"), text).try_cast("int")
    good = year.isNotNull() & year.between(low, high)
    return F.when(good, year), text.isNotNull() & ~F.coalesce(good, F.lit(False))


def fuel_class(c: Column) -> Column:
    """``EV``, ``PHEV``, ``HYBRID`` or ``GAS`` (also for blank) of a fuel's description."""
    text = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    plug = text.contains("plug-in") | text.contains("phev")
    return F.when(text.isin("ev", "electric", "electricity"), "EV").when(plug, "PHEV").when(text.contains("hybrid"), "HYBRID").otherwise("GAS")


def model_lines(c: Column) -> Column:
    """Lines ``* **Make** Model 2015 (A, B)`` of a marked-up text as an array of (make, model, year, products); tags and footnote marks are dropped, other lines give nothing."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?s)<sup>.*?</sup>", ""), r"<[^<>]*>", "")
    pattern = r"^\s*[*-]\s+\*\*(.+?)\*\*\s+(.+?)\s+(\d{4})(?:\s*\((.*)\))?\s*$"
    lines = F.filter(F.split(bare, r"\r?\n"), lambda x: x.rlike(pattern))
    products = lambda x: F.filter(F.transform(F.split(F.regexp_extract(x, pattern, 4), ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(lines, lambda x: F.struct(F.regexp_extract(x, pattern, 1).alias("make"), F.regexp_extract(x, pattern, 2).alias("model"), F.regexp_extract(x, pattern, 3).cast("int").alias("year"), products(x).alias("products")))


def cards(c: Column, kind: str) -> Column:
    """The ``<div class="... kind ...">`` blocks of a page as an array of (title, link, text): the first heading, the first link and all text. Blocks don't nest."""
    blocks = F.regexp_extract_all(c, F.lit(rf'(?s)<div[^<>]*class="[^"]*\b{kind}\b[^"]*"[^<>]*>(.*?)</div>'), F.lit(1))
    return F.transform(blocks, lambda b: F.struct(strip_markup(F.regexp_extract(b, r"(?s)<h[1-6][^<>]*>(.*?)</h[1-6]>", 1)).alias("title"), F.nullif(F.regexp_extract(b, r'<a[^<>]*href="([^"]*)"', 1), F.lit("")).alias("link"), strip_markup(b).alias("text")))


def absolute(link: Column, page: str) -> Column:
    """A link of a page as a full address: full ones stay, others are taken from the root (``/x``) or the folder of the page."""
    scheme, _, rest = page.partition("://")
    host, slash, path = rest.partition("/")
    folder = f"{scheme}://{host}/" + (path.rpartition("/")[0] + "/" if "/" in path else "")
    return F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.lit(f"{scheme}:"), link)).when(link.startswith("/"), F.concat(F.lit(f"{scheme}://{host}"), link)).otherwise(F.concat(F.lit(folder), link))


def found_values(df: DataFrame, key: str, json: str, name: str) -> DataFrame:
    """``key, value``: the texts of all fields called ``name`` in JSON documents, however deeply they are nested, in the order in which they stand (``place``).

    Documents are walked through one at a time; what is no JSON gives nothing.
    """

    def walk(node: object) -> Iterator[str]:
        if isinstance(node, dict):
            for k, v in node.items():
                if k == name and isinstance(v, str):
                    yield v
                else:
                    yield from walk(v)
        elif isinstance(node, list):
            for v in node:
                yield from walk(v)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = list(walk(loads(text))) if text else []
                except ValueError:
                    found = []
                out += [(k, i, v) for i, v in enumerate(found)]
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))], names=["key", "place", "value"])

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(json).cast("string").alias("json"))
    return rows.mapInArrow(search, "key string, place int, value string").withColumnRenamed("key", key)


def merged_headers(top: list[str | None], below: list[str | None]) -> list[str]:
    """Column names from two header rows of a sheet whose upper cells are merged: the last upper text, then the lower one. A repeated name fails."""
    names, last = [], ""
    for a, b in zip(top, below, strict=True):
        last = a.strip() if a and a.strip() else last
        names.append("_".join(x for x in (last, (b or "").strip()) if x))
    if len(set(names)) != len(names) or "" in names:
        raise ValueError(f"headers repeat or lack a name: {names}")
    return names
