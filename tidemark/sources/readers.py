"""Readers of the raw publication formats.

File readers declare their schema (nothing is inferred); every text shape also
has a ``parse_*`` form over a DataFrame with a text column, so that the same
logic serves files, tables and streams.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import canonicalise, with_ingest_order
from tidemark.schema import OBSERVATION

# The columns of a history file.
HISTORY_TEXT = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "metric_id", "geo_id", "geo_level", "period", "value", "unit", "source_id",
            "observation_end", "published_at", "fetched_at", "quality_flag", "revision",
        )
    ]
)


# --- History ------------------------------------------------------------------------
def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All history files below ``root`` (one CSV per source and metric)."""
    text = spark.read.schema(HISTORY_TEXT).option("header", True).csv(f"{root.rstrip('/')}/*/*.csv")
    typed = with_ingest_order(text).select(
        "seq",
        "metric_id",
        "geo_id",
        F.nullif("geo_level", F.lit("")).alias("geo_level"),
        "period",
        F.col("value").try_cast("double").alias("value"),
        "unit",
        "source_id",
        *[F.substring(c, 1, 10).try_cast("date").alias(c) for c in ("observation_end", "published_at", "fetched_at")],
        F.coalesce(F.nullif("quality_flag", F.lit("")), F.lit("ok")).alias("quality_flag"),
        F.coalesce(F.col("revision").try_cast("int"), F.lit(0)).alias("revision"),
    )
    return canonicalise(typed, "1970-01-01")


def read_table(spark: SparkSession, path: str, source_id: str | None = None, metric_id: str | None = None) -> DataFrame:
    """The partitioned history table; the filters prune its directories.  Nothing is inferred, so a source named ``2024`` stays text."""
    df = spark.read.schema(OBSERVATION).parquet(path)
    if source_id is not None:
        df = df.where(F.col("source_id") == source_id)
    if metric_id is not None:
        df = df.where(F.col("metric_id") == metric_id)
    return df


# --- Delimited ----------------------------------------------------------------------
def read_delimited(
    spark: SparkSession, path: str, columns: Mapping[str, str], sep: str = ";", encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited file (gz is transparent) as text columns, then renamed.

    ``columns`` maps the header names wanted, in file order, to new names; the
    CSV reader prunes the rest.
    """
    raw = spark.read.option("sep", sep).option("encoding", encoding).option("header", True).csv(path)
    # A byte-order mark, quotes and blanks around header names are dropped.
    clean = {c.strip("﻿\" ").lower(): c for c in raw.columns}
    return raw.select(*[F.col(f"`{clean[old.lower()]}`").alias(new) for old, new in columns.items()])


def parse_delimited(lines: DataFrame, schema: str, sep: str = ";", text: str = "value") -> DataFrame:
    """Delimited text rows to columns; short or malformed rows give NULLs."""
    return lines.select(F.from_csv(text, schema, {"sep": sep, "mode": "PERMISSIVE"}).alias("r")).select("r.*")


# --- Nested and position-indexed JSON -----------------------------------------------
STATISTICS_SERIES = (
    "struct<MetaData:array<struct<Variable:struct<Nombre:string>,Nombre:string,Codigo:string>>,"
    "Data:array<struct<Anyo:int,Periodo:string,Valor:double,Secreto:boolean>>>"
)


def dimension(metadata: Column, variable: str, field: str = "Codigo") -> Column:
    """A dimension of a series by the name of its variable."""
    hits = F.filter(metadata, lambda m: m["Variable"]["Nombre"] == variable)
    return F.get(hits, F.lit(0))[field]


def parse_statistics_json(docs: DataFrame, dimensions: Mapping[str, str], text: str = "value") -> DataFrame:
    """Series JSON to one row per public point with its dimensions.

    ``dimensions`` maps output columns to variable names.  Secret and empty
    points are skipped.
    """
    series = docs.select(F.from_json(text, STATISTICS_SERIES).alias("s"))
    points = series.select(
        *[dimension(F.col("s.MetaData"), var).alias(name) for name, var in dimensions.items()],
        F.explode("s.Data").alias("p"),
    )
    public = ~F.coalesce(F.col("p.Secreto"), F.lit(False)) & F.col("p.Valor").isNotNull()
    return points.where(public).select(
        *dimensions, F.col("p.Anyo").alias("year"), F.col("p.Periodo").alias("period_code"), F.col("p.Valor").alias("value")
    )


def parse_position_json(docs: DataFrame, key: Sequence[str], values: str, labels: str) -> DataFrame:
    """Values keyed by position, labels in a separate dimension.

    ``values`` is a map of position text to number, ``labels`` an array (label
    at its position) or a map of label to position.  The look-up stays inside
    the row: no join is needed.
    """
    kind = dict(docs.dtypes)[labels]
    out = docs.select(*key, labels, F.explode(values).alias("_pos", "value"))
    position = F.col("_pos").try_cast("int")
    if kind.startswith("map"):
        hit = F.filter(F.map_entries(labels), lambda e: e["value"] == position)
        label = F.get(hit, F.lit(0))["key"]
    else:
        label = F.get(F.col(labels), position)
    return out.select(*key, label.alias("label"), "value").where(F.col("label").isNotNull() & F.col("value").isNotNull())


def parse_timeline_json(docs: DataFrame, key: Sequence[str], schema: str, items: str, stamp: str, value: str, text: str = "value") -> DataFrame:
    """``{items: [{stamp, value}]}`` to (key, month text, value).

    ``items`` is a path of fields, each with an optional position, such as
    ``timeline[0].data``; where a document lacks it, it has no items.
    """
    found = F.from_json(text, schema)
    for name, position in re.findall(r"([^.\[\]]+)(?:\[(\d+)\])?", items):
        found = found[name] if not position else F.get(found[name], F.lit(int(position)))
    opened = docs.select(*key, F.explode(found).alias("i"))
    s = F.regexp_replace(F.col(f"i.{stamp}").cast("string"), r"[^0-9]", "")
    month = F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2))
    return opened.select(*key, month.alias("period"), F.col(f"i.{value}").cast("double").alias("value"))


def as_array(json_text: Column, element_schema: str) -> Column:
    """A JSON value that is an array or a single bare object, as an array."""
    many = F.from_json(json_text, f"array<{element_schema}>")
    one = F.from_json(json_text, element_schema)
    return F.when(F.ltrim(json_text).startswith("["), many).when(json_text.isNotNull(), F.array(one))


# --- Fixed width, logs, documents, sensors -------------------------------------------
def parse_fixed_width(lines: DataFrame, fields: Mapping[str, tuple[int, int]], text: str = "value") -> DataFrame:
    """Slice named fields, each given as zero-based (start, end)."""
    return lines.select(*[F.trim(F.substring(text, a + 1, b - a)).alias(name) for name, (a, b) in fields.items()])


def parse_navigation_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Tab-separated (prev, curr, type, n); comments and bad rows are dropped."""
    parts = F.split(F.col(text), "\t")
    good = lines.where(~F.col(text).startswith("#")).select(parts.alias("p")).where(F.size("p") == 4)
    out = good.select(
        F.col("p")[0].alias("prev"), F.col("p")[1].alias("curr"), F.col("p")[2].alias("type"),
        F.col("p")[3].try_cast("bigint").alias("n"),
    )
    return out.where(F.col("n").isNotNull())


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listing snapshot (gz CSV), the four columns used."""
    return read_delimited(
        spark,
        path,
        {"id": "id", "host_id": "host_id", "room_type": "room_type", "neighbourhood_cleansed": "neighbourhood"},
        sep=",",
    )


def paragraphs(docs: DataFrame, key: Sequence[str], text: str, pattern: str) -> DataFrame:
    """Explode a document into paragraphs and strip their tags."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    rows = docs.select(*key, F.explode(found).alias("paragraph"))
    return rows.withColumn("paragraph", F.regexp_replace("paragraph", r"<[^>]+>", ""))


def event_kinds(rows: DataFrame, key: Sequence[str], kinds: Mapping[str, str], text: str = "paragraph") -> DataFrame:
    """Multi-label match: one row per paragraph and kind whose pattern matches."""
    labels = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), F.lit(k)) for k, p in kinds.items()]))
    return rows.select(*key, F.explode(labels).alias("kind"))


# The paragraph mark and the wording of company events.
GAZETTE_PARAGRAPH = r'(?s)<p class="parrafo">(.*?)</p>'
GAZETTE_KINDS = {
    "company_incorporations": r"^\s*Constitución\.",
    "company_dissolutions": r"Extinción|Disolución",
    "insolvencies": r"(?i)declaraci[oó]n de concurso",
}


def days_to_long(wide: DataFrame, key: Sequence[str], days: int = 31, valid: str = "V") -> DataFrame:
    """Station-month rows (``D01..``, ``V01..``) to one row per valid day."""
    pairs = F.array(
        *[
            F.struct(F.lit(d).alias("day"), F.col(f"D{d:02d}").cast("double").alias("value"), F.col(f"V{d:02d}").alias("flag"))
            for d in range(1, days + 1)
        ]
    )
    long = wide.select(*key, F.inline(pairs))
    return long.where((F.col("flag") == valid) & F.col("value").isNotNull()).drop("flag")
