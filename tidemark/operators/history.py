"""Append-only, revision-aware history of observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.geo import geo_level_of
from tidemark.functions.periods import cadence_of, period_end, pidx_of_period
from tidemark.functions.text import canonical_number, same_value
from tidemark.schema import OBS_COLUMNS, OBS_KEY, OBSERVATION
from tidemark.session import cut_lineage


def with_ingest_order(df: DataFrame, batch: int = 0) -> DataFrame:
    """Add ``seq``: the place of each row in its batch, by file (in order of path) and row of the file.

    The same on every run and for any number of partitions; rows of a higher
    ``batch`` come later.  A frame that is not read from files is written first.
    Up to 2047 batches of a million files of four thousand million rows.
    """
    columns = [F.col(c) for c in df.columns if c != "seq"]
    file = F.col("_metadata.file_path").alias("_file")
    try:
        placed = df.select(*columns, file, F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        try:  # text files: the place of the block in its file, and of the row in its block (a row has a byte at least)
            numbered = df.select(*columns, file, F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
        except AnalysisException:
            return with_ingest_order(cut_lineage(df.select(*columns)), batch)
        numbered = cut_lineage(numbered)
        blocks = numbered.groupBy("_file", "_block").agg(F.min("_id").alias("_first"))
        placed = numbered.join(blocks, ["_file", "_block"]).withColumn("_row", F.col("_block") + F.col("_id") - F.col("_first")).drop("_block", "_id", "_first")
    # one row a file
    files = placed.select("_file").distinct().withColumn("_rank", F.row_number().over(Window.orderBy("_file")) - 1)
    number = (F.lit(batch).cast("bigint") * (1 << 20) + F.col("_rank")) * (1 << 32) + F.col("_row")
    return placed.join(files, "_file").withColumn("seq", number).drop("_file", "_row", "_rank")


def canonicalise(df: DataFrame, fetched_at: str, batch: int = 0) -> DataFrame:
    """Fill derived columns of raw records and cast them to the fixed schema.

    Expects at least metric, geography, period, value, unit and source; the
    remaining columns are inferred where absent, ``seq`` from the place in the
    input (:func:`with_ingest_order`).  ``fetched_at`` and the number of the
    ``batch`` are arguments so that a replay gives the same rows.
    """
    if "seq" not in df.columns:
        df = with_ingest_order(df, batch)

    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    cadence = given("cadence", cadence_of("period"))
    filled = {
        "geo_level": given("geo_level", geo_level_of("geo_id")),
        "cadence": cadence,
        "pidx": given("pidx", pidx_of_period("period")),
        "observation_end": given("observation_end", period_end("period")),
        "published_at": given("published_at", F.lit(None)),
        "fetched_at": given("fetched_at", F.lit(fetched_at)),
        "quality_flag": given("quality_flag", F.lit("ok")),
        "revision": given("revision", F.lit(0)),
        "seq": F.col("seq"),
    }
    return df.select(
        *[filled.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in OBSERVATION]
    )


def current_view(log: DataFrame, keys: Sequence[str] = OBS_KEY, sizes: str | None = None) -> DataFrame:
    """Highest revision per observation; on a tie the later ingest wins.  ``sizes`` adds the number of revisions.

    ``max_by`` combines on the map side, so an observation restated very often
    never gathers its revisions in one task.
    """
    rest = [c for c in log.columns if c not in keys]
    count = [] if sizes is None else [F.count(F.lit(1)).alias(sizes)]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("revision", "seq")).alias("_r"), *count)
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest], *([] if sizes is None else [sizes]))


def first_in_batch(batch: DataFrame, keys: Sequence[str] = OBS_KEY) -> DataFrame:
    """One row per observation of a batch: the first in ingest order."""
    rest = [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("seq")).alias("_r"))
    return first.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def merge(log: DataFrame, batch: DataFrame, revisions_allowed: Column | bool, keys: Sequence[str] = OBS_KEY) -> DataFrame:
    """Decide what happens to each observation of a batch.

    Adds ``action`` (added, unchanged, revised, quarantined), ``prior_value``
    and the revision to store.  Write :func:`appended` to the history and
    :func:`quarantined` to the quarantine.  The history is first reduced to the
    observations the batch touches, so a small batch does not shuffle it; both
    sides hold one row per key before the join.
    """
    allowed = F.lit(revisions_allowed) if isinstance(revisions_allowed, bool) else revisions_allowed
    first = first_in_batch(batch, keys)
    touched = log.join(batch.select(*keys).distinct(), list(keys), "left_semi")
    prior = current_view(touched, keys).select(
        *keys, F.col("value").alias("prior_value"), F.col("revision").alias("_prior_rev"), F.lit(True).alias("_known")
    )
    joined = first.join(prior, list(keys), "left")
    action = (
        F.when(F.col("_known").isNull(), "added")
        .when(same_value("prior_value", "value"), "unchanged")
        .when(allowed, "revised")
        .otherwise("quarantined")
    )
    revised = F.col("action") == "revised"
    return (
        joined.withColumn("action", action)
        .withColumn("revision", F.when(revised, F.col("_prior_rev") + 1).otherwise(F.col("revision")))
        .withColumn("quality_flag", F.when(revised, "revised").otherwise(F.col("quality_flag")))
        .drop("_prior_rev", "_known")
    )


def stored_month(end: Column | str = "observation_end") -> Column:
    """The partition of a stored log in which an observation lies."""
    return F.date_format(end, "yyyy-MM")


def write_log(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Add rows to a stored log, one folder a month; rows without an end of period share a folder."""
    rows.withColumn("stored", stored_month()).repartition("stored", F.pmod(F.xxhash64(*OBS_KEY), F.lit(8))).sortWithinPartitions(
        "stored", *OBS_KEY
    ).write.mode(mode).partitionBy("stored").parquet(path)


def touched_log(log: DataFrame, batch: DataFrame) -> DataFrame:
    """Of a log stored by month (read with its column ``stored``) the months that a batch has: a filter on folders."""
    months = [r[0] for r in batch.select(stored_month()).distinct().collect()]  # as many as months, never as rows
    known = F.col("stored").isin([m for m in months if m is not None])
    return log.where(known | F.col("stored").isNull() if None in months else known).drop("stored")


def merge_stored(path: str, batch: DataFrame, revisions_allowed: Column | bool) -> DataFrame:
    """:func:`merge` of a batch into the log stored in ``path``: only the months of the batch are read."""
    schema = StructType([*OBSERVATION.fields, StructField("stored", StringType())])
    return merge(touched_log(batch.sparkSession.read.schema(schema).parquet(path), batch), batch, revisions_allowed)


def appended(decisions: DataFrame) -> DataFrame:
    """Rows to append to the history."""
    return decisions.where(F.col("action").isin("added", "revised")).select(*OBS_COLUMNS)


def quarantined(decisions: DataFrame) -> DataFrame:
    """Rows to append to the quarantine, with the value they contradict."""
    return decisions.where(F.col("action") == "quarantined").select(
        *OBS_COLUMNS, canonical_number("prior_value").alias("prior_value"), F.lit("unexpected_revision").alias("reason")
    )


def merge_counts(decisions: DataFrame, keys: Sequence[str] = ("metric_id",)) -> DataFrame:
    def n(name: str) -> Column:
        return F.count_if(F.col("action") == name).alias(name)

    return decisions.groupBy(*keys).agg(n("added"), n("unchanged"), n("revised"), n("quarantined"))


def revision_count(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if(F.col("revision") > 0).alias("revisions"), F.count(F.lit(1)).alias("rows"))


def series_metadata(current: DataFrame) -> DataFrame:
    """Per series: size, span, newest fetch and the number of flagged periods."""
    return current.groupBy("metric_id", "geo_id").agg(
        F.max("source_id").alias("source_id"),
        F.max("unit").alias("unit"),
        F.count(F.lit(1)).alias("observations"),
        F.min("pidx").alias("first_pidx"),
        F.max("pidx").alias("last_pidx"),
        F.max("observation_end").alias("observation_end"),
        F.max("fetched_at").alias("fetched_at"),
        F.count_if(F.col("quality_flag") != "ok").alias("flagged"),
    )


def scan_current(log: DataFrame) -> DataFrame:
    """Usable current observations: latest revision, numeric value present."""
    return current_view(log).where(F.col("value").isNotNull() & ~F.isnan("value"))


#: Lanes of a digest, each 64 bits wide.
LANES = 4
_WHOLE = "18446744073709551616"  # 2 ** 64


def _lanes(text: Column) -> list[Column]:
    """The four 64-bit words of a row's SHA-256, as exact numbers."""
    word = lambda i: F.conv(F.substring(F.sha2(text, 256), 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")
    return [word(i) for i in range(LANES)]


def _summed(lanes: Sequence[Column]) -> Column:
    """Each lane summed modulo 2^64, in hexadecimal, one behind the other."""
    each = [F.pmod(F.coalesce(F.sum(lane), F.lit(0)).cast("decimal(38,0)"), F.expr(f"CAST({_WHOLE} AS DECIMAL(38,0))")) for lane in lanes]
    return F.lower(F.concat(*[F.lpad(F.conv(x.cast("string"), 10, 16), 16, "0") for x in each]))


def fingerprint(df: DataFrame, columns: Sequence[Column | str], keys: Sequence[str] = ()) -> DataFrame:
    """Order-free digest of a multiset of rows: their number and 256 bits.

    The four words of every row's SHA-256 are added modulo 2^64.  Sums combine
    on the map side and any permutation gives the same digest; a repeated row
    counts; digests of disjoint parts add up (:func:`add_fingerprints`).  Numbers
    enter in their canonical text.
    """
    kinds = dict(df.dtypes)
    parts = [
        canonical_number(c) if isinstance(c, str) and kinds.get(c) in ("double", "float") else F.col(c).cast("string")
        if isinstance(c, str)
        else c
        for c in columns
    ]
    text = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    hashed = df.select(*keys, *[lane.alias(f"_w{i}") for i, lane in enumerate(_lanes(text))])
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), _summed([F.col(f"_w{i}") for i in range(LANES)]).alias("digest"))


def add_fingerprints(added: DataFrame, removed: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """The digest of all rows behind the digests in ``added``, without those behind ``removed``.

    A history that grows needs only the digest of what is new; taking rows away is as cheap.
    """
    signed = added.select(*keys, "rows", "digest", F.lit(1).alias("_sign"))
    if removed is not None:
        signed = signed.unionByName(removed.select(*keys, "rows", "digest", F.lit(-1).alias("_sign")))
    lanes = [F.conv(F.substring("digest", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)") * F.col("_sign") for i in range(LANES)]
    return signed.groupBy(*keys).agg(F.sum(F.col("rows") * F.col("_sign")).alias("rows"), _summed(lanes).alias("digest"))


def periods_to_fetch(available: DataFrame, stored: DataFrame, recheck: int, key: str = "source_id") -> DataFrame:
    """Available periods outside the stored span, plus the last ``recheck``.

    The span of what is stored is one row per source, joined by key.
    """
    span = stored.groupBy(key).agg(F.min("pidx").alias("_lo"), F.max("pidx").alias("_hi"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("pidx").desc()))
    ranked = available.select(key, "pidx").distinct().withColumn("_rn", rank).join(span, key, "left")
    wanted = F.col("_lo").isNull() | (F.col("pidx") < F.col("_lo")) | (F.col("pidx") > F.col("_hi")) | (F.col("_rn") <= recheck)
    return ranked.where(wanted).select(key, "pidx")
