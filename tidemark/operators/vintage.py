"""What was known when: publication dates, as-of views and their fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import fingerprint
from tidemark.schema import OBS_KEY

# Declared publication lags in days, and the lag of other sources.
DEFAULT_LAG_DAYS = 60
PUBLICATION_LAGS = [
    ("ine", 45),
    ("sepe", 3),
    ("segsocial", 15),
    ("mivau", 90),
    ("bde", 10),
    ("aena", 20),
    ("eurocontrol", 4),
    ("cgpj", 95),
    ("borme", 30),
    ("dgt", 20),
    ("puertos", 45),
    ("wikipedia", 2),
    ("insideairbnb", 30),
    ("madrid_padron", 30),
    ("madrid_locales", 1),
    ("madrid_vut", 30),
    ("trends_manual", 7),
]


def with_known_from(
    log: DataFrame, lags: DataFrame, default_days: int = DEFAULT_LAG_DAYS, restated_after_fetch: bool = False
) -> DataFrame:
    """Add ``known_from`` and its ``basis``.

    The publication date where there is one, else the end of the period plus
    the declared lag of the source.  With ``restated_after_fetch`` a restated
    row without a publication date is known only from its fetch.
    """
    lagged = F.date_add("observation_end", F.coalesce(F.col("_lag"), F.lit(default_days)))
    if restated_after_fetch:
        lagged = F.when(F.col("revision") > 0, F.greatest("fetched_at", lagged)).otherwise(lagged)
    small = lags.select("source_id", F.col("days").alias("_lag"))
    return (
        log.join(small, "source_id", "left")
        .withColumn("known_from", F.coalesce("published_at", lagged))
        .withColumn("basis", F.when(F.col("published_at").isNotNull(), "published_at").otherwise("declared_lag"))
        .drop("_lag")
    )


def visible(dated: DataFrame, as_of: str) -> DataFrame:
    return dated.where(F.col("value").isNotNull() & (F.col("known_from") <= F.lit(as_of).cast("date")))


def as_of(dated: DataFrame, when: str, keys: Sequence[str] = OBS_KEY) -> DataFrame:
    """Series as they stood on a date: highest revision already known.

    Of equal revisions the one known first is kept.
    """
    rest = [c for c in dated.columns if c not in keys]
    rank = F.struct("revision", -F.unix_date("known_from"), -F.col("seq"))
    best = visible(dated, when).groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def as_of_many(dated: DataFrame, dates: Sequence[str], keys: Sequence[str] = OBS_KEY) -> DataFrame:
    """As-of views for a declared list of dates.

    Each row is copied only to the dates that can see it, then the best
    revision per key and date is taken with a map-side combine.
    """
    wanted = F.array(*[F.lit(d).cast("date") for d in dates])
    seen = dated.where(F.col("value").isNotNull()).withColumn(
        "as_of", F.explode(F.filter(wanted, lambda d: d >= F.col("known_from")))
    )
    rank = F.struct("revision", -F.unix_date("known_from"), -F.col("seq"))
    return seen.groupBy(*keys, "as_of").agg(
        F.max_by("value", rank).alias("value"), F.max("revision").alias("revision")
    )


def basis_summary(dated: DataFrame, as_of: str) -> DataFrame:
    return visible(dated, as_of).groupBy("basis").agg(F.count(F.lit(1)).alias("rows"))


def vintage_fingerprint(dated: DataFrame, as_of: str) -> DataFrame:
    """Digest of exactly the rows visible on a date."""
    return fingerprint(visible(dated, as_of), ["metric_id", "geo_id", "period", "revision", "value"])
