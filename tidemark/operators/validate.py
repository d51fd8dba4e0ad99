"""Record validation and the filters that decide what may be published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.geo import geo_is_valid
from tidemark.functions.periods import period_is_valid
from tidemark.functions.frames import join_null_safe
from tidemark.functions.stats import upper_median, upper_median_by
from tidemark.schema import SERIES_KEY


def _with_registry(records: DataFrame, metrics: DataFrame, ranges: DataFrame | None) -> DataFrame:
    registry = metrics.select(
        "metric_id",
        F.lit(True).alias("_known"),
        F.col("source_id").alias("_source"),
        F.col("cadence").alias("_cadence"),
        F.col("geo_level").alias("_level"),
        F.col("unit").alias("_unit"),
        F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"),
    )
    out = records.join(registry, "metric_id", "left")
    if ranges is not None:
        own = ranges.select("source_id", "metric_id", F.col("lo").alias("_olo"), F.col("hi").alias("_ohi"))
        out = out.join(own, ["source_id", "metric_id"], "left")
        out = out.withColumn("_lo", F.coalesce("_olo", "_lo")).withColumn("_hi", F.coalesce("_ohi", "_hi"))
        out = out.drop("_olo", "_ohi")
    return out


def _outside() -> Column:
    low = F.coalesce(F.col("value") < F.col("_lo"), F.lit(False))
    return low | F.coalesce(F.col("value") > F.col("_hi"), F.lit(False))


def with_reason(records: DataFrame, metrics: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Add ``reason``: the first check a record fails, NULL when it passes.

    ``metrics`` is the registry; as a declared table it is broadcast by its size;
    ``ranges`` optionally overrides the registry's range per source.
    """
    joined = _with_registry(records, metrics, ranges)
    reason = (
        F.when(F.col("_known").isNull(), "unknown_metric")
        .when(F.col("_source").isNotNull() & ~F.col("_source").eqNullSafe(F.col("source_id")), "wrong_source")
        .when(~period_is_valid("period", F.col("_cadence")), "bad_period")
        .when(~geo_is_valid("geo_id", F.col("geo_level")), "bad_geo")
        .when(~F.col("geo_level").eqNullSafe(F.col("_level")), "wrong_level")
        .when(~F.col("unit").eqNullSafe(F.col("_unit")), "wrong_unit")
        .when(_outside(), "out_of_range")
    )
    return joined.withColumn("reason", reason).select(*records.columns, "reason")


def batch_gate(checked: DataFrame, max_reject_ratio: float = 0.02, key: str = "source_id") -> DataFrame:
    """Per source: checked, rejected and whether the batch may be merged."""
    out = checked.groupBy(key).agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(F.col("reason").isNotNull()).alias("rejected")
    )
    return out.withColumn("passes", F.col("rejected") / F.col("checked") <= max_reject_ratio)


def admitted(checked: DataFrame, max_reject_ratio: float = 0.02, key: str = "source_id") -> DataFrame:
    """Valid records of the sources whose batch passes the gate."""
    good = batch_gate(checked, max_reject_ratio, key).where("passes").select(key)
    return checked.where(F.col("reason").isNull()).drop("reason").join(good, key, "left_semi")


def keep_valid(records: DataFrame, metrics: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Silent variant: known metric, right cadence, value in range."""
    joined = _with_registry(records, metrics, ranges)
    ok = F.col("_known").isNotNull() & period_is_valid("period", F.col("_cadence")) & ~_outside()
    return joined.where(ok).select(*records.columns)


def pick_cell(df: DataFrame, cells: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Table-driven selection of cube cells.

    ``cells`` declares one row per metric: the wanted value of each dimension
    plus ``metric_id`` and ``unit``.
    """
    return df.join(cells, list(dimensions))


def closed_only(df: DataFrame, as_of: str, end: str = "observation_end") -> DataFrame:
    """Drop periods still open on ``as_of``."""
    return df.where(F.col(end) < F.lit(as_of).cast("date"))


def incomplete_tail(
    df: DataFrame, key: str = "source_id", share: float = 0.4, window: int = 12, order: str = "pidx"
) -> DataFrame:
    """Trailing periods whose total is far below the recent normal.

    Normal is the upper median of the ``window`` periods before the latest;
    the run stops at the first complete period counted from the end.
    """
    totals = df.groupBy(key, order).agg(F.sum("value").alias("total"))
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    ranked = totals.withColumn("_rn", F.row_number().over(newest_first))
    recent = f"CASE WHEN _rn BETWEEN 2 AND {window + 1} THEN total END"
    normal = ranked.groupBy(key).agg(upper_median(recent).alias("_normal"), F.count(F.lit(1)).alias("_n"))
    judged = ranked.join(normal, key).where(F.col("_n") >= window + 1)
    complete = (F.col("total") >= F.lit(share) * F.col("_normal")).cast("int")
    seen = F.max(complete).over(newest_first.rowsBetween(Window.unboundedPreceding, 0))
    return judged.withColumn("_seen", seen).where(F.col("_seen") == 0).select(key, order)


def drop_incomplete_tail(df: DataFrame, key: str = "source_id", share: float = 0.4, window: int = 12, order: str = "pidx") -> DataFrame:
    return df.join(incomplete_tail(df, key, share, window, order), [key, order], "left_anti")


def coverage_gate(df: DataFrame, least: float = 0.7, keys: Sequence[str] = SERIES_KEY, cover: str = "value") -> DataFrame:
    """Drop series with too few positive rows; zeros of the rest are missing."""
    positive = F.avg(F.when(F.col(cover) > 0, 1.0).otherwise(0.0)).over(Window.partitionBy(*keys))
    return (
        df.withColumn("_cover", positive)
        .where((F.col("_cover") >= least) & F.col("value").isNotNull() & (F.col("value") != 0))
        .drop("_cover")
    )


def drop_low_volume(df: DataFrame, category: str, value: str, least: float = 500.0) -> DataFrame:
    """Drop categories whose upper median is below ``least``."""
    medians = upper_median_by(df, [category], value, out="_median")
    return join_null_safe(df, medians.where(F.col("_median") < least).select(category), [category], "left_anti")


def enabled_only(df: DataFrame, sources: DataFrame) -> DataFrame:
    off = sources.where(~F.col("enabled")).select("source_id")
    return df.join(off, "source_id", "left_anti")


def freshness(observation_end, max_age_days, as_of: str) -> Column:
    """fresh, stale, failing or unknown, by the age of the newest observation."""
    end = F.col(observation_end) if isinstance(observation_end, str) else observation_end
    limit = F.col(max_age_days) if isinstance(max_age_days, str) else max_age_days
    age = F.datediff(F.lit(as_of).cast("date"), end)
    return (
        F.when(limit.isNull() | end.isNull(), "unknown")
        .when(age <= limit, "fresh")
        .when(age <= limit * 2, "stale")
        .otherwise("failing")
    )
