"""Roll-ups from raw facts to period observations.

Each is a ``groupBy`` whose partial aggregation runs before the exchange, so a
key holding a large share of the facts arrives as one small row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import series_window


def sum_by(df: DataFrame, keys: Sequence[str], *columns: str, out: str = "value") -> DataFrame:
    """Sum one or more columns across, then down."""
    across = F.lit(0.0)
    for c in columns:
        across = across + F.coalesce(F.col(c), F.lit(0.0))
    return df.groupBy(*keys).agg(F.sum(across).alias(out))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def mean_by(df: DataFrame, keys: Sequence[str], column: str, out: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(column).alias(out))


def last_in_period(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str = "value") -> DataFrame:
    """Value of the latest dated row per key; later ``order`` columns break ties."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(out))


def share_by(df: DataFrame, keys: Sequence[str], subset: Column, weight: Column | None = None, out: str = "value") -> DataFrame:
    """Percent of the (weighted) rows of a key that belong to the subset."""
    w = F.lit(1) if weight is None else weight
    part = F.sum(F.when(subset, w).otherwise(F.lit(0)))
    return df.groupBy(*keys).agg(F.try_divide(F.lit(100.0) * part, F.sum(w)).alias(out))


def kind_ratio(
    df: DataFrame, keys: Sequence[str], kind: str, num: str, den: str, value: str, scale: float = 1.0, out: str = "value"
) -> DataFrame:
    """Pivot two kinds of a long table into columns and divide them."""
    wide = df.where(F.col(kind).isin(num, den)).groupBy(*keys).agg(
        F.max(F.when(F.col(kind) == num, F.col(value))).alias("_n"),
        F.max(F.when(F.col(kind) == den, F.col(value))).alias("_d"),
    )
    kept = wide.where(F.col("_n").isNotNull() & (F.col("_d") != 0))
    return kept.select(*keys, (F.lit(scale) * F.col("_n") / F.col("_d")).alias(out))


def multi_holder_share(df: DataFrame, keys: Sequence[str], owner: str, out: str = "value") -> DataFrame:
    """Percent of rows whose owner holds more than one row of the key.

    Counting per owner first keeps a dominant owner to one partial row per
    task; no window over the facts is needed.
    """
    held = df.groupBy(*keys, owner).agg(F.count(F.lit(1)).alias("_n"))
    many = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.lit(0)))
    return held.groupBy(*keys).agg((F.lit(100.0) * many / F.sum("_n")).alias(out))


def attention_per_million(views: DataFrame, totals: DataFrame, keys: Sequence[str], edition: str, n: str = "views") -> DataFrame:
    """Views per million of all traffic on the editions that read the key.

    ``views`` is (keys, edition, n) and ``totals`` (period, edition, n); the
    denominator sums only editions present for that key.
    """
    period = [k for k in keys if k in totals.columns]
    per = views.groupBy(*keys, edition).agg(F.sum(n).alias("_v"))
    both = per.join(totals.select(*period, edition, F.col(n).alias("_t")), [*period, edition], "left")
    out = both.groupBy(*keys).agg(F.sum("_v").alias("_v"), F.sum(F.coalesce(F.col("_t"), F.lit(0))).alias("_t"))
    return out.where(F.col("_t") > 0).select(*keys, (F.lit(1e6) * F.col("_v") / F.col("_t")).alias("value"))


def base_ratio(df: DataFrame, keys: Sequence[str], category: str, base: str, n: str = "views", out: str = "value") -> DataFrame:
    """Everything outside the base category, in percent of the base."""
    agg = df.groupBy(*keys).agg(
        F.sum(F.when(F.col(category) == base, F.col(n))).alias("_b"),
        F.sum(F.when(F.col(category) != base, F.col(n)).otherwise(F.lit(0))).alias("_o"),
    )
    return agg.where(F.col("_b") > 0).select(*keys, (F.lit(100.0) * F.col("_o") / F.col("_b")).alias(out))


def pool_parts(parts: DataFrame, keys: Sequence[str], how: Column, least_periods: int = 8, order: str = "pidx") -> DataFrame:
    """Pool parts (districts) into the whole: mean for rates, sum for counts.

    Only series with at least ``least_periods`` pooled periods are kept.
    """
    pooled = parts.withColumn("_how", how).groupBy(*keys, order).agg(
        F.max("_how").alias("_how"), F.avg("value").alias("_mean"), F.sum("value").alias("_sum")
    )
    valued = pooled.select(
        *keys, order, F.when(F.col("_how") == "mean", F.col("_mean")).otherwise(F.col("_sum")).alias("value")
    )
    whole = series_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return valued.withColumn("_n", F.count(F.lit(1)).over(whole)).where(F.col("_n") >= least_periods).drop("_n")


def bounding_box(df: DataFrame, keys: Sequence[str], points: str) -> DataFrame:
    """Bounds of an array of (x, y) pairs, over all arrays of the key."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return df.groupBy(*keys).agg(
        F.min(F.array_min(xs)).alias("min_x"),
        F.min(F.array_min(ys)).alias("min_y"),
        F.max(F.array_max(xs)).alias("max_x"),
        F.max(F.array_max(ys)).alias("max_y"),
    )
