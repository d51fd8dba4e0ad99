"""Statistical Column expressions and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.frames import join_null_safe
from tidemark.session import cut_lineage

# Abramowitz and Stegun 7.1.26, |error| <= 1.5e-7.
_ERF_P = 0.3275911
_ERF_A = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x, bound: float) -> Column:
    """Bounds applied only to present values (``least`` would ignore NULL)."""
    return F.when(_c(x).isNotNull(), F.greatest(F.lit(-bound), F.least(F.lit(bound), _c(x))))


def normal_cdf(z) -> Column:
    x = F.abs(_c(z)) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_ERF_P) * x)
    poly = reduce(lambda acc, a: (acc + F.lit(a)) * t, reversed(_ERF_A[1:]), F.lit(0.0))
    erf = F.lit(1.0) - (poly + F.lit(_ERF_A[0])) * t * F.exp(-x * x)
    return F.lit(0.5) * (F.lit(1.0) + F.when(_c(z) < 0, -erf).otherwise(erf))


def diffusion(z, bound: float = 4.0) -> Column:
    """Percentile 0-100 of a z-score; 50 is typical."""
    return F.round(normal_cdf(clip(z, bound)) * 100, 0)


def orient_percentile(index, direction) -> Column:
    return F.when(_c(direction) < 0, F.lit(100.0) - _c(index)).otherwise(_c(index))


def reading(index) -> Column:
    """Word for an oriented 0-100 index."""
    i = _c(index)
    return (
        F.when(i.isNull(), "unknown")
        .when(i >= 60, "expansionary")
        .when(i <= 40, "contractionary")
        .otherwise("neutral")
    )


def composite_band(index) -> Column:
    """Word for a composite: five bands of a 0-100 index."""
    i = _c(index)
    return (
        F.when(i.isNull(), "unknown")
        .when(i >= 70, "running hot")
        .when(i >= 60, "busier than usual")
        .when(i >= 40, "close to normal")
        .when(i >= 30, "quieter than usual")
        .otherwise("well below normal")
    )


def pinball(actual, quantile, q: float) -> Column:
    d = _c(actual) - _c(quantile)
    return F.greatest(F.lit(q) * d, F.lit(q - 1.0) * d)


def mean_pinball(actual, p10, p50, p90) -> Column:
    """Mean quantile loss over the three quantiles; NULL if one is missing."""
    return (pinball(actual, p10, 0.1) + pinball(actual, p50, 0.5) + pinball(actual, p90, 0.9)) / F.lit(3.0)


def pearson(x, y) -> Column:
    """Population Pearson correlation of the rows where both are present.

    NULL for fewer than three pairs or a constant side.
    """
    both = _c(x).isNotNull() & _c(y).isNotNull()
    xx, yy = F.when(both, _c(x)), F.when(both, _c(y))
    spread = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.when(F.count(xx) >= 3, F.try_divide(F.covar_pop(xx, yy), F.when(spread != 0, spread)))


def upper_median(expression: str) -> Column:
    """``sorted(x)[n // 2]`` of an SQL expression, for bounded groups.

    The aggregate buffers one entry per distinct value, so it is meant for
    groups bounded by a calendar or a dimension; :func:`upper_median_by` has no
    such limit.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {expression} DESC)")


def upper_median_by(
    df: DataFrame, keys: list[str], value: str, out: str = "median", count: str | None = None, steps: int = 50, bound: int = 100_000
) -> DataFrame:
    """Exact upper median per key, whatever the group size; NULL keys are a group.

    Infinite values and NaN have their usual places at the ends of the order.
    A first pass counts the values of each key and sketches its quantiles, whose
    known error gives a bracket that holds the middle for certain; a second pass
    counts what lies below the bracket and the distinct values inside it.  ``df``
    is read twice and never copied, and every shuffle carries partial
    aggregates, so a key with a large share of the rows is never gathered.  Only
    where a bracket has more than ``bound`` distinct values is it cut again,
    among these.  ``count`` adds the number of values.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.col(value).cast("double").alias("_x"))
    infinite = F.lit(float("inf"))
    finite = ~F.isnan("_x") & (F.abs("_x") < infinite)
    # the sketch errs by a thousandth of the rows, far less than a step
    at = F.percentile_approx(F.when(finite, F.col("_x")), [i / steps for i in range(steps + 1)], max(1000, 20 * steps))
    n = F.count(F.lit(1))
    spans = rows.groupBy(*keys).agg(
        n.alias("_all"), F.count_if(F.col("_x") == -infinite).alias("_neg"), F.count_if(finite).alias("_fin"),
        F.count_if(F.col("_x") == infinite).alias("_pos"), at.alias("_at"),
    )
    # the zero-based position of the middle
    rank = F.floor(F.col("_all") / F.lit(2.0)).cast("bigint")
    inside = F.col("_rank") - F.col("_neg")
    step = F.floor(F.lit(float(steps)) * inside / F.col("_fin")).cast("int")
    end = F.when(inside < 0, F.lit(float("-inf"))).when(inside - F.col("_fin") < F.col("_pos"), infinite).otherwise(F.lit(float("nan")))
    spans = spans.withColumn("_rank", rank).withColumn("_end", F.when((inside < 0) | (inside >= F.col("_fin")), end))
    low, high = (F.element_at("_at", i) for i in (F.greatest(step, F.lit(1)), F.least(step + 3, F.lit(steps + 1))))
    spans = cut_lineage(spans.withColumns({"_lo": F.when(F.col("_end").isNull(), low), "_hi": F.when(F.col("_end").isNull(), high)}).drop("_at"))

    near = join_null_safe(rows, spans.where("_end IS NULL").select(*keys, "_rank", "_lo", "_hi"), keys).where("_x <= _hi")
    held = F.when(F.col("_x") >= F.col("_lo"), F.col("_v"))
    near = near.groupBy(*keys, held.alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in ("_rank", "_lo", "_hi")])
    near = cut_lineage(near)

    def running(order: Column | str) -> Column:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum("_n").over(w)

    def widest() -> int:
        return near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0] or 0

    while widest() > bound:
        # halves, so that the widest range does not overflow
        x, lo, hi = (F.col(c).cast("double") / 2 for c in ("_v", "_lo", "_hi"))
        place = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * 1000), F.lit(999))).otherwise(F.lit(0))
        stepped = near.withColumn("_step", F.when(F.col("_v").isNull(), -1).otherwise(place).cast("int"))
        # at most a thousand rows for a key
        span = [F.min("_v").cast("double").alias("_lo"), F.max("_v").cast("double").alias("_hi")]
        ladder = stepped.groupBy(*keys, "_step").agg(F.sum("_n").alias("_n"), F.max("_rank").alias("_rank"), *span)
        ladder = ladder.withColumn("_upto", running("_step")).where(F.col("_upto") > F.col("_rank"))
        first = F.min_by(F.struct("_step", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), "_lo", "_hi"), F.col("_step"))
        hit = ladder.groupBy(*keys).agg(first.alias("_h")).select(*keys, "_h.*")
        near = join_null_safe(stepped.drop("_rank", "_lo", "_hi"), hit.withColumnRenamed("_step", "_hit"), keys).where("_step = _hit")
        near = cut_lineage(near.select(*keys, "_v", "_n", "_rank", "_lo", "_hi"))
    reached = near.withColumn("_upto", running(F.asc_nulls_first("_v"))).where(F.col("_upto") > F.col("_rank"))
    middle = reached.groupBy(*keys).agg(F.min("_v").alias(out))
    found = join_null_safe(spans.select(*keys, "_all", "_end"), middle, keys, "left")
    kind = df.schema[value].dataType
    found = found.withColumn(out, F.coalesce(out, F.col("_end").cast(kind)) if str(kind) in ("DoubleType()", "FloatType()") else F.col(out))
    return found.select(*keys, out, *([] if count is None else [F.col("_all").alias(count)]))
