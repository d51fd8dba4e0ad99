"""Oriented z-scores, weighted composite indices and signature matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import MAX_CARRY
from tidemark.functions.stats import upper_median
from tidemark.operators.series import (
    TRANSFORMS,
    carry_denominator,
    percent_change,
    series_window,
    to_months,
    transformed,
    year_before,
    zscored,
)

PER_STOCK = "per_1000_dwellings"


def per_stock(series: DataFrame, metrics: Sequence[str], stock: DataFrame, cadences: Sequence[str]) -> DataFrame:
    """Metrics per thousand units of a slow-moving stock of the same geography.

    The stock is first projected onto months when it is slower than the
    metric, then carried at most one year of the metric's own periods.
    """
    out = None
    for cadence in cadences:
        side = series.where(F.col("metric_id").isin(*metrics) & (F.col("cadence") == cadence))
        if cadence == "monthly":
            base = to_months(stock, keys=("geo_id",)).select("geo_id", F.col("month").alias("pidx"), "value")
        else:
            base = stock.where(F.col("cadence") == cadence).select("geo_id", "pidx", "value")
        if len(metrics) > 1:
            # Several metrics of one geography share the base: one copy each.
            names = F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric_id")
            base, keys = base.select("*", names), ("metric_id", "geo_id")
        else:
            keys = ("geo_id",)
        part = carry_denominator(side, base, MAX_CARRY[cadence], keys=keys, scale=1000.0)
        out = part if out is None else out.unionByName(part)
    return out


def oriented(
    series: DataFrame,
    pairs: DataFrame,
    names: Sequence[str],
    cadences: Sequence[str] = ("monthly",),
    stock: DataFrame | None = None,
    stock_metrics: Sequence[str] = (),
    stock_cadences: Sequence[str] = ("monthly",),
    bound: float = 4.0,
) -> DataFrame:
    """Monthly oriented z-scores of the declared (metric, transform) pairs.

    ``series`` needs ``metric_id, geo_id, geo_level, cadence, pidx, value``;
    ``pairs`` is the literal table (metric_id, transform, direction) and
    ``stock_metrics`` (of ``stock_cadences``) are read per unit of ``stock``.  Scores
    are formed per series in its own cadence, before any place reads them, so
    a series shared by many places is computed once.
    """
    unknown = sorted(set(names) - set(TRANSFORMS) - {PER_STOCK})
    if unknown:
        raise ValueError(f"unknown transforms: {unknown}")
    plain = [n for n in names if n in TRANSFORMS]
    columns = ["metric_id", "geo_id", "geo_level", "cadence", "pidx", "value"]
    wanted = pairs.select("metric_id", "transform", "direction").distinct()
    used = series.select(*columns).join(pairs.select("metric_id").distinct(), "metric_id", "left_semi")
    raw = transformed(used, plain, cadences).join(wanted, ["metric_id", "transform"])
    if stock is not None and stock_metrics:
        per = per_stock(used, stock_metrics, stock, stock_cadences).select(*columns)
        per = per.withColumn("transform", F.lit(PER_STOCK)).withColumn("raw", F.col("value"))
        raw = raw.unionByName(per.join(wanted, ["metric_id", "transform"]))
    scored = zscored(raw, bound=bound).where(F.col("z").isNotNull())
    scored = scored.withColumn("oriented", F.col("z") * F.col("direction"))
    return to_months(scored, keys=("metric_id", "geo_id", "transform"), value_columns=("raw", "z", "oriented")).drop("value")


def index_history(scores: DataFrame, components: DataFrame) -> DataFrame:
    """Weighted mean of the available components, per place, index and month.

    ``scores`` carries ``place`` (see ``places.resolve``); ``components`` is the
    literal table (index_id, metric_id, transform, weight, min_components).
    """
    joined = scores.join(components, ["metric_id", "transform"])
    out = joined.groupBy("place", "index_id", "month").agg(
        (F.sum(F.col("oriented") * F.col("weight")) / F.sum("weight")).alias("value"),
        F.count(F.lit(1)).alias("n"),
        F.max("min_components").alias("_need"),
    )
    return out.where(F.col("n") >= F.col("_need")).drop("_need")


def current_components(scores: DataFrame, components: DataFrame) -> DataFrame:
    """Newest score of each component of each index of a place."""
    newest = scores.groupBy("place", "metric_id", "transform").agg(
        F.max_by(F.struct("geo_id", "geo_level", "raw", "z", "oriented"), "month").alias("_r"), F.max("month").alias("month")
    )
    flat = newest.select("place", "metric_id", "transform", "month", "_r.*")
    return flat.join(components, ["metric_id", "transform"])


def current_index(scores: DataFrame, components: DataFrame) -> DataFrame:
    """Index from the newest value of each component, with the oldest used."""
    out = current_components(scores, components).groupBy("place", "index_id").agg(
        (F.sum(F.col("oriented") * F.col("weight")) / F.sum("weight")).alias("_value"),
        F.count(F.lit(1)).alias("n"),
        F.max("min_components").alias("_need"),
        F.max("month").alias("_month"),
        F.min("month").alias("oldest_component"),
    )
    enough = F.col("n") >= F.col("_need")
    return out.select(
        "place",
        "index_id",
        F.when(enough, F.col("_value")).alias("value"),
        F.when(enough, F.col("_month")).alias("month"),
        "n",
        (~enough).alias("insufficient"),
        "oldest_component",
    )


def provisional_releases(
    series: DataFrame,
    cadences: Sequence[str] = ("monthly",),
    least: int = 4,
    same_sign: float = 0.6,
    move: float = 40.0,
) -> DataFrame:
    """(metric, period) where most geographies moved sharply the same way.

    Looks at each metric's newest period over all its geographies.
    """
    w = series_window()
    moved = series.withColumn("_yoy", percent_change(F.col("value"), year_before("value", w, cadences)))
    newest = series.groupBy("metric_id").agg(
        F.max("pidx").alias("pidx"), F.count_distinct("geo_id").alias("geographies")
    )
    at_end = moved.join(newest, ["metric_id", "pidx"])
    out = at_end.groupBy("metric_id", "pidx").agg(
        F.max("geographies").alias("geographies"),
        F.count("_yoy").alias("n"),
        F.count_if(F.col("_yoy") > 0).alias("up"),
        F.count_if(F.col("_yoy") < 0).alias("down"),
        upper_median("abs(_yoy)").alias("median_move"),
    )
    return out.withColumn(
        "provisional",
        (F.col("geographies") >= least)
        & (F.col("n") >= least)
        & (F.greatest("up", "down") / F.col("n") >= same_sign)
        & F.coalesce(F.col("median_move") > move, F.lit(False)),
    )


def match_signatures(
    scores: DataFrame,
    signals: Sequence[tuple[str, str, str, str]],
    places: DataFrame,
    threshold: float = 0.5,
    min_coverage: float = 0.34,
) -> DataFrame:
    """How much of each archetype's declared pattern a place shows.

    ``signals`` declares (archetype, metric, transform, expect up or down).  A
    signal fires on the plain z-score in its expected direction.
    """
    newest = scores.groupBy("place", "metric_id", "transform").agg(F.max_by("z", "month").alias("z"))
    fields = ("archetype_id", "metric_id", "transform", "expect")
    declared = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, row)]) for row in signals])
    asked = places.select("place").distinct().select("place", F.inline(declared))
    seen = asked.join(newest, ["place", "metric_id", "transform"], "left")
    fires = F.when(F.col("expect") == "up", F.col("z") >= threshold).otherwise(F.col("z") <= -threshold)
    out = seen.groupBy("place", "archetype_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("z").alias("available"),
        F.count_if(fires).alias("firing"),
        F.sort_array(F.collect_list(F.when(fires, F.col("metric_id")))).alias("signals_firing"),
        F.sort_array(F.collect_list(F.when(~fires, F.col("metric_id")))).alias("signals_against"),
        F.sort_array(F.collect_list(F.when(F.col("z").isNull(), F.col("metric_id")))).alias("signals_unavailable"),
    )
    coverage = F.col("available") / F.col("total")
    return out.select(
        "*",
        coverage.alias("coverage"),
        F.try_divide(F.col("firing"), F.col("available")).alias("score"),
        (coverage < min_coverage).alias("insufficient"),
    )


def ranked_signatures(matches: DataFrame) -> DataFrame:
    """Order archetypes per place: score, then coverage, missing scores last."""
    order = Window.partitionBy("place").orderBy(
        F.col("score").desc_nulls_last(), F.col("coverage").desc(), F.col("archetype_id")
    )
    return matches.withColumn("position", F.row_number().over(order))


