"""Desk view: official figures in real units, unusual signals as 0-100 indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import diffusion, orient_percentile, reading
from tidemark.operators.series import expanding_z, percent_change, series_window, year_before

MIN_HISTORY = 24
LEAST_POINTS = 8

# How a district metric becomes one city figure.
POOLING = {
    "osm_food_share": "mean",
    "osm_tourist_retail": "mean",
    "osm_cafe_bar_ratio": "mean",
    "locales_vacancy_rate": "mean",
    "rent_district_m2": "mean",
    "horeca_openings": "sum",
    "horeca_closures": "sum",
    "locales_stock": "sum",
    "horeca_stock": "sum",
    "vut_licensed": "sum",
    "licences_granted": "sum",
    "padron_district": "sum",
    "wiki_barrio_views": "sum",
    "search_barrio_attention": "mean",
}


def pooling_rule(metric, table: dict[str, str] = POOLING):
    """Pooling rule of a metric Column; NULL when none is declared."""
    out = None
    for name, how in table.items():
        out = F.when(metric == name, how) if out is None else out.when(metric == name, how)
    return out


def own_or_pooled(own: DataFrame, pooled: DataFrame, least: int = LEAST_POINTS) -> DataFrame:
    """The place's own series when long enough, else its pooled districts.

    Both sides carry ``place, metric_id, cadence, pidx, value``.
    """
    columns = ["place", "metric_id", "cadence", "pidx", "value"]
    both = own.select(*columns, F.lit(True).alias("_own")).unionByName(pooled.select(*columns, F.lit(False).alias("_own")))
    whole = Window.partitionBy("place", "metric_id")
    counted = both.withColumns(
        {"_n_own": F.count_if("_own").over(whole), "_n_pool": F.count_if(~F.col("_own")).over(whole)}
    )
    use_own = F.col("_own") & (F.col("_n_own") >= least)
    use_pool = ~F.col("_own") & (F.col("_n_own") < least) & (F.col("_n_pool") >= least)
    return counted.where(use_own | use_pool).select(*columns, (~F.col("_own")).alias("pooled"))


def entries(series: DataFrame, directions: DataFrame, cadences: Sequence[str] = ("monthly",), min_history: int = MIN_HISTORY) -> DataFrame:
    """Newest reading of every place and metric.

    ``directions`` is the literal table (metric_id, direction).  Gives value,
    yoy and z for the tape, and the oriented index, its predecessor and its
    reading for the signals.
    """
    w = series_window(("place", "metric_id"))
    scored = series.withColumns(
        {
            "z": expanding_z("value", w, min_history),
            "yoy": percent_change(F.col("value"), year_before("value", w, cadences)),
        }
    ).withColumn("z_prev", F.lag("z").over(w))
    newest = scored.groupBy("place", "metric_id").agg(
        F.max_by(F.struct("cadence", "pidx", "value", "yoy", "z", "z_prev"), "pidx").alias("_r"),
        F.count(F.lit(1)).alias("observations"),
    )
    flat = newest.select("place", "metric_id", "observations", "_r.*").join(directions, "metric_id")
    raw = flat.withColumn("percentile_raw", diffusion("z"))
    return raw.withColumns(
        {
            "index": orient_percentile("percentile_raw", "direction"),
            "index_prev": orient_percentile(diffusion("z_prev"), "direction"),
            "inverted": F.col("direction") < 0,
        }
    ).withColumn("read", reading("index"))


def composite(signals: DataFrame, keys: Sequence[str] = ("place",)) -> DataFrame:
    """Plain mean of the oriented indices of a place."""
    return signals.groupBy(*keys).agg(
        F.round(F.avg("index"), 0).alias("composite"), F.count("index").alias("composite_n")
    )


def top_signals(signals: DataFrame, n: int = 2) -> DataFrame:
    """Signals furthest from typical, per place."""
    order = Window.partitionBy("place").orderBy(F.abs(F.col("index") - 50).desc(), "metric_id")
    return signals.where(F.col("index").isNotNull()).withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
