"""Probability of entering a distressed regime within a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.neighbours import nearest
from tidemark.operators.regimes import INDEX_IDS
from tidemark.operators.series import any_ahead, episodes, full_ahead, series_window

# Distressed states, neighbours, embargo, least candidates.
DISTRESS = ["stress", "dislocation"]
K = 20
EMBARGO = 12
LEAST = 8
MATERIAL_DIFFERENCE = 0.02


def labelled(timeline: DataFrame, window: int, into: Sequence[str] = DISTRESS) -> DataFrame:
    """Mark distress, episode starts, and whether distress follows in the window."""
    w = series_window(("place",), "month")
    flagged = timeline.withColumn("distressed", F.col("rule_id").isin(*into))
    marked = episodes(flagged, "distressed", ("place",), "month")
    return marked.withColumns({"enters": any_ahead("distressed", window, w), "complete": full_ahead(window, w)})


def base_rate(marked: DataFrame) -> DataFrame:
    """Pooled frequency of entering distress, and how many episodes it rests on."""
    known = F.col("complete")
    return marked.agg(
        F.avg(F.when(known, F.col("enters").cast("double"))).alias("base_rate"),
        F.count_if(known).alias("windows"),
        F.count_if(known & F.col("starts")).alias("episodes"),
    )


def state_vectors(timeline: DataFrame, index_ids: Sequence[str] = INDEX_IDS) -> DataFrame:
    """Complete index states as vectors; incomplete months have none."""
    parts = F.array(*[F.col(i) for i in sorted(index_ids)])
    return timeline.withColumn("vector", parts).where(~F.exists("vector", lambda x: x.isNull()))


def analog_transition(
    marked: DataFrame,
    k: int = K,
    embargo: int = EMBARGO,
    index_ids: Sequence[str] = INDEX_IDS,
    blocks: int | None = None,
    slices: int = 1,
) -> DataFrame:
    """Estimate per place from the most similar states of all places.

    Smoothed by one hit and one miss; below eight candidates the base rate is
    reported instead.
    """
    states = state_vectors(marked, index_ids)
    newest = states.groupBy("place").agg(F.max_by(F.struct("month", "vector"), "month").alias("t"))
    targets = newest.select(F.col("place").alias("target"), "place", F.col("t.month").alias("month"), F.col("t.vector").alias("vector"))
    pool = states.where("complete").select("place", "month", F.col("enters").cast("int").alias("hit"), "vector")
    near = nearest(pool, targets, k, ("place", "month"), ("hit",), embargo, blocks, slices)
    found = near.groupBy("target").agg(
        F.count(F.lit(1)).alias("neighbours"), F.sum("hit").alias("hits"), F.min("distance").alias("nearest_distance")
    )
    # The pooled counts are one row: a scalar subquery, not a join.
    rate = base_rate(marked).select(F.struct("base_rate", "episodes").alias("r")).scalar()
    out = marked.select("place").distinct().join(found.withColumnRenamed("target", "place"), "place", "left")
    out = out.withColumn("_rate", rate).select("*", "_rate.base_rate", "_rate.episodes")
    enough = F.coalesce(F.col("neighbours") >= LEAST, F.lit(False))
    probability = F.when(enough, (F.col("hits") + 1) / (F.col("neighbours") + 2)).otherwise(F.col("base_rate"))
    confidence = (
        F.when(~enough, "low")
        .when((F.col("episodes") >= 6) & (F.col("neighbours") >= 15), "moderate")
        .when(F.col("episodes") >= 3, "low")
        .otherwise("very low")
    )
    return out.select(
        "place",
        probability.alias("probability"),
        F.when(enough, "analog_frequency").otherwise("base_rate").alias("model"),
        F.when(enough, F.col("neighbours")).otherwise(0).alias("neighbours"),
        F.when(enough, F.col("nearest_distance")).alias("nearest_distance"),
        "base_rate",
        "episodes",
        confidence.alias("confidence"),
        (F.abs(probability - F.col("base_rate")) > MATERIAL_DIFFERENCE).alias("beats_base_rate"),
    )
