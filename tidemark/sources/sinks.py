"""Sinks: history, quarantine, derived documents, frozen forecasts, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORECAST_KEY = ["target_id", "geo_id", "from_pidx"]


def write_history(df: DataFrame, path: str, files_per_metric: int = 16, mode: str = "overwrite") -> None:
    """Partitioned by source and metric, sorted by geography, period, revision.

    Only partitions present in ``df`` are replaced.  ``files_per_metric`` spreads
    a metric that holds much of the data over several tasks.
    """
    salt = F.pmod(F.xxhash64("geo_id"), F.lit(files_per_metric))
    (
        df.repartition("source_id", "metric_id", salt)
        .sortWithinPartitions("source_id", "metric_id", "geo_id", "pidx", "revision")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_id", "metric_id")
        .parquet(path)
    )


def append_quarantine(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("source_id").parquet(path)


def write_documents(df: DataFrame, path: str, by: str = "place") -> None:
    """One JSON folder per place."""
    df.repartition(by).write.mode("overwrite").partitionBy(by).json(path)


def unfrozen(issued: DataFrame, frozen: DataFrame | None, keys: Sequence[str] = FORECAST_KEY) -> DataFrame:
    """Forecasts not frozen before, one row for each key (the least); frozen ones are never rewritten."""
    rest = [c for c in issued.columns if c not in keys]
    once = issued.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*issued.columns)
    if frozen is None:
        return once
    return once.join(frozen.select(*keys), list(keys), "left_anti")


def freeze_forecasts(issued: DataFrame, frozen: DataFrame | None, path: str) -> None:
    unfrozen(issued, frozen).write.mode("append").partitionBy("target_id").parquet(path)


def append_scores(scores: DataFrame, existing: DataFrame | None, path: str) -> None:
    unfrozen(scores, existing).write.mode("append").parquet(path)
