"""Canonical observation schema and the enumerations it is checked against."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES_KEY = ["metric_id", "geo_id"]
OBS_KEY = ["metric_id", "geo_id", "period"]

OBSERVATION = T.StructType(
    [
        T.StructField("metric_id", T.StringType()),
        T.StructField("geo_id", T.StringType()),
        T.StructField("geo_level", T.StringType()),
        T.StructField("cadence", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("pidx", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("observation_end", T.DateType()),
        T.StructField("published_at", T.DateType()),
        T.StructField("fetched_at", T.DateType()),
        T.StructField("quality_flag", T.StringType()),
        T.StructField("revision", T.IntegerType()),
        T.StructField("seq", T.LongType()),
    ]
)

OBS_COLUMNS = OBSERVATION.fieldNames()

# The allowed quality flags.
QUALITY_FLAGS = ["ok", "revised", "suspect", "estimated", "stale_denominator"]
