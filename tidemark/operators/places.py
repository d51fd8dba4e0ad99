"""Resolution of a place to the geography a metric is published at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge(places: DataFrame) -> DataFrame:
    """(place, geo_level, geo_id): where each level of a place is found.

    ``places`` has ``place, municipality, province, ccaa`` identifiers and the
    arrays ``airports`` and ``ports`` (only the first of each resolves).
    Sub-city levels are absent, so they never stand in for a city.
    """
    levels = F.array(
        *[F.struct(F.lit(l).alias("geo_level"), F.col(l).alias("geo_id")) for l in ("municipality", "province", "ccaa")],
        F.struct(F.lit("nation").alias("geo_level"), F.lit("es").alias("geo_id")),
        F.struct(F.lit("airport").alias("geo_level"), F.get("airports", F.lit(0)).alias("geo_id")),
        F.struct(F.lit("port").alias("geo_level"), F.get("ports", F.lit(0)).alias("geo_id")),
    )
    return places.select("place", F.inline(levels)).where(F.col("geo_id").isNotNull())


def resolve(rows: DataFrame, place_bridge: DataFrame) -> DataFrame:
    """Attach places to rows that carry ``geo_level`` and ``geo_id``."""
    return rows.join(place_bridge, ["geo_level", "geo_id"])


def parts_of(series: DataFrame, parts: DataFrame) -> DataFrame:
    """Series of the parts of each place, by the explicit parent column.

    ``parts`` is (place, part) with ``part`` the geography id of a district.
    """
    return series.join(parts.withColumnRenamed("part", "geo_id"), "geo_id")
