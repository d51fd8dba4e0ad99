"""Dimension tables and versioned declarations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.vintage import PUBLICATION_LAGS
from tidemark.session import literal_table

METRIC_SCHEMA = (
    "metric_id string, label string, unit string, cadence string, geo_level string, source_id string, "
    "section string, direction int, lo double, hi double"
)
SOURCE_SCHEMA = (
    "source_id string, publisher string, kind string, cadence string, max_age_days int, enabled boolean, "
    "revisions_allowed boolean"
)
CITY_SCHEMA = (
    "place string, name string, municipality string, province string, ccaa string, airports array<string>, "
    "ports array<string>, aliases array<string>, wikipedia map<string,string>"
)
COMPONENT_SCHEMA = "index_id string, metric_id string, transform string, weight double, min_components int"

# The components of the four sub-indices, second version.
INDEX_COMPONENTS = [
    ("demand_momentum", "affiliations", "yoy", 1.2, 2),
    ("demand_momentum", "unemployment_registered", "yoy", 1.2, 2),
    ("demand_momentum", "contracts_registered", "yoy", 0.8, 2),
    ("demand_momentum", "population_padron", "yoy", 1.0, 2),
    ("demand_momentum", "property_transfers", "yoy", 0.8, 2),
    ("demand_momentum", "airport_flights", "yoy", 0.6, 2),
    ("demand_momentum", "wiki_city_attention", "yoy", 0.4, 2),
    ("housing_pressure", "rent_reference", "yoy", 1.3, 2),
    ("housing_pressure", "appraised_value", "yoy", 1.0, 2),
    ("housing_pressure", "house_price_index", "yoy", 1.0, 2),
    ("housing_pressure", "housing_transactions", "per_1000_dwellings", 0.8, 2),
    ("housing_pressure", "tourist_dwellings", "per_1000_dwellings", 0.8, 2),
    ("housing_pressure", "hotel_occupancy_rate", "level", 0.5, 2),
    ("housing_pressure", "str_listings", "per_1000_dwellings", 0.6, 2),
    ("housing_pressure", "search_rental_pressure", "yoy", 0.4, 2),
    ("supply_response", "housing_starts", "yoy", 1.2, 2),
    ("supply_response", "housing_completions", "yoy", 1.0, 2),
    ("supply_response", "dwelling_stock", "yoy", 0.8, 2),
    ("supply_response", "locales_openings", "yoy", 0.4, 2),
    ("distress", "foreclosures", "yoy", 1.3, 2),
    ("distress", "evictions", "yoy", 1.3, 2),
    ("distress", "auctions_realestate", "yoy", 0.9, 2),
    ("distress", "unemployment_registered", "yoy", 1.0, 2),
    ("distress", "insolvencies", "yoy", 0.8, 2),
    ("distress", "company_dissolutions", "yoy", 0.6, 2),
    ("distress", "euribor_12m", "change_12", 0.7, 2),
    ("distress", "wiki_hardship_index", "yoy", 0.5, 2),
    ("distress", "locales_closures", "yoy", 0.5, 2),
    ("distress", "search_room_share", "yoy", 0.4, 2),
]


def index_components(spark: SparkSession, rows=INDEX_COMPONENTS) -> DataFrame:
    return literal_table(spark, COMPONENT_SCHEMA, rows)


def publication_lags(spark: SparkSession, rows=PUBLICATION_LAGS) -> DataFrame:
    return literal_table(spark, "source_id string, days int", rows)


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dimension kept as JSON lines."""
    return spark.read.schema(schema).json(path)


def newest_version(declarations: DataFrame, name: str = "name") -> DataFrame:
    """The rows of the newest version of each family.

    ``name`` reads ``<family>-v<number>``; older versions stay available in the
    table itself.
    """
    family = F.regexp_extract(name, r"^(.*)-v\d+$", 1)
    number = F.regexp_extract(name, r"-v(\d+)$", 1).try_cast("int")
    tagged = declarations.withColumns({"family": family, "version": number})
    top = tagged.groupBy("family").agg(F.max("version").alias("version"))
    return tagged.join(top, ["family", "version"])
