"""Observations derived from the order, line and event tables.

This is the worked example of the library: nations are the places, regions the
larger geography, market segments within a nation its districts.  Every metric
is a roll-up of the whole tables; sums of money are formed in exact decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.functions.periods import month_of, period_text, pidx_end
from tidemark.session import literal_table
from tidemark.sources.dims import METRIC_SCHEMA

METRICS = [
    ("orders_count", "Orders", "orders", "monthly", "municipality", "order_desk", "demand", 1, 0.0, 1e12),
    ("revenue", "Revenue", "eur", "monthly", "municipality", "order_desk", "demand", 1, 0.0, 1e15),
    ("avg_ticket", "Average ticket", "eur", "monthly", "municipality", "order_desk", "prices", 1, 0.0, 480000.0),
    ("open_share", "Open orders", "percent", "monthly", "municipality", "order_desk", "stress", -1, 0.0, 100.0),
    ("urgent_share", "Urgent orders", "percent", "monthly", "municipality", "order_desk", "prices", 1, 0.0, 100.0),
    ("world_revenue", "Revenue, all places", "eur", "monthly", "nation", "order_desk", "demand", 1, 0.0, 1e18),
    ("orders_quarter", "Orders by quarter", "orders", "quarterly", "municipality", "order_desk", "demand", 1, 0.0, 1e12),
    ("segment_orders", "Orders by segment", "orders", "monthly", "district", "order_desk", "demand", 1, 0.0, 1e12),
    ("segment_ticket", "Ticket by segment", "eur", "monthly", "district", "order_desk", "prices", 1, 0.0, 480000.0),
    ("buyers_annual", "Buyers", "customers", "annual", "municipality", "customer_desk", "stock", 1, 0.0, 1e12),
    ("qty_shipped", "Quantity", "units", "monthly", "province", "line_desk", "supply", 1, 0.0, 1e15),
    ("return_rate", "Returned lines", "percent", "monthly", "province", "line_desk", "stress", -1, 0.0, 100.0),
    ("discount_rate", "Average discount", "percent", "monthly", "ccaa", "line_desk", "stress", -1, 0.0, 100.0),
]
SOURCES = [
    ("order_desk", "Order desk", "official", "monthly", 120, True, True),
    ("customer_desk", "Customer desk", "official", "annual", 400, True, False),
    ("line_desk", "Line desk", "official", "monthly", 30, True, True),
    ("web_desk", "Web desk", "attention", "daily", 7, False, True),
]
COMPONENTS = [
    ("demand_momentum", "orders_count", "yoy", 1.2, 2),
    ("demand_momentum", "revenue", "yoy", 1.0, 2),
    ("demand_momentum", "qty_shipped", "yoy", 0.8, 2),
    ("housing_pressure", "avg_ticket", "yoy", 1.3, 2),
    ("housing_pressure", "urgent_share", "level", 0.5, 2),
    ("housing_pressure", "orders_count", "per_1000_dwellings", 0.8, 2),
    ("supply_response", "qty_shipped", "yoy", 1.0, 2),
    ("supply_response", "orders_quarter", "yoy", 0.8, 2),
    ("distress", "return_rate", "yoy", 1.3, 2),
    ("distress", "open_share", "yoy", 1.0, 2),
    ("distress", "discount_rate", "change_12", 0.7, 2),
]
SIGNALS = [
    ("boom", "orders_count", "yoy", "up"),
    ("boom", "revenue", "yoy", "up"),
    ("boom", "avg_ticket", "yoy", "up"),
    ("boom", "open_share", "yoy", "down"),
    ("boom", "qty_shipped", "yoy", "up"),
    ("overheating", "avg_ticket", "yoy", "up"),
    ("overheating", "urgent_share", "level", "up"),
    ("overheating", "orders_count", "yoy", "down"),
    ("stagnation", "orders_count", "yoy", "down"),
    ("stagnation", "return_rate", "yoy", "up"),
    ("stagnation", "qty_shipped", "yoy", "down"),
    ("stagnation", "hotel_nights", "yoy", "down"),
    ("silent", "hotel_nights", "yoy", "up"),
    ("silent", "airport_flights", "yoy", "up"),
]
PAIRS = [
    ("orders_count", "revenue"),
    ("open_share", "qty_shipped"),
    ("avg_ticket", "return_rate"),
    ("urgent_share", "orders_count"),
    ("world_revenue", "orders_count"),
    ("orders_quarter", "revenue"),
]
TARGETS = [
    ("orders_3m", "orders_count", 3, False),
    ("orders_6m", "orders_count", 6, True),
    ("revenue_3m", "revenue", 3, False),
    ("quarter_2q", "orders_quarter", 2, False),
]
LAGS = [("order_desk", 45), ("customer_desk", 95)]
HORIZONS = {"monthly": [3, 6], "quarterly": [2]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession) -> DataFrame:
    return literal_table(spark, METRIC_SCHEMA, METRICS)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _number(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


# --- Facts -------------------------------------------------------------------------
def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the place and segment of their customer.

    No broadcast is forced on the customer side: it grows with the data, so
    the optimiser decides by its size, and adaptive execution splits a customer
    that holds a large share of the orders.
    """
    orders = table(spark, sf_dir, "orders").withColumn("m", month_of("o_orderdate"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )


def fact_months(spark: SparkSession, sf_dir: str, lines: bool = False) -> DataFrame:
    """Order (and line) totals per nation, segment and month, in one pass.

    Lines are reduced per order before the join, which then reuses that hash
    partitioning; an order with very many lines is one partial row per task.
    """
    facts = order_facts(spark, sf_dir)
    sums = {
        "n": F.count(F.lit(1)),
        "rev": F.sum(money("o_totalprice")),
        "n_open": F.count_if(F.col("o_orderstatus") == "O"),
        "n_urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
    }
    if lines:
        per_order = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.count(F.lit(1)).alias("lines"),
                F.sum(money("l_quantity")).alias("qty"),
                F.sum(money("l_discount")).alias("disc"),
                F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
            )
        )
        facts = facts.join(per_order, "o_orderkey", "left")
        sums |= {c: F.sum(c) for c in ("lines", "qty", "disc", "n_ret")}
    keys = [F.col("c_nationkey").alias("nk"), F.col("n_regionkey").alias("rk"), F.col("c_mktsegment").alias("seg"), "m"]
    return facts.groupBy(*keys).agg(*[v.alias(k) for k, v in sums.items()])


# --- Observations --------------------------------------------------------------------
def mun(nk="nk") -> Column:
    return geo.municipality(F.col(nk) + 1)


def _grains() -> dict[tuple[str, str], tuple[Column, Column]]:
    """(level, cadence) -> (geography, period) of a nation, segment and month."""
    m = F.col("m").cast("int")
    return {
        ("municipality", "monthly"): (mun(), m),
        ("municipality", "quarterly"): (mun(), F.floor(m / F.lit(3.0)).cast("int")),
        ("nation", "monthly"): (F.lit("es"), m),
        ("district", "monthly"): (geo.district(F.col("nk") + 1, F.col("code")), m),
        ("province", "monthly"): (geo.province(F.col("nk") + 1), m),
        ("ccaa", "monthly"): (geo.ccaa(F.col("rk") + 1), m),
    }


def _values() -> dict[str, Column]:
    n, lines = _number("n"), _number("lines")
    return {
        "orders_count": n,
        "revenue": _number("rev"),
        "avg_ticket": _number("rev") / n,
        "open_share": F.lit(100.0) * _number("n_open") / n,
        "urgent_share": F.lit(100.0) * _number("n_urgent") / n,
        "world_revenue": _number("rev"),
        "orders_quarter": n,
        "segment_orders": n,
        "segment_ticket": _number("rev") / n,
        "qty_shipped": _number("qty"),
        "return_rate": F.lit(100.0) * _number("n_ret") / lines,
        "discount_rate": F.lit(100.0) * _number("disc") / lines,
    }


_LINE = {"qty_shipped", "return_rate", "discount_rate"}


def grain_observations(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """All wanted metrics of all their levels from a single pass over the facts.

    The nation-segment-month totals are copied to each level and period they
    belong to and summed again: the facts are scanned once, however many
    levels are asked for.
    """
    grains, values = _grains(), _values()
    by_grain: dict[tuple[str, str], list[str]] = {}
    for metric_id, _, _, cadence, level, *_ in METRICS:
        if metric_id in wanted and (level, cadence) in grains:
            by_grain.setdefault((level, cadence), []).append(metric_id)
    totals = fact_months(spark, sf_dir, bool(wanted & _LINE))
    sums = [c for c in totals.columns if c not in ("nk", "rk", "seg", "m")]
    if ("district", "monthly") in by_grain:
        codes = segment_codes(spark, sf_dir).withColumnRenamed("seg", "_seg")
        totals = totals.join(codes, F.col("seg").eqNullSafe(F.col("_seg"))).drop("_seg")
    copies = F.array(
        *[
            F.struct(F.lit(level).alias("geo_level"), F.lit(cadence).alias("cadence"), grains[level, cadence][0].alias("geo_id"), grains[level, cadence][1].alias("pidx"))
            for level, cadence in by_grain
        ]
    )
    keys = ["geo_level", "cadence", "geo_id", "pidx"]
    summed = totals.select(F.inline(copies), *sums).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    rows = [
        F.when(
            (F.col("geo_level") == level) & (F.col("cadence") == cadence),
            F.struct(F.lit(metric).alias("metric_id"), values[metric].alias("value")),
        )
        for (level, cadence), metrics in by_grain.items()
        for metric in metrics
    ]
    out = summed.select(*keys, F.inline(F.array_compact(F.array(*rows))))
    return out.where(F.col("value").isNotNull()).select("metric_id", "geo_id", "geo_level", "cadence", "pidx", "value")


def buyer_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct buyers per nation and year."""
    years = (
        order_facts(spark, sf_dir)
        .select("c_nationkey", F.year("o_orderdate").alias("y"), "o_custkey")
        .distinct()
        .groupBy(F.col("c_nationkey").alias("nk"), "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return years.select(
        F.lit("buyers_annual").alias("metric_id"),
        mun().alias("geo_id"),
        F.lit("municipality").alias("geo_level"),
        F.lit("annual").alias("cadence"),
        F.col("y").cast("int").alias("pidx"),
        _number("n").alias("value"),
    )


def series(spark: SparkSession, sf_dir: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """Observations of the wanted metrics; only their facts are scanned."""
    wanted = {m[0] for m in METRICS} if metrics is None else set(metrics)
    parts = []
    if wanted - {"buyers_annual"}:
        parts.append(grain_observations(spark, sf_dir, wanted))
    if "buyers_annual" in wanted:
        parts.append(buyer_observations(spark, sf_dir))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_period(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"period": period_text("pidx", "cadence"), "observation_end": pidx_end("pidx", F.col("cadence"))}
    )


def records(spark: SparkSession, sf_dir: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """Canonical records (revision 0) with unit and source from the registry."""
    reg = registry(spark).select("metric_id", "unit", "source_id")
    out = with_period(series(spark, sf_dir, metrics)).join(reg, "metric_id")
    return out.withColumns(
        {
            "published_at": F.lit(None).cast("date"),
            "fetched_at": F.lit("2001-09-01").cast("date"),
            "quality_flag": F.lit("ok"),
            "revision": F.lit(0),
            "seq": F.lit(0).cast("bigint"),
        }
    )


def revision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue per place and month, restated as more lines arrive.

    Revision 0 sees line numbers 1-2, revision 1 up to 4, revision 2 all.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            *[
                F.sum(F.when(F.col("l_linenumber") <= top, money("l_extendedprice"))).alias(f"r{i}")
                for i, top in enumerate((2, 4))
            ],
            F.sum(money("l_extendedprice")).alias("r2"),
        )
    )
    facts = order_facts(spark, sf_dir).select("o_orderkey", "c_nationkey", "m")
    months = (
        lines.join(facts, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("c_nationkey").alias("nk"), "m")
        .agg(*[F.sum(f"r{i}").alias(f"r{i}") for i in range(3)])
    )
    rows = F.array(*[F.struct(F.lit(i).alias("revision"), _number(f"r{i}").alias("value")) for i in range(3)])
    flat = months.select(mun().alias("geo_id"), F.col("m").cast("int").alias("pidx"), F.inline(rows))
    flat = flat.where(F.col("value").isNotNull())
    base = flat.select(
        F.lit("line_revenue").alias("metric_id"),
        "geo_id",
        F.lit("municipality").alias("geo_level"),
        F.lit("monthly").alias("cadence"),
        "pidx",
        "value",
        "revision",
    )
    return with_period(base).withColumns(
        {
            "unit": F.lit("eur"),
            "source_id": F.lit("line_desk"),
            "published_at": F.when(
                F.pmod(F.col("pidx"), F.lit(5)) != 0, F.date_add("observation_end", (F.col("revision") + 1) * 30)
            ),
            "fetched_at": F.lit("2001-09-01").cast("date"),
            "quality_flag": F.when(F.col("revision") > 0, "revised").otherwise("ok"),
            "seq": F.col("revision").cast("bigint"),
        }
    )


# --- Places ----------------------------------------------------------------------------
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lower("n_name").alias("place"),
        F.col("n_name").alias("name"),
        geo.municipality(F.col("n_nationkey") + 1).alias("municipality"),
        geo.province(F.col("n_nationkey") + 1).alias("province"),
        geo.ccaa(F.col("n_regionkey") + 1).alias("ccaa"),
        F.array().cast("array<string>").alias("airports"),
        F.array().cast("array<string>").alias("ports"),
    )


def segment_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seg, code): the segments that customers have, numbered from 1 in order, a missing one last.

    A declared dimension: the distinct names, few by their nature, are listed once.
    """
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("seg")).distinct().collect()
    ordered = sorted((r["seg"] for r in names), key=lambda seg: (seg is None, seg or ""))
    rows = [(seg, code) for code, seg in enumerate(ordered, 1)]
    return literal_table(spark, "seg string, code int", rows) if rows else spark.createDataFrame([], "seg string, code int")


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The districts of each place: the segments that its customers have."""
    held = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_mktsegment").alias("_seg")).distinct()
    coded = held.join(segment_codes(spark, sf_dir), F.col("_seg").eqNullSafe(F.col("seg")))
    n = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("place"), "n_nationkey")
    return n.join(coded, F.col("n_nationkey") == F.col("c_nationkey")).select("place", geo.district(F.col("n_nationkey") + 1, F.col("code")).alias("part"))
