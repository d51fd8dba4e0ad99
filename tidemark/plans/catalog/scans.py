"""Readers, sinks and dimension tables (S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.periods import month_text, parse_period
from tidemark.operators import history
from tidemark.operators.rollups import count_by
from tidemark.operators.series import next_in_time
from tidemark.plans import model as M
from tidemark.plans.catalog.base import PERIOD_M, R, REV, obs_sql, query, r, values_sql
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import dims, readers, sinks


@query(
    "s1_scan_history",
    f"""WITH {REV}, c AS (SELECT geo_id, pidx, arg_max(value, revision) AS value, max(revision) AS revision,
      max(observation_end) AS oe FROM rlog GROUP BY ALL)
    SELECT 'line_revenue' AS metric_id, geo_id, count(*) AS observations, min(pidx) AS first_pidx, max(pidx) AS last_pidx,
      max(oe)::VARCHAR AS observation_end, count(*) FILTER (WHERE revision > 0) AS flagged FROM c GROUP BY geo_id""",
)
def scan_history(spark, sf_dir):
    path = scratch_path(spark, "history")
    sinks.write_history(M.revision_log(spark, sf_dir), path)
    meta = history.series_metadata(history.scan_current(readers.read_table(spark, path)))
    return meta.select(
        "metric_id", "geo_id", "observations", "first_pidx", "last_pidx", F.col("observation_end").cast("string").alias("observation_end"), "flagged"
    )


@query(
    "s2_s3_write_and_scan_one_metric",
    obs_sql("revenue") + f" SELECT metric_id, geo_id, {PERIOD_M} AS period, value FROM obs",
)
def write_and_scan_one_metric(spark, sf_dir):
    path = scratch_path(spark, "table")
    sinks.write_history(M.records(spark, sf_dir, ["revenue", "orders_count", "avg_ticket"]), path, files_per_metric=4)
    one = readers.read_table(spark, path, source_id="order_desk", metric_id="revenue")
    return one.select("metric_id", "geo_id", "period", "value")


@query(
    "s4_quarantine_sink",
    f"""WITH {REV} SELECT n.geo_id, {PERIOD_M.replace('pidx', 'n.pidx')} AS period, n.value, rtrim(rtrim(printf('%.6f', o.value), '0'), '.') AS prior_value,
      'unexpected_revision' AS reason FROM rlog n JOIN rlog o ON n.geo_id = o.geo_id AND n.pidx = o.pidx
    WHERE n.revision = 2 AND o.revision = 0 AND round(n.value, 6) <> round(o.value, 6)""",
)
def quarantine_sink(spark, sf_dir):
    log = M.revision_log(spark, sf_dir)
    old, new = log.where("revision = 0"), log.where("revision = 2")
    path = scratch_path(spark, "quarantine")
    sinks.append_quarantine(history.quarantined(history.merge(old, new, False)), path)
    return spark.read.parquet(path).select("geo_id", "period", "value", "prior_value", "reason")


@query(
    "s5_delimited",
    """SELECT o_orderstatus AS status, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS pidx, count(*) AS n,
    sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total FROM orders GROUP BY ALL""",
)
def delimited(spark, sf_dir):
    from tidemark.functions.text import european_number

    # The whole table as a publisher writes it: ';', dd/mm/yyyy, decimal comma.
    o = M.table(spark, sf_dir, "orders")
    amount = F.replace(F.format_number("o_totalprice", 2), F.lit(","), F.lit(""))
    lines = o.select(
        F.concat_ws(
            ";", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "dd/MM/yyyy"), F.replace(amount, F.lit("."), F.lit(","))
        ).alias("value")
    )
    cells = readers.parse_delimited(lines, "key string, status string, day string, amount string")
    typed = cells.select(
        "status", parse_period("day").alias("period"), european_number("amount").cast("decimal(18,2)").alias("amount")
    )
    out = typed.groupBy("status", "period").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))
    from tidemark.functions.periods import pidx_of_period

    return out.select("status", pidx_of_period("period").alias("pidx"), "n", "total")


@query(
    "s6_n12_nested_statistics_json",
    obs_sql("orders_count", "revenue")
    + " SELECT metric_id AS metric, geo_id AS geo, (pidx // 12)::INTEGER AS year, lpad((pidx % 12 + 1)::VARCHAR, 2, '0') AS period_code, value FROM obs",
)
def nested_statistics_json(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "revenue"])

    def tag(variable, code):
        return F.struct(
            F.struct(F.lit(variable).alias("Nombre")).alias("Variable"), F.lit("x").alias("Nombre"), code.alias("Codigo")
        )

    point = F.struct(
        F.floor(F.col("pidx") / F.lit(12.0)).cast("int").alias("Anyo"),
        F.lpad((F.pmod("pidx", F.lit(12)) + 1).cast("string"), 2, "0").alias("Periodo"),
        F.col("value").alias("Valor"),
        F.lit(False).alias("Secreto"),
    )
    docs = obs.groupBy("metric_id", "geo_id").agg(F.collect_list(point).alias("Data"))
    json = docs.select(
        F.to_json(F.struct(F.array(tag("Metric", F.col("metric_id")), tag("Place", F.col("geo_id"))).alias("MetaData"), "Data")).alias("value")
    )
    return readers.parse_statistics_json(json, {"metric": "Metric", "geo": "Place"})


@query("s7_position_indexed_json", obs_sql("revenue") + f" SELECT geo_id, {PERIOD_M} AS label, value FROM obs")
def position_indexed_json(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue"])
    rows = obs.groupBy("geo_id").agg(F.sort_array(F.collect_list(F.struct("pidx", "value"))).alias("p"))
    docs = rows.select(
        "geo_id",
        F.map_from_arrays(
            F.transform(F.sequence(F.lit(0), F.size("p") - 1), lambda i: i.cast("string")), F.transform("p", lambda x: x["value"])
        ).alias("values"),
        F.transform("p", lambda x: month_text(x["pidx"])).alias("labels"),
    )
    json = docs.select("geo_id", F.to_json(F.struct("values", "labels")).alias("value"))
    opened = json.select("geo_id", F.from_json("value", "values map<string,double>, labels array<string>").alias("d")).select("geo_id", "d.*")
    return readers.parse_position_json(opened, ["geo_id"], "values", "labels")


@query("s8_timeline_json", obs_sql("orders_count") + f" SELECT geo_id, {PERIOD_M} AS period, value FROM obs")
def timeline_json(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count"])
    item = F.struct(F.concat(F.replace(month_text("pidx"), F.lit("-"), F.lit("")), F.lit("0100")).alias("timestamp"), F.col("value").alias("views"))
    docs = obs.groupBy("geo_id").agg(F.collect_list(item).alias("items"))
    json = docs.select("geo_id", F.to_json(F.struct("items")).alias("value"))
    return readers.parse_timeline_json(
        json, ["geo_id"], "items array<struct<timestamp:string,views:double>>", "items", "timestamp", "views"
    )


@query("s8_nested_timeline_json", obs_sql("revenue") + f" SELECT geo_id, {PERIOD_M} AS period, value FROM obs")
def nested_timeline_json(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue"])
    item = F.struct(F.concat(F.replace(month_text("pidx"), F.lit("-"), F.lit("")), F.lit("01T000000Z")).alias("date"), F.col("value").alias("value"))
    lines = obs.groupBy("geo_id").agg(F.array(F.struct(F.lit("Volume").alias("series"), F.collect_list(item).alias("data"))).alias("timeline"))
    json = lines.select("geo_id", F.to_json(F.struct("timeline")).alias("value"))
    schema = "timeline array<struct<series:string,data:array<struct<date:string,value:double>>>>"
    return readers.parse_timeline_json(json, ["geo_id"], schema, "timeline[0].data", "date", "value")


@query(
    "s9_fixed_width",
    "SELECT o_orderpriority[1:1] AS procedure, o_orderstatus AS status, count(*) AS value FROM orders GROUP BY ALL",
)
def fixed_width(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    lines = o.select(
        F.concat(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.substring("o_orderpriority", 1, 1), "o_orderstatus", F.lit("TRAILER")).alias("value")
    )
    cells = readers.parse_fixed_width(lines, {"procedure": (12, 13), "status": (13, 14)})
    return count_by(cells, ["procedure", "status"])


@query(
    "s10_a2_navigation_log",
    """WITH n AS (SELECT event_type AS prev, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS curr FROM events),
    c AS (SELECT prev, curr, count(*) AS n FROM n WHERE curr IS NOT NULL GROUP BY ALL)
    SELECT prev, curr, n::BIGINT AS clicks FROM c""",
)
def navigation_log(spark, sf_dir):
    # read twice below: rows in order, and the first of every minute
    e = cut_lineage(M.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("prev")))
    moves = next_in_time(e, ["user_id"], "ts", ["event_id"], "prev", F.date_trunc("MINUTE", "ts"), "curr").where(F.col("curr").isNotNull())
    # a line for each move, and beside it lines that the parser must leave out
    good = F.concat_ws("\t", "prev", "curr", F.lit("link"), F.lit("1"))
    log = moves.select(F.explode(F.array(good, F.lit("# comment"), F.concat_ws("\t", "prev", "curr"), F.lit("a\tb\tc\tx"))).alias("value"))
    parsed = readers.parse_navigation_log(log)
    return parsed.groupBy("prev", "curr").agg(F.sum("n").alias("clicks"))


@query(
    "s11_listing_snapshot",
    "SELECT p_brand AS neighbourhood, count(*) AS listings, sum(p_size)::BIGINT AS size FROM part GROUP BY ALL",
)
def listing_snapshot(spark, sf_dir):
    path = scratch_path(spark, "listings")
    p = M.table(spark, sf_dir, "part")
    wide = p.select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("host_id"), F.col("p_type").alias("room_type"),
        F.col("p_name").alias("description"), F.col("p_brand").alias("neighbourhood_cleansed"),
    )
    wide.write.option("header", True).option("compression", "gzip").csv(path)
    got = readers.read_listings(spark, path)
    return got.groupBy("neighbourhood").agg(
        F.count(F.lit(1)).alias("listings"), F.sum(F.col("host_id").try_cast("bigint")).alias("size")
    )


# Paragraphs of the pages, and words that stand for event kinds in them.
PAGE_KINDS = {"ends_in_on": r"(?i)on[ .,]", "starts_with_th": r"^\s*[Tt]h", "has_digit": r"[0-9]"}


@query(
    "s12_paragraph_events",
    r"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '<p>((?:.|\n)*?)</p>', 1)) AS paragraph FROM pages),
    s AS (SELECT page_id, regexp_replace(paragraph, '<[^>]+>', '', 'g') AS t FROM p)
    SELECT kind, count(*) AS n, count(DISTINCT page_id) AS pages FROM (
      SELECT page_id, 'ends_in_on' AS kind FROM s WHERE regexp_matches(t, '(?i)on[ .,]')
      UNION ALL SELECT page_id, 'starts_with_th' FROM s WHERE regexp_matches(t, '^\s*[Tt]h')
      UNION ALL SELECT page_id, 'has_digit' FROM s WHERE regexp_matches(t, '[0-9]')) GROUP BY kind""",
)
def paragraph_events(spark, sf_dir):
    found = readers.paragraphs(M.table(spark, sf_dir, "pages"), ["page_id"], "html", r"(?s)<p>(.*?)</p>")
    kinds = readers.event_kinds(found, ["page_id"], PAGE_KINDS)
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


@query(
    "s13_sensor_days_to_long",
    f"""SELECT event_type, day(ts)::INTEGER AS day, {R('sum(CAST(value AS DECIMAL(18,2)))::DOUBLE', 2)} AS value FROM events GROUP BY ALL""",
)
def sensor_days_to_long(spark, sf_dir):
    e = M.table(spark, sf_dir, "events").withColumn("d", F.dayofmonth("ts"))
    days = range(1, 32)
    wide = e.groupBy("event_type").agg(
        *[F.sum(F.when(F.col("d") == d, M.money("value"))).alias(f"D{d:02d}") for d in days],
        *[F.max(F.when(F.col("d") == d, F.lit("V"))).alias(f"V{d:02d}") for d in days],
    )
    return readers.days_to_long(wide, ["event_type"]).select("event_type", "day", r("value", 2))


@query(
    "s14_derived_documents",
    obs_sql("revenue", "orders_count")
    + f""" SELECT geo_id AS place, metric_id, arg_max({PERIOD_M}, pidx) AS period, arg_max(value, pidx) AS value, count(*) AS points,
      min({PERIOD_M}) AS first_period, {R('sum(value)', 1)} AS total FROM obs GROUP BY ALL""",
)
def derived_documents(spark, sf_dir):
    path = scratch_path(spark, "documents")
    obs = M.with_period(M.series(spark, sf_dir, ["revenue", "orders_count"]))
    cards = obs.groupBy("geo_id", "metric_id").agg(
        F.max_by(F.struct("period", "value"), "pidx").alias("latest"),
        F.sort_array(F.collect_list(F.struct("period", "value"))).alias("series"),
    )
    doc = cards.groupBy(F.col("geo_id").alias("place")).agg(F.collect_list(F.struct("metric_id", "latest", "series")).alias("metrics"))
    sinks.write_documents(doc, path)
    schema = (
        "place string, metrics array<struct<metric_id:string,latest:struct<period:string,value:double>,"
        "series:array<struct<period:string,value:double>>>>"
    )
    back = spark.read.schema(schema).json(path)
    return back.select("place", F.inline("metrics")).select(
        "place", "metric_id", "latest.period", "latest.value", F.size("series").cast("bigint").alias("points"),
        F.array_min(F.transform("series", lambda x: x["period"])).alias("first_period"), r(F.aggregate("series", F.lit(0.0), lambda a, x: a + x["value"]), 1).alias("total"),
    )


@query(
    "s15_s16_write_once",
    obs_sql("orders_count")
    + """ SELECT 'orders' AS target_id, geo_id, pidx AS from_pidx, value, CASE WHEN pidx < 24000 THEN 'first' ELSE 'second' END AS run FROM obs""",
)
def write_once(spark, sf_dir):
    path = scratch_path(spark, "frozen")
    obs = M.series(spark, sf_dir, ["orders_count"]).select(
        F.lit("orders").alias("target_id"), "geo_id", F.col("pidx").alias("from_pidx"), "value"
    )
    first = obs.where(F.col("from_pidx") < 24000).withColumn("run", F.lit("first"))
    sinks.freeze_forecasts(first, None, path)
    # The second run offers everything again with other values.
    again = obs.withColumn("run", F.lit("second"))
    frozen = spark.read.parquet(path)
    sinks.freeze_forecasts(again, frozen, path)
    return spark.read.parquet(path).select("target_id", "geo_id", "from_pidx", "value", "run")


@query(
    "s16_append_scores",
    obs_sql("orders_count")
    + """ SELECT 'orders' AS target_id, geo_id, pidx AS from_pidx, value AS actual, CASE WHEN pidx < 24000 THEN 'first' ELSE 'second' END AS run FROM obs""",
)
def append_scores(spark, sf_dir):
    """Scores of a first run, then of a second and a third that offer all again: only what is new is appended."""
    path = scratch_path(spark, "scores")
    scored = M.series(spark, sf_dir, ["orders_count"]).select(F.lit("orders").alias("target_id"), "geo_id", F.col("pidx").alias("from_pidx"), F.col("value").alias("actual"))
    scored = cut_lineage(scored)
    sinks.append_scores(scored.where(F.col("from_pidx") < 24000).withColumn("run", F.lit("first")), None, path)
    for run in ("second", "third"):
        sinks.append_scores(scored.withColumn("run", F.lit(run)), spark.read.parquet(path), path)
    return spark.read.parquet(path).select("target_id", "geo_id", "from_pidx", "actual", "run")


@query(
    "s17_dimension_join",
    obs_sql()
    + f""", {values_sql('reg', 'metric_id, unit, section, direction', [(m[0], m[2], m[6], m[7]) for m in M.METRICS])}
    SELECT unit, section, direction, count(*) AS observations, count(DISTINCT geo_id) AS geographies FROM obs JOIN reg USING (metric_id) GROUP BY ALL""",
)
def dimension_join(spark, sf_dir):
    out = M.series(spark, sf_dir).join(M.registry(spark), "metric_id")
    return out.groupBy("unit", "section", "direction").agg(
        F.count(F.lit(1)).alias("observations"), F.count_distinct("geo_id").alias("geographies")
    )


@query(
    "s18_newest_version",
    """WITH v AS (SELECT o_orderpriority AS family, year(o_orderdate)::INTEGER - 1994 AS version, count(*) AS orders FROM orders GROUP BY ALL)
    SELECT family, max(version) AS version, arg_max(orders, version) AS orders FROM v GROUP BY family""",
)
def newest_version(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    name = F.concat("o_orderpriority", F.lit("-v"), (F.year("o_orderdate") - 1994).cast("string"))
    declared = o.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("orders"))
    return dims.newest_version(declared).select("family", "version", "orders")


@query(
    "s19_periods_to_fetch",
    """WITH a AS (SELECT DISTINCT o_orderstatus AS source_id, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS pidx FROM orders),
    st AS (SELECT o_orderstatus AS source_id, min((year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER) AS lo, max((year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER) AS hi
      FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND o_orderstatus <> 'P' GROUP BY ALL),
    k AS (SELECT a.*, row_number() OVER (PARTITION BY source_id ORDER BY pidx DESC) AS rn FROM a)
    SELECT source_id, pidx FROM k LEFT JOIN st USING (source_id) WHERE lo IS NULL OR pidx < lo OR pidx > hi OR rn <= 3""",
)
def periods_to_fetch(spark, sf_dir):
    from tidemark.functions.periods import month_of

    o = M.table(spark, sf_dir, "orders")
    all_ = o.select(F.col("o_orderstatus").alias("source_id"), month_of("o_orderdate").alias("pidx"))
    kept = o.where(F.year("o_orderdate").between(1996, 1999) & (F.col("o_orderstatus") != "P"))
    stored = kept.select(F.col("o_orderstatus").alias("source_id"), month_of("o_orderdate").alias("pidx"))
    return history.periods_to_fetch(all_, stored, 3)


