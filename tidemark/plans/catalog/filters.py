"""Period and geography grammar, validation, publication filters (F)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import geo, periods as P, text as X
from tidemark.operators import series as S, validate as V
from tidemark.plans import model as M
from tidemark.plans.catalog.base import PERIOD_ANY, R, obs_sql, query, r, values_sql
from tidemark.session import literal_table


def _period_texts(spark, sf_dir):
    """Every order date written in each of the five grammars."""
    o = M.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    kinds = ("annual", "quarterly", "monthly", "weekly", "daily")
    rows = F.array(
        *[F.struct(F.lit(c).alias("cadence"), P.pidx_of_date("d", c).cast("int").alias("pidx")) for c in kinds]
    )
    out = o.select("d", F.inline(rows)).distinct()
    return out.withColumn("period", P.period_text("pidx", "cadence"))


_DATES = "dd AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)"


@query(
    "f1_f3_period_grammar",
    f"""WITH {_DATES}, p AS (
      SELECT d, year(d)::VARCHAR AS period, 'annual' AS cadence, year(d)::INTEGER AS pidx, make_date(year(d), 12, 31) AS e FROM dd
      UNION ALL SELECT d, year(d)::VARCHAR || '-Q' || quarter(d)::VARCHAR, 'quarterly', (year(d) * 4 + quarter(d) - 1)::INTEGER, last_day(make_date(year(d), quarter(d) * 3, 1)) FROM dd
      UNION ALL SELECT d, strftime(d, '%Y-%m'), 'monthly', (year(d) * 12 + month(d) - 1)::INTEGER, last_day(d) FROM dd
      UNION ALL SELECT d, strftime(d, '%G-W%V'), 'weekly', ((date_trunc('week', d)::DATE - DATE '1970-01-05') // 7)::INTEGER, date_trunc('week', d)::DATE + 6 FROM dd
      UNION ALL SELECT d, d::VARCHAR, 'daily', (d - DATE '1970-01-01')::INTEGER, d FROM dd)
    SELECT DISTINCT cadence, period, pidx, e::VARCHAR AS period_end, 1 AS valid FROM p""",
)
def period_grammar(spark, sf_dir):
    t = _period_texts(spark, sf_dir).select("period", "cadence").distinct()
    return t.select(
        P.cadence_of("period").alias("cadence"),
        "period",
        P.pidx_of_period("period").alias("pidx"),
        P.period_end("period").cast("string").alias("period_end"),
        P.period_is_valid("period", "cadence").cast("int").alias("valid"),
    )


@query(
    "f4_f5_period_shift",
    f"""WITH {_DATES} SELECT DISTINCT strftime(d, '%Y-%m') AS period, strftime(d - INTERVAL 1 YEAR, '%Y-%m') AS year_before, strftime(date_trunc('month', d) + INTERVAL 7 MONTH, '%Y-%m') AS later, 12 AS steps FROM dd
    UNION ALL SELECT DISTINCT strftime(d, '%G-W%V'), strftime(d - 364, '%G-W%V'), strftime(d + 49, '%G-W%V'), 52 FROM dd
    UNION ALL SELECT DISTINCT year(d) || '-Q' || quarter(d), (year(d) - 1) || '-Q' || quarter(d),
      year(date_trunc('quarter', d) + INTERVAL 21 MONTH) || '-Q' || quarter(date_trunc('quarter', d) + INTERVAL 21 MONTH), 4 FROM dd
    UNION ALL SELECT d::VARCHAR, (d - 365)::VARCHAR, (d + 7)::VARCHAR, 365 FROM dd""",
)
def period_shift(spark, sf_dir):
    t = _period_texts(spark, sf_dir).where(F.col("cadence") != "annual").select("period", "cadence").distinct()
    steps = P.steps_per_year("cadence")
    return t.select(
        "period",
        P.period_shift("period", -steps).alias("year_before"),
        P.period_shift("period", 7).alias("later"),
        steps.alias("steps"),
    )


@query(
    "f6_f7_geo_identifiers",
    """SELECT DISTINCT 'mun-' || printf('%05d', c_nationkey + 1) AS municipality, 'municipality' AS l1,
      'prov-' || printf('%02d', c_nationkey + 1) AS province, 'province' AS l2,
      'dist-' || printf('%05d', c_nationkey + 1) || '-' || printf('%02d', c_custkey % 21 + 1) AS district, 'district' AS l3,
      'barrio-' || printf('%05d', c_nationkey + 1) || '-' || printf('%03d', c_custkey % 130) AS barrio, 'barrio' AS l4,
      'apt-' || upper(c_mktsegment[1:3]) AS airport, 'airport' AS l5, 0 AS bad FROM customer""",
)
def geo_identifiers(spark, sf_dir):
    c = M.table(spark, sf_dir, "customer")
    ids = c.select(
        geo.municipality(F.col("c_nationkey") + 1).alias("municipality"),
        geo.province(F.col("c_nationkey") + 1).alias("province"),
        geo.district(F.col("c_nationkey") + 1, F.col("c_custkey") % 21 + 1).alias("district"),
        geo.barrio(F.col("c_nationkey") + 1, F.col("c_custkey") % 130).alias("barrio"),
        geo.airport(F.substring("c_mktsegment", 1, 3)).alias("airport"),
    ).distinct()
    levels = {"l1": "municipality", "l2": "province", "l3": "district", "l4": "barrio", "l5": "airport"}
    return ids.select(
        "*",
        *[geo.geo_level_of(c).alias(name) for name, c in levels.items()],
        geo.geo_is_valid(F.concat("province", F.lit("x")), F.lit("province")).cast("int").alias("bad"),
    )


@query(
    "f8_canonical_records",
    obs_sql()
    + f""", {values_sql('reg', 'metric_id, unit, source_id', [(m[0], m[2], m[5]) for m in M.METRICS])}
    SELECT metric_id, geo_id, geo_level, cadence, {PERIOD_ANY} AS period, pidx, value, unit, source_id,
      (CASE cadence WHEN 'annual' THEN make_date(pidx, 12, 31) WHEN 'quarterly' THEN last_day(make_date((pidx // 4)::INTEGER, ((pidx % 4) * 3 + 3)::INTEGER, 1))
        ELSE last_day(make_date((pidx // 12)::INTEGER, (pidx % 12 + 1)::INTEGER, 1)) END)::VARCHAR AS observation_end,
      '2001-09-01' AS fetched_at, 'ok' AS quality_flag, 0 AS revision FROM obs JOIN reg USING (metric_id)""",
)
def canonical_records(spark, sf_dir):
    from tidemark.operators.history import canonicalise

    reg = M.registry(spark).select("metric_id", "unit", "source_id")
    raw = M.with_period(M.series(spark, sf_dir)).select("metric_id", "geo_id", "period", "value").join(reg, "metric_id")
    out = canonicalise(raw, "2001-09-01")
    dates = ("observation_end", "fetched_at")
    return out.select(
        *[c for c in out.columns if c not in (*dates, "published_at", "seq")],
        *[F.col(c).cast("string").alias(c) for c in dates],
    )


def _dirty(spark, sf_dir):
    """Records with faults that depend on the period, so every check fires."""
    rec = M.records(spark, sf_dir, ["orders_count", "avg_ticket", "return_rate", "open_share"])
    k = F.pmod("pidx", F.lit(40))
    return rec.withColumns(
        {
            "metric_id": F.when(k == 1, F.concat("metric_id", F.lit("_x"))).otherwise(F.col("metric_id")),
            "source_id": F.when(k == 2, "web_desk").otherwise(F.col("source_id")),
            "period": F.when(k == 3, F.substring("period", 1, 4)).when(k == 4, "1999-13").otherwise(F.col("period")),
            "geo_id": F.when(k == 5, F.concat("geo_id", F.lit("9"))).otherwise(F.col("geo_id")),
            "geo_level": F.when(k == 6, "ccaa").otherwise(F.col("geo_level")),
            "unit": F.when(k == 7, "each").otherwise(F.col("unit")),
            "value": F.when(k == 8, F.col("value") - 1e13).otherwise(F.col("value")),
        }
    )


_CHECKED = (
    obs_sql("orders_count", "avg_ticket", "return_rate", "open_share")
    + f""", {values_sql('reg', 'metric_id, source_id, hi', [(m[0], m[5], m[9]) for m in M.METRICS])},
  c AS (SELECT CASE WHEN pidx % 40 = 2 THEN 'web_desk' ELSE source_id END AS source_id, metric_id, geo_id, pidx, value,
    CASE pidx % 40 WHEN 1 THEN 'unknown_metric' WHEN 2 THEN 'wrong_source' WHEN 3 THEN 'bad_period' WHEN 4 THEN 'bad_period'
      WHEN 5 THEN 'bad_geo' WHEN 6 THEN 'bad_geo' WHEN 7 THEN 'wrong_unit' WHEN 8 THEN 'out_of_range'
      ELSE CASE WHEN value > CASE metric_id WHEN 'avg_ticket' THEN 300000 ELSE hi END THEN 'out_of_range' END END AS reason
    FROM obs JOIN reg USING (metric_id))"""
)


def _ranges(spark):
    return literal_table(spark, "source_id string, metric_id string, lo double, hi double", [("order_desk", "avg_ticket", 0.0, 300000.0)])


@query(
    "f9_validate_batch",
    _CHECKED
    + """ SELECT source_id, coalesce(reason, 'valid') AS reason, count(*) AS records,
      (sum(count(*) FILTER (WHERE reason IS NOT NULL)) OVER (PARTITION BY source_id) <= 0.02 * sum(count(*)) OVER (PARTITION BY source_id))::INTEGER AS batch_passes
    FROM c GROUP BY source_id, reason""",
)
def validate_batch(spark, sf_dir):
    checked = V.with_reason(_dirty(spark, sf_dir), M.registry(spark), _ranges(spark))
    by_reason = checked.groupBy("source_id", F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    # the gate of a source from its few reasons: the records are read once
    of = Window.partitionBy("source_id")
    rejected = F.sum(F.when(F.col("reason") != "valid", F.col("records")).otherwise(0)).over(of)
    return by_reason.withColumn("batch_passes", (rejected <= 0.02 * F.sum("records").over(of)).cast("int"))


@query(
    "f10_keep_valid",
    _CHECKED
    + """ SELECT metric_id, CASE WHEN pidx % 40 = 5 THEN geo_id || '9' ELSE geo_id END AS geo_id, pidx, value FROM c
    WHERE pidx % 40 NOT IN (1, 3, 4, 8) AND NOT (metric_id = 'avg_ticket' AND source_id = 'order_desk' AND value > 300000)
      AND NOT (metric_id = 'avg_ticket' AND source_id = 'web_desk' AND value > 480000)""",
)
def keep_valid(spark, sf_dir):
    kept = V.keep_valid(_dirty(spark, sf_dir), M.registry(spark), _ranges(spark))
    return kept.select("metric_id", "geo_id", "pidx", "value")


@query(
    "f11_pick_cells",
    """SELECT CASE o_orderstatus WHEN 'O' THEN 'urgent_open' ELSE 'urgent_done' END AS metric_id, year(o_orderdate)::INTEGER AS year, count(*) AS value
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('O', 'F') GROUP BY ALL""",
)
def pick_cells(spark, sf_dir):
    cells = literal_table(
        spark,
        "o_orderpriority string, o_orderstatus string, metric_id string, unit string",
        [("1-URGENT", "O", "urgent_open", "orders"), ("1-URGENT", "F", "urgent_done", "orders")],
    )
    cube = M.table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("value")
    )
    return V.pick_cell(cube, cells, ["o_orderpriority", "o_orderstatus"]).select("metric_id", "year", "value")


@query(
    "f12_f13_code_checks",
    """SELECT p_size AS code, (p_size::VARCHAR LIKE '1%' OR p_size::VARCHAR LIKE '33%')::INTEGER AS prefixed, (p_size BETWEEN 1 AND 21)::INTEGER AS in_range, count(*) AS parts
    FROM part GROUP BY ALL""",
)
def code_checks(spark, sf_dir):
    p = M.table(spark, sf_dir, "part").withColumn("code_text", F.concat(F.lit(" "), F.col("p_size").cast("string")))
    return p.groupBy(
        F.col("p_size").alias("code"),
        X.code_has_prefix("code_text", ["1", "33"]).cast("int").alias("prefixed"),
        X.code_in_range("code_text", 1, 21).cast("int").alias("in_range"),
    ).agg(F.count(F.lit(1)).alias("parts"))


@query(
    "f14_closed_periods",
    obs_sql("revenue", "orders_quarter", "buyers_annual")
    + """ SELECT metric_id, geo_id, pidx, value FROM obs WHERE
      CASE cadence WHEN 'monthly' THEN pidx < 2001 * 12 + 7 WHEN 'quarterly' THEN pidx < 2001 * 4 + 2 ELSE pidx < 2001 END""",
)
def closed_periods(spark, sf_dir):
    obs = M.with_period(M.series(spark, sf_dir, ["revenue", "orders_quarter", "buyers_annual"]))
    return V.closed_only(obs, "2001-08-15").select("metric_id", "geo_id", "pidx", "value")


@query(
    "f15_drop_incomplete_tail",
    obs_sql("orders_count", "revenue", "qty_shipped")
    + """, t0 AS (SELECT metric_id, pidx, sum(value) AS total FROM obs GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY metric_id ORDER BY pidx DESC) AS rn FROM t0),
    n AS (SELECT metric_id, list_sort(list(total) FILTER (WHERE rn BETWEEN 2 AND 13))[7] AS normal FROM t GROUP BY ALL HAVING count(*) >= 13),
    b AS (SELECT t.*, max((total >= 0.4::DOUBLE * normal)::INTEGER) OVER (PARTITION BY metric_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS seen FROM t JOIN n USING (metric_id))
    SELECT metric_id, geo_id, pidx, value FROM obs WHERE (metric_id, pidx) NOT IN (SELECT (metric_id, pidx) FROM b WHERE seen = 0)""",
)
def drop_incomplete_tail(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "revenue", "qty_shipped"])
    return V.drop_incomplete_tail(obs, key="metric_id").select("metric_id", "geo_id", "pidx", "value")


@query(
    "f16_coverage_gate",
    obs_sql("return_rate")
    + f""", g AS (SELECT *, avg(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY geo_id) AS cover FROM obs)
    SELECT geo_id, pidx, {R('value')} AS value FROM g WHERE cover >= 0.7 AND value <> 0""",
)
def coverage_gate(spark, sf_dir):
    # a rate that is zero in many months
    return V.coverage_gate(M.series(spark, sf_dir, ["return_rate"])).select("geo_id", "pidx", r("value"))


@query(
    "f17_drop_low_volume",
    """WITH m AS (SELECT source, list_sort(list(n_chars))[(count(*) // 2 + 1)::INTEGER] AS med FROM documents GROUP BY source)
    SELECT lang, source, count(*) AS documents FROM documents WHERE source NOT IN (SELECT source FROM m WHERE med < 1500) GROUP BY ALL""",
)
def drop_low_volume(spark, sf_dir):
    d = M.table(spark, sf_dir, "documents").select("lang", "source", "n_chars")
    return V.drop_low_volume(d, "source", "n_chars", 1500).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "f18_enabled_sources",
    "SELECT event_type AS source_id, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY ALL",
)
def enabled_sources(spark, sf_dir):
    flags = literal_table(spark, "source_id string, enabled boolean", [("error", False), ("signup", False), ("view", True)])
    rows = M.table(spark, sf_dir, "events").withColumnRenamed("event_type", "source_id")
    return V.enabled_only(rows, flags).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f19_series_tail",
    obs_sql("revenue", "orders_quarter")
    + """ SELECT metric_id, geo_id, pidx, value FROM obs QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx DESC) <= 12""",
)
def series_tail(spark, sf_dir):
    return S.tail(M.series(spark, sf_dir, ["revenue", "orders_quarter"]), 12).select("metric_id", "geo_id", "pidx", "value")


@query(
    "f20_f21_mover_eligibility",
    obs_sql("orders_count", "revenue", "return_rate", "discount_rate")
    + f""", y AS (SELECT o.metric_id, o.geo_id, o.geo_level, o.pidx, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM obs o JOIN obs p
      ON o.metric_id = p.metric_id AND o.geo_id = p.geo_id AND p.pidx = o.pidx - 12 WHERE p.value <> 0)
    SELECT metric_id, geo_id, pidx, {R('yoy')} AS yoy FROM y WHERE geo_level IN ('municipality', 'province') AND abs(yoy) >= 5 AND metric_id NOT LIKE 'wiki_%'""",
)
def mover_eligibility(spark, sf_dir):
    from tidemark.plans.dashboards import headline_eligible

    out = S.yoy(M.series(spark, sf_dir, ["orders_count", "revenue", "return_rate", "discount_rate"]))
    return out.where(headline_eligible()).select("metric_id", "geo_id", "pidx", r("yoy"))


@query(
    "f22_f23_freshness",
    """WITH l AS (SELECT o_orderstatus || '/' || o_orderpriority AS source_id, max(o_orderdate)::DATE AS last_seen,
      CASE o_orderstatus WHEN 'F' THEN 17 WHEN 'O' THEN 9 END AS max_age FROM orders GROUP BY ALL),
    s AS (SELECT source_id, last_seen::VARCHAR AS last_seen, CASE WHEN max_age IS NULL THEN 'unknown' WHEN DATE '2001-08-16' - last_seen <= max_age THEN 'fresh'
      WHEN DATE '2001-08-16' - last_seen <= 2 * max_age THEN 'stale' ELSE 'failing' END AS freshness FROM l)
    SELECT *, (freshness <> 'fresh')::INTEGER AS needs_attention FROM s""",
)
def freshness(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    newest = o.groupBy(F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("source_id"), "o_orderstatus").agg(
        F.max("o_orderdate").cast("date").alias("last_seen")
    )
    limit = F.when(F.col("o_orderstatus") == "F", 17).when(F.col("o_orderstatus") == "O", 9)
    out = newest.withColumn("freshness", V.freshness("last_seen", limit, "2001-08-16"))
    return out.select(
        "source_id", F.col("last_seen").cast("string").alias("last_seen"), "freshness", (F.col("freshness") != "fresh").cast("int").alias("needs_attention")
    )


