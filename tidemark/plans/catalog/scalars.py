"""Scalar functions (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import periods as P, stats, text as X
from tidemark.operators import series as S
from tidemark.operators.history import fingerprint
from tidemark.plans import model as M
from tidemark.plans.catalog.base import DIGEST, MARKED, PLAIN, R, obs_sql, query, r

@query(
    "n1_n2_normalised_names",
    rf"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(upper(translate(replace(text, 'ß', 'SS'), '{MARKED}', '{PLAIN}')), '[ \t\n\r\f\v]*-[ \t\n\r\f\v]*', '-', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS digest
    FROM documents""",
)
def normalised_names(spark, sf_dir):
    d = M.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(X.normalise_name("text")).alias("digest"))


_ES = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre']"


@query(
    "n3_publisher_dates",
    f"""WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
    p AS (SELECT d, strftime(d, '%Y-%m') AS m, year(d) || '-Q' || quarter(d) AS q, {_ES}[month(d)] AS name FROM d)
    SELECT form, spelled, period FROM (
      SELECT 'year-name' AS form, year(d) || '-' || upper(name[1:1]) || name[2:] AS spelled, m AS period FROM p
      UNION SELECT 'abbr year', upper(name[1:3]) || ' ' || year(d), m FROM p
      UNION SELECT 'slashes', strftime(d, '%d/%m/%Y'), m FROM p
      UNION SELECT 'month slash', year(d) || '/' || month(d), m FROM p
      UNION SELECT 'code M', strftime(d, '%YM%m'), m FROM p
      UNION SELECT 'code T', year(d) || 'T' || quarter(d), q FROM p
      UNION SELECT 'junk', 'x' || strftime(d, '%d/%m'), NULL FROM p)""",
)
def publisher_dates(spark, sf_dir):
    d = M.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    name = F.get(F.array(*[F.lit(m) for m in P.SPANISH_MONTHS]), F.month("d") - 1)
    year = F.year("d").cast("string")
    forms = {
        "year-name": F.concat(year, F.lit("-"), F.initcap(name)),
        "abbr year": F.concat(F.upper(F.substring(name, 1, 3)), F.lit(" "), year),
        "slashes": F.date_format("d", "dd/MM/yyyy"),
        "month slash": F.concat(year, F.lit("/"), F.month("d").cast("string")),
        "code M": F.date_format("d", "yyyy'M'MM"),
        "code T": F.concat(year, F.lit("T"), F.quarter("d").cast("string")),
        "junk": F.concat(F.lit("x"), F.date_format("d", "dd/MM")),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("form"), v.alias("spelled")) for k, v in forms.items()])
    return d.select(F.inline(rows)).distinct().select("form", "spelled", P.parse_period("spelled").alias("period"))


@query(
    "n4_european_numbers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS amount,
      CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE floor(o_totalprice)::DOUBLE END AS whole FROM orders""",
)
def european_numbers(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    us = F.format_number("o_totalprice", 2)
    spelled = F.translate(us, ",.", ".,")
    missing = F.get(F.array(*[F.lit(s) for s in ("_", "-", "nan", "NULL", " ")]), (F.col("o_orderkey") % 5).cast("int"))
    gap = F.col("o_orderkey") % 10 == 0
    text = o.select(
        "o_orderkey",
        F.when(gap, missing).otherwise(spelled).alias("t"),
        F.when(gap, missing).otherwise(F.format_number(F.floor("o_totalprice"), 0)).alias("w"),
    )
    return text.select("o_orderkey", X.european_number("t").alias("amount"), X.whole_number("w").cast("double").alias("whole"))


@query(
    "n5_clip_and_ratio",
    f"""SELECT l_orderkey, l_linenumber, {R('greatest(-4.0, least(4.0, (l_quantity - 25.0) / 5.0))')} AS clipped,
    {R('1000.0::DOUBLE * l_extendedprice / nullif(l_discount, 0)', 2)} AS ratio FROM lineitem""",
)
def clip_and_ratio(spark, sf_dir):
    line = M.table(spark, sf_dir, "lineitem")
    ratio = F.try_divide(F.lit(1000.0) * F.col("l_extendedprice"), F.when(F.col("l_discount") != 0, F.col("l_discount")))
    return line.select(
        "l_orderkey", "l_linenumber", r(stats.clip((F.col("l_quantity") - 25.0) / 5.0, 4.0)).alias("clipped"), r(ratio, 2).alias("ratio")
    )


_PHI = """t AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) AS x, 1.0::DOUBLE / (1.0 + 0.3275911::DOUBLE * abs(z) / sqrt(2.0::DOUBLE)) AS t FROM z),
    e AS (SELECT *, 1.0 - (0.254829592 * t - 0.284496736 * t * t + 1.421413741 * t ** 3 - 1.453152027 * t ** 4 + 1.061405429 * t ** 5) * exp(-x * x) AS erf FROM t),
    d AS (SELECT *, round(100 * 0.5 * (1.0 + CASE WHEN z < 0 THEN -erf ELSE erf END), 0) AS pct FROM e)"""


@query(
    "n6_n7_n15_diffusion_and_bands",
    obs_sql("return_rate", "avg_ticket")
    + f""", p AS (SELECT metric_id, geo_id, pidx, value, count(value) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd FROM obs
    WINDOW w AS (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    z AS (SELECT metric_id, geo_id, pidx, CASE WHEN n >= 24 AND sd <> 0 THEN greatest(-4.0, least(4.0, (value - mu) / sd)) END AS z FROM p),
    {_PHI}, o AS (SELECT *, CASE WHEN metric_id = 'return_rate' THEN 100 - pct ELSE pct END AS idx FROM d)
    SELECT metric_id, geo_id, pidx, idx AS index, CASE WHEN idx IS NULL THEN 'unknown' WHEN idx >= 60 THEN 'expansionary' WHEN idx <= 40 THEN 'contractionary' ELSE 'neutral' END AS read,
      CASE WHEN idx IS NULL THEN 'unknown' WHEN idx >= 70 THEN 'running hot' WHEN idx >= 60 THEN 'busier than usual' WHEN idx >= 40 THEN 'close to normal'
        WHEN idx >= 30 THEN 'quieter than usual' ELSE 'well below normal' END AS band FROM o""",
)
def diffusion_and_bands(spark, sf_dir):
    scored = S.zscored(M.series(spark, sf_dir, ["return_rate", "avg_ticket"]), ("metric_id", "geo_id"), "value")
    direction = F.when(F.col("metric_id") == "return_rate", -1).otherwise(1)
    out = scored.withColumn("index", stats.orient_percentile(stats.diffusion("z"), direction))
    return out.select("metric_id", "geo_id", "pidx", "index", stats.reading("index").alias("read"), stats.composite_band("index").alias("band"))


@query(
    "n8_cadence_projection",
    obs_sql("orders_count", "orders_quarter", "buyers_annual")
    + """, p AS (SELECT metric_id, geo_id, value, pidx AS month FROM obs WHERE cadence = 'monthly'
      UNION ALL SELECT metric_id, geo_id, value, unnest(range(pidx * 3, pidx * 3 + 3)) FROM obs WHERE cadence = 'quarterly'
      UNION ALL SELECT metric_id, geo_id, value, unnest(range(pidx * 12, pidx * 12 + 12)) FROM obs WHERE cadence = 'annual'),
    w AS (SELECT event_type, date_trunc('week', ts)::DATE AS monday, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS value FROM events GROUP BY ALL),
    k AS (SELECT event_type, (year(monday + 6) * 12 + month(monday + 6) - 1)::INTEGER AS month, arg_max(value, monday) AS value FROM w GROUP BY ALL)
    SELECT metric_id, geo_id, month::INTEGER AS month, value FROM p UNION ALL SELECT event_type, 'weekly', month, value FROM k""",
)
def cadence_projection(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "orders_quarter", "buyers_annual"])
    weekly = M.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric_id"), P.week_of("ts").alias("pidx")).agg(
        F.sum(M.money("value")).cast("double").alias("value")
    )
    weekly = weekly.select("metric_id", F.lit("weekly").alias("geo_id"), F.lit("weekly").alias("geo_level"), F.lit("weekly").alias("cadence"), "pidx", "value")
    return S.to_months(obs.unionByName(weekly)).select("metric_id", "geo_id", "month", "value")


@query(
    "n9_month_to_quarter",
    obs_sql("revenue") + f", q AS (SELECT geo_id, (pidx // 3)::INTEGER AS quarter, sum(CAST(value AS DECIMAL(28,2)))::DOUBLE AS value FROM obs GROUP BY ALL) SELECT geo_id, quarter, (quarter // 4) || '-Q' || (quarter % 4 + 1) AS period, {R('value', 2)} AS value FROM q",
)
def month_to_quarter(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue"])
    out = obs.groupBy("geo_id", P.month_to_quarter("pidx").alias("quarter")).agg(F.sum(F.col("value").cast("decimal(28,2)")).cast("double").alias("value"))
    return out.select("geo_id", "quarter", P.quarter_text("quarter").alias("period"), r("value", 2))


@query(
    "n10_canonical_numbers",
    """SELECT l_orderkey, l_linenumber, CASE WHEN v = floor(v) THEN floor(v)::BIGINT::VARCHAR ELSE rtrim(rtrim(printf('%.6f', v), '0'), '.') END AS shown,
      (round(v, 6) = round(v + 1e-9, 6))::INTEGER AS same FROM (SELECT *, l_extendedprice / 8 AS v FROM lineitem)""",
)
def canonical_numbers(spark, sf_dir):
    v = M.table(spark, sf_dir, "lineitem").withColumn("v", F.col("l_extendedprice") / 8)
    return v.select(
        "l_orderkey", "l_linenumber", X.canonical_number("v").alias("shown"), X.same_value(F.col("v"), F.col("v") + 1e-9).cast("int").alias("same")
    )


@query(
    "n11_headline_text",
    obs_sql("revenue", "orders_quarter")
    + f""", y AS (SELECT o.metric_id, o.geo_id, o.cadence, o.pidx, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM obs o JOIN obs p
      ON o.metric_id = p.metric_id AND o.geo_id = p.geo_id AND p.pidx = o.pidx - CASE o.cadence WHEN 'monthly' THEN 12 ELSE 4 END WHERE p.value <> 0)
    SELECT metric_id, geo_id, pidx, metric_id || ' in ' || geo_id || CASE WHEN yoy > 0 THEN ' rose ' ELSE ' fell ' END || round(abs(yoy))::BIGINT::VARCHAR || '% over the year to ' ||
      CASE cadence WHEN 'monthly' THEN strftime(make_date((pidx // 12)::INTEGER, (pidx % 12 + 1)::INTEGER, 1), '%B %Y') ELSE 'Q' || (pidx % 4 + 1) || ' ' || (pidx // 4) END || '.' AS sentence FROM y""",
)
def headline_text(spark, sf_dir):
    from tidemark.plans.dashboards import headline_sentence

    out = M.with_period(S.yoy(M.series(spark, sf_dir, ["revenue", "orders_quarter"]), ("monthly", "quarterly")))
    return out.select("metric_id", "geo_id", "pidx", headline_sentence("metric_id", "geo_id", "yoy", "period").alias("sentence"))


@query(
    "n12_json_access",
    "SELECT event_type, count(*) AS n, sum((props->>'k')::BIGINT)::BIGINT AS total, max((props->>'k')::BIGINT)::BIGINT AS top FROM events GROUP BY ALL",
)
def json_access(spark, sf_dir):
    from tidemark.sources.readers import as_array

    # A bare object is read as a one-element array, as single-item feeds need.
    e = M.table(spark, sf_dir, "events").select("event_type", as_array(F.col("props"), "struct<k:bigint>").alias("p"))
    k = F.get("p", F.lit(0))["k"]
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"), F.max(k).alias("top"))


@query(
    "n13_array_functions",
    f"""SELECT vec_id, len(embedding)::INTEGER AS dims, {R('list_sort(embedding)[(len(embedding) // 2 + 1)::INTEGER]::DOUBLE', 6)} AS middle,
      {R('list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))')} AS norm FROM embeddings""",
)
def array_functions(spark, sf_dir):
    v = M.table(spark, sf_dir, "embeddings")
    ordered = F.sort_array("embedding")
    norm = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    middle = F.get(ordered, F.floor(F.size("embedding") / F.lit(2.0)).cast("int")).cast("double")
    return v.select("vec_id", F.size("embedding").alias("dims"), r(middle, 6).alias("middle"), r(norm).alias("norm"))


@query(
    "n14_a20_fingerprint",
    f"""WITH h AS (SELECT o_orderstatus, sha256(o_orderkey || '|' || o_custkey || '|' || o_orderpriority) AS h FROM orders)
    SELECT o_orderstatus, count(*) AS rows, {DIGEST} AS digest FROM h GROUP BY o_orderstatus""",
)
def fingerprints(spark, sf_dir):
    return fingerprint(M.table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"], ["o_orderstatus"])


@query(
    "n16_unit_scale",
    "SELECT o_orderpriority, sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 1000 ELSE o_totalprice END AS DECIMAL(28,2)))::DOUBLE AS total FROM orders GROUP BY ALL",
)
def unit_scale(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    unit = F.when(F.col("o_orderstatus") == "F", "Miles de euros").otherwise("euros")
    scaled = X.base_unit_value("o_totalprice", unit).cast("decimal(28,2)")
    return o.groupBy("o_orderpriority").agg(F.sum(scaled).cast("double").alias("total"))


