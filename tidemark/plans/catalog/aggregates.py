"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.periods import month_of
from tidemark.functions.stats import pearson, upper_median_by
from tidemark.operators import history, indices, rollups, snapshots, vintage
from tidemark.plans import model as M
from tidemark.plans.catalog.base import DIGEST, MUN, R, REV, obs_sql, query, r
from tidemark.plans.catalog.joins import COLUMNS, DIFF, customer_snapshots, snapshot_sql
from tidemark.session import cut_lineage, literal_table

_MONTH = "(year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER"


@query(
    "a1_sum_by_place_and_period",
    f"""SELECT l_suppkey % 50 AS g, (year(l_shipdate) * 4 + quarter(l_shipdate) - 1)::INTEGER AS pidx,
    {R('sum(CAST(l_quantity AS DECIMAL(18,2)) + CAST(coalesce(l_tax, 0) AS DECIMAL(18,2)))::DOUBLE', 2)} AS value FROM lineitem GROUP BY ALL""",
)
def sum_by_place_and_period(spark, sf_dir):
    line = M.table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 50).alias("g"), (F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1).alias("pidx"), "l_quantity", "l_tax"
    )
    return rollups.sum_by(line, ["g", "pidx"], "l_quantity", "l_tax").select("g", "pidx", r("value", 2))


@query(
    "a2_count_by_kind",
    f"SELECT c_nationkey, {_MONTH} AS pidx, o_orderpriority AS kind, count(*) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
)
def count_by_kind(spark, sf_dir):
    facts = M.order_facts(spark, sf_dir).withColumnsRenamed({"m": "pidx", "o_orderpriority": "kind"})
    return rollups.count_by(facts, ["c_nationkey", "pidx", "kind"])


@query(
    "a3_mean_by_day",
    f"SELECT event_type, ts::DATE::VARCHAR AS day, {R('avg(value)')} AS value FROM events GROUP BY ALL",
)
def mean_by_day(spark, sf_dir):
    e = M.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    return rollups.mean_by(e, ["event_type", "day"], "value").select("event_type", "day", r("value"))


@query(
    "a4_last_of_month",
    f"SELECT o_custkey, {_MONTH} AS pidx, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS value FROM orders GROUP BY ALL",
)
def last_of_month(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders").withColumn("pidx", month_of("o_orderdate"))
    return rollups.last_in_period(o, ["o_custkey", "pidx"], "o_totalprice", ["o_orderdate", "o_orderkey"])


@query(
    "a5_subset_share",
    f"SELECT c_nationkey, {_MONTH} AS pidx, {R('100.0::DOUBLE * count(*) FILTER (WHERE c_mktsegment IN (' + chr(39) + 'BUILDING' + chr(39) + ')) / count(*)')} AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
)
def subset_share(spark, sf_dir):
    facts = M.order_facts(spark, sf_dir).withColumnRenamed("m", "pidx")
    return rollups.share_by(facts, ["c_nationkey", "pidx"], F.col("c_mktsegment") == "BUILDING").select("c_nationkey", "pidx", r("value"))


@query(
    "a6_kind_ratio",
    f"""WITH k AS (SELECT {_MONTH} AS pidx, o_orderstatus AS kind, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS v FROM orders GROUP BY ALL)
    SELECT a.pidx, {R('100.0::DOUBLE * a.v / b.v')} AS value FROM k a JOIN k b USING (pidx) WHERE a.kind = 'O' AND b.kind = 'F' AND b.v <> 0""",
)
def kind_ratio(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders").groupBy(month_of("o_orderdate").alias("pidx"), F.col("o_orderstatus").alias("kind")).agg(
        F.sum(M.money("o_totalprice")).cast("double").alias("v")
    )
    return rollups.kind_ratio(o, ["pidx"], "kind", "O", "F", "v", 100.0).select("pidx", r("value"))


@query(
    "a7_multi_holder_share",
    f"""WITH h AS (SELECT *, count(*) OVER (PARTITION BY p_brand, year(l_shipdate), l_suppkey) AS held FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT p_brand, year(l_shipdate)::INTEGER AS year, {R('100.0::DOUBLE * count(*) FILTER (WHERE held > 1) / count(*)')} AS value FROM h GROUP BY ALL""",
)
def multi_holder_share(spark, sf_dir):
    line = M.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"))
    part = M.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return rollups.multi_holder_share(line.join(part, "l_partkey"), ["p_brand", "year"], "l_suppkey").select("p_brand", "year", r("value"))


@query(
    "a8_attention_per_million",
    f"""WITH v AS (SELECT source, lang, count(*) FILTER (WHERE n_chars > 2000) AS views FROM documents GROUP BY ALL HAVING views > 0),
    t AS (SELECT lang, sum(n_chars)::BIGINT AS views FROM documents GROUP BY ALL)
    SELECT source, {R('1e6 * sum(v.views) / sum(t.views)')} AS value FROM v JOIN t USING (lang) GROUP BY source""",
)
def attention_per_million(spark, sf_dir):
    d = M.table(spark, sf_dir, "documents")
    views = d.where(F.col("n_chars") > 2000).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("views"))
    totals = d.groupBy("lang").agg(F.sum("n_chars").alias("views"))
    return rollups.attention_per_million(views, totals, ["source"], "lang").select("source", r("value"))


@query(
    "a9_ratio_to_base",
    f"SELECT source, {R('100.0::DOUBLE * count(*) FILTER (WHERE lang <> ' + chr(39) + 'es' + chr(39) + ') / count(*) FILTER (WHERE lang = ' + chr(39) + 'es' + chr(39) + ')')} AS value FROM documents GROUP BY source HAVING count(*) FILTER (WHERE lang = 'es') > 0",
)
def ratio_to_base(spark, sf_dir):
    d = M.table(spark, sf_dir, "documents").withColumn("views", F.lit(1))
    return rollups.base_ratio(d, ["source"], "lang", "es").select("source", r("value"))


@query(
    "a10_stock_counts",
    f"""WITH {snapshot_sql('s', '1995-02-01')}, c AS (SELECT district, count(*) FILTER (WHERE state = 'O') AS open, count(*) FILTER (WHERE state = 'F') AS closed, count(*) FILTER (WHERE state = 'O' AND kind = '1-URGENT') AS marked_open FROM s GROUP BY district),
    p AS (SELECT {MUN.replace('nk', 'n_nationkey')} AS district FROM nation UNION ALL SELECT 'mun-00099')
    SELECT district, coalesce(open, 0) AS open, coalesce(closed, 0) AS closed, coalesce(marked_open, 0) AS marked_open,
      {R('coalesce(100.0::DOUBLE * coalesce(closed, 0) / nullif(coalesce(open, 0) + coalesce(closed, 0), 0), 0)')} AS vacancy_rate FROM p LEFT JOIN c USING (district)""",
)
def stock_counts(spark, sf_dir):
    places = M.table(spark, sf_dir, "nation").select(M.mun("n_nationkey").alias("district"))
    places = places.unionByName(literal_table(spark, "district string", [("mun-00099",)]))
    out = snapshots.stock_counts(
        *customer_snapshots(spark, sf_dir, ["1995-02-01"]), places, "district",
        F.col("state") == "O", F.col("state") == "F", F.col("kind") == "1-URGENT",
    )
    return out.select("district", "open", "closed", "marked_open", r("vacancy_rate"))


FLOWS = """f AS (SELECT new_district AS district, (has_new AND new_state = 'O' AND NOT coalesce(old_state = 'O', FALSE))::INTEGER AS o, 0 AS c,
    (has_new AND new_state = 'O' AND new_kind LIKE '1%' AND NOT coalesce(old_state = 'O' AND old_kind LIKE '1%', FALSE))::INTEGER AS mo, 0 AS mc FROM d WHERE has_new
  UNION ALL SELECT old_district, 0, (has_old AND old_state = 'O' AND NOT coalesce(new_state = 'O', FALSE))::INTEGER, 0,
    (has_old AND old_state = 'O' AND old_kind LIKE '1%' AND NOT coalesce(new_state = 'O' AND new_kind LIKE '1%', FALSE))::INTEGER FROM d WHERE has_old)"""


@query(
    "a11_flow_counts",
    f"""WITH {snapshot_sql('a', '1995-06-01')}, {snapshot_sql('b', '1996-06-01')}, {DIFF}, {FLOWS}
    SELECT district, sum(o)::BIGINT AS openings, sum(c)::BIGINT AS closures, sum(mo)::BIGINT AS marked_openings, sum(mc)::BIGINT AS marked_closures FROM f GROUP BY district""",
)
def flow_counts(spark, sf_dir):
    d = snapshots.diff(*customer_snapshots(spark, sf_dir, ["1995-06-01", "1996-06-01"]), "id", COLUMNS, "state")
    return snapshots.flow_counts(d, "district", "O", "state", "kind", lambda k: k.startswith("1"))


@query(
    "a12_one_row_per_entity",
    """SELECT o_custkey, arg_min(o_orderkey, (CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderkey)) AS o_orderkey,
      arg_min(o_orderpriority, (CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderkey)) AS o_orderpriority FROM orders GROUP BY o_custkey""",
)
def one_row_per_entity(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return snapshots.one_per_entity(o, "o_custkey", F.col("o_orderpriority") == "1-URGENT", ["o_orderkey"])


@query(
    "a13_provisional_releases",
    obs_sql("orders_count", "revenue", "avg_ticket", "open_share", "qty_shipped", "discount_rate", "world_revenue")
    + f""", l AS (SELECT metric_id, max(pidx) AS pidx, count(DISTINCT geo_id) AS geographies FROM obs GROUP BY ALL),
    y AS (SELECT l.metric_id, l.pidx, l.geographies, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM l JOIN obs o USING (metric_id, pidx)
      LEFT JOIN obs p ON p.metric_id = o.metric_id AND p.geo_id = o.geo_id AND p.pidx = o.pidx - 12 AND p.value <> 0),
    g AS (SELECT metric_id, pidx, geographies, count(yoy) AS n, count(*) FILTER (WHERE yoy > 0) AS up, count(*) FILTER (WHERE yoy < 0) AS down,
      list_sort(list(abs(yoy)) FILTER (WHERE yoy IS NOT NULL))[(count(yoy) // 2 + 1)::INTEGER] AS median_move FROM y GROUP BY ALL)
    SELECT metric_id, pidx, geographies, n, up, down, {R('median_move')} AS median_move,
      (geographies >= 4 AND n >= 4 AND greatest(up, down) / n >= 0.6 AND coalesce(median_move > 40, FALSE))::INTEGER AS provisional FROM g""",
)
def provisional_releases(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "revenue", "avg_ticket", "open_share", "qty_shipped", "discount_rate", "world_revenue"])
    out = indices.provisional_releases(obs)
    return out.select("metric_id", "pidx", "geographies", "n", "up", "down", r("median_move"), F.coalesce("provisional", F.lit(False)).cast("int").alias("provisional"))


@query(
    "a14_pool_districts",
    obs_sql("segment_orders", "segment_ticket")
    + f""", p0 AS (SELECT metric_id, split_part(geo_id, '-', 2) AS place, pidx, avg(value) AS m, sum(value) AS s FROM obs GROUP BY ALL),
    p AS (SELECT metric_id, place, pidx, CASE metric_id WHEN 'segment_ticket' THEN m ELSE s END AS value FROM p0)
    SELECT metric_id, place, pidx, {R('value', 6)} AS value FROM p WHERE (metric_id, place) IN (SELECT (metric_id, place) FROM p GROUP BY metric_id, place HAVING count(*) >= 8)""",
)
def pool_districts(spark, sf_dir):
    parts = M.series(spark, sf_dir, ["segment_orders", "segment_ticket"]).withColumn("place", F.split_part("geo_id", F.lit("-"), F.lit(2)))
    how = F.when(F.col("metric_id") == "segment_ticket", "mean").otherwise("sum")
    return rollups.pool_parts(parts, ["metric_id", "place"], how).select("metric_id", "place", "pidx", r("value", 6))


@query(
    "a15_upper_median",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, list_sort(list(l_extendedprice))[(count(*) // 2 + 1)::INTEGER] AS median FROM lineitem GROUP BY ALL
    UNION ALL SELECT 'all', o_orderstatus, count(*), list_sort(list(o_totalprice))[(count(*) // 2 + 1)::INTEGER] FROM orders GROUP BY ALL""",
)
def upper_medians(spark, sf_dir):
    line = M.table(spark, sf_dir, "lineitem")
    a = upper_median_by(line, ["l_returnflag", "l_linestatus"], "l_extendedprice", count="n")
    orders = M.table(spark, sf_dir, "orders")
    b = upper_median_by(orders, ["o_orderstatus"], "o_totalprice", count="n")
    return a.unionByName(b.select(F.lit("all").alias("l_returnflag"), F.col("o_orderstatus").alias("l_linestatus"), "median", "n")).select(
        "l_returnflag", "l_linestatus", "n", "median"
    )


@query(
    "a19_outcome_counts",
    f"""WITH {REV} SELECT geo_id, CASE WHEN published_at IS NULL THEN 'declared_lag' ELSE 'published_at' END AS basis, count(*) AS rows, count(*) FILTER (WHERE revision > 0) AS revisions FROM rlog
    WHERE coalesce(published_at, observation_end + 60) <= DATE '2000-12-31' GROUP BY ALL""",
)
def outcome_counts(spark, sf_dir):
    dated = vintage.with_known_from(M.revision_log(spark, sf_dir), literal_table(spark, "source_id string, days int", M.LAGS))
    seen = vintage.visible(dated, "2000-12-31")
    return seen.groupBy("geo_id", "basis").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("revision") > 0).alias("revisions"))


@query(
    "a19_basis_and_revisions",
    f"""WITH {REV}, v AS (SELECT * FROM rlog WHERE coalesce(published_at, observation_end + 60) <= DATE '2000-12-31')
    SELECT CASE WHEN published_at IS NULL THEN 'declared_lag' ELSE 'published_at' END AS basis, count(*) AS rows, (SELECT count(*) FROM v WHERE revision > 0) AS revisions, (SELECT count(*) FROM v) AS visible FROM v GROUP BY 1""",
)
def basis_and_revisions(spark, sf_dir):
    dated = cut_lineage(vintage.with_known_from(M.revision_log(spark, sf_dir), literal_table(spark, "source_id string, days int", M.LAGS)))
    counts = history.revision_count(vintage.visible(dated, "2000-12-31"))
    out = vintage.basis_summary(dated, "2000-12-31")
    return out.withColumns({"revisions": counts.select("revisions").scalar(), "visible": counts.select("rows").scalar()})


@query(
    "a20_vintage_fingerprint",
    f"""WITH {REV}, h AS (SELECT sha256(metric_id || '|' || geo_id || '|' || lpad((pidx // 12)::VARCHAR, 4, '0') || '-' || lpad((pidx % 12 + 1)::VARCHAR, 2, '0') || '|' || revision || '|' ||
      CASE WHEN value = floor(value) THEN value::BIGINT::VARCHAR ELSE rtrim(rtrim(printf('%.6f', value), '0'), '.') END) AS h FROM rlog WHERE coalesce(published_at, observation_end + 60) <= DATE '2000-12-31')
    SELECT count(*) AS rows, {DIGEST} AS digest FROM h""",
)
def vintage_fingerprint(spark, sf_dir):
    dated = vintage.with_known_from(M.revision_log(spark, sf_dir), literal_table(spark, "source_id string, days int", M.LAGS))
    return vintage.vintage_fingerprint(dated, "2000-12-31")


@query(
    "a21_population_correlation",
    f"""SELECT l_suppkey, count(*) AS n, {R('corr(l_quantity, l_extendedprice)')} AS r FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 3""",
)
def population_correlation(spark, sf_dir):
    line = M.table(spark, sf_dir, "lineitem")
    out = line.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), pearson(F.col("l_quantity"), F.col("l_extendedprice")).alias("r"))
    return out.where(F.col("n") >= 3).select("l_suppkey", "n", r("r"))


@query(
    "a27_bounding_boxes",
    f"SELECT label, {R('min(embedding[1]::DOUBLE)', 6)} AS min_x, {R('min(embedding[2]::DOUBLE)', 6)} AS min_y, {R('max(embedding[1]::DOUBLE)', 6)} AS max_x, {R('max(embedding[2]::DOUBLE)', 6)} AS max_y FROM embeddings GROUP BY label",
)
def bounding_boxes(spark, sf_dir):
    e = M.table(spark, sf_dir, "embeddings")
    point = F.array(F.slice(F.col("embedding").cast("array<double>"), 1, 2))
    out = rollups.bounding_box(e.select("label", point.alias("points")), ["label"], "points")
    return out.select("label", *[r(c, 6) for c in ("min_x", "min_y", "max_x", "max_y")])


@query(
    "a28_legend_domain",
    obs_sql("segment_ticket", "segment_orders") + f" SELECT metric_id, pidx, {R('min(value)')} AS low, {R('max(value)')} AS high FROM obs GROUP BY ALL",
)
def legend_domain(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["segment_ticket", "segment_orders"])
    return obs.groupBy("metric_id", "pidx").agg(r(F.min("value")).alias("low"), r(F.max("value")).alias("high"))


