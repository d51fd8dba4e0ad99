"""Window functions, orderings, top-k and set operations (W, O, U)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.stats import normal_cdf, clip
from tidemark.operators import history, series as S
from tidemark.plans import model as M
from tidemark.plans.catalog.base import BRIDGE, R, REV, obs_sql, query, r

W_SQL = "WINDOW s AS (PARTITION BY metric_id, geo_id ORDER BY pidx)"


@query(
    "w1_expanding_zscore",
    obs_sql("orders_count", "revenue", "qty_shipped", "return_rate", "orders_quarter")
    + f""", z AS (
  SELECT metric_id, geo_id, pidx, cadence, value,
    count(value) OVER p AS n, avg(value) OVER p AS mu, stddev_pop(value) OVER p AS sd FROM obs
  WINDOW p AS (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT metric_id, geo_id, pidx, {R('greatest(-4.0, least(4.0, (value - mu) / sd))')} AS z FROM z
  WHERE n >= CASE cadence WHEN 'monthly' THEN 24 ELSE 12 END AND sd <> 0""",
)
def expanding_zscore(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "revenue", "qty_shipped", "return_rate", "orders_quarter"])
    scored = S.zscored(obs, keys=("metric_id", "geo_id"), value="value")
    return scored.where(F.col("z").isNotNull()).select("metric_id", "geo_id", "pidx", r("z"))


@query(
    "w2_rolling_mean_sum",
    obs_sql("revenue", "qty_shipped")
    + f""" SELECT * FROM (SELECT metric_id, geo_id, pidx,
    CASE WHEN count(value) OVER w3 = 3 THEN {R('avg(value) OVER w3')} END AS roll_3,
    CASE WHEN count(value) OVER w12 = 12 THEN {R('sum(value) OVER w12', 2)} END AS sum_12 FROM obs
  WINDOW w3 AS (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
    w12 AS (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) WHERE roll_3 IS NOT NULL""",
)
def rolling_mean_sum(spark, sf_dir):
    w = S.series_window()
    obs = M.series(spark, sf_dir, ["revenue", "qty_shipped"])
    out = obs.withColumns({"roll_3": S.rolling("value", 3, w), "sum_12": S.rolling("value", 12, w, "sum")})
    return out.where(F.col("roll_3").isNotNull()).select("metric_id", "geo_id", "pidx", r("roll_3"), r("sum_12", 2))


@query(
    "w3_robust_outlier",
    obs_sql("avg_ticket", "return_rate", "segment_orders")
    + f""", h AS (SELECT metric_id, geo_id, pidx, value,
    list(value) OVER (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS past FROM obs),
  m AS (SELECT *, list_aggregate(past, 'median') AS med FROM h WHERE len(past) >= 6),
  d AS (SELECT *, list_aggregate(list_transform(past, lambda x: abs(x - med)), 'median') AS mad FROM m)
  SELECT metric_id, geo_id, pidx, {R('abs(value - med) / (1.4826::DOUBLE * mad)')} AS score,
    (abs(value - med) / (1.4826::DOUBLE * mad) >= 3.5)::INTEGER AS suspect FROM d WHERE mad <> 0""",
)
def robust_outlier(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["avg_ticket", "return_rate", "segment_orders"])
    out = S.with_outlier_score(obs, out="score").where(F.col("score").isNotNull())
    return out.select("metric_id", "geo_id", "pidx", r("score"), (F.col("score") >= 3.5).cast("int").alias("suspect"))


YOY = """y AS (SELECT *, 100.0::DOUBLE * (value - prior) / abs(prior) AS yoy FROM (
    SELECT *, first_value(value) OVER (PARTITION BY metric_id, geo_id, cadence ORDER BY pidx
      RANGE BETWEEN back PRECEDING AND back PRECEDING) AS prior
    FROM (SELECT *, CASE cadence WHEN 'monthly' THEN 12 WHEN 'quarterly' THEN 4 ELSE 1 END AS back FROM obs)) WHERE prior <> 0)"""


@query(
    "w4_year_over_year",
    obs_sql() + f", {YOY} SELECT metric_id, geo_id, pidx, {R('yoy')} AS yoy FROM y",
)
def year_over_year(spark, sf_dir):
    out = S.yoy(M.series(spark, sf_dir), ("monthly", "quarterly", "annual"))
    return out.select("metric_id", "geo_id", "pidx", r("yoy"))


@query(
    "w5_calendar_change",
    obs_sql("discount_rate", "orders_quarter", "segment_orders")
    + f""" SELECT o.metric_id, o.geo_id, o.pidx, {R('o.value - a.value')} AS change_4, {R('o.value - b.value')} AS change_12
  FROM obs o JOIN obs a ON o.metric_id = a.metric_id AND o.geo_id = a.geo_id AND a.pidx = o.pidx - 4
  LEFT JOIN obs b ON o.metric_id = b.metric_id AND o.geo_id = b.geo_id AND b.pidx = o.pidx - 12""",
)
def calendar_change(spark, sf_dir):
    w = S.series_window()
    obs = M.series(spark, sf_dir, ["discount_rate", "orders_quarter", "segment_orders"])
    out = S.change(obs.withColumn("change_12", F.col("value") - S.at_offset("value", -12, w)), 4)
    return out.select("metric_id", "geo_id", "pidx", r(F.col("change")).alias("change_4"), r("change_12"))


@query(
    "w7_current_view",
    f"""WITH {REV} SELECT geo_id, pidx, arg_max(value, revision) AS value, max(revision) AS revision, count(*) AS revisions
    FROM rlog GROUP BY ALL""",
)
def current_view(spark, sf_dir):
    out = history.current_view(M.revision_log(spark, sf_dir), sizes="revisions")
    return out.select("geo_id", "pidx", "value", "revision", "revisions")


@query(
    "w8_latest_observation",
    obs_sql() + " SELECT metric_id, geo_id, max(pidx) AS pidx, arg_max(value, pidx) AS value FROM obs GROUP BY ALL",
)
def latest_observation(spark, sf_dir):
    return S.latest(M.series(spark, sf_dir)).select("metric_id", "geo_id", "pidx", "value")


@query(
    "w10_events_to_months",
    """WITH k AS (SELECT o_custkey, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS month,
      arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS value FROM orders GROUP BY ALL),
    s AS (SELECT *, coalesce(lead(month) OVER (PARTITION BY o_custkey ORDER BY month) - 1, month) AS until FROM k)
    SELECT o_custkey, unnest(range(month, until + 1))::INTEGER AS month, value FROM s""",
)
def events_to_months(spark, sf_dir):
    orders = M.table(spark, sf_dir, "orders")
    events = orders.groupBy("o_custkey", "o_orderdate").agg(F.max_by("o_totalprice", "o_orderkey").alias("value"))
    return S.fill_months(events.withColumnRenamed("o_orderdate", "at"), ("o_custkey",))


@query(
    "w11_previous_value",
    obs_sql("revenue")
    + " SELECT geo_id, pidx, value, lag(value) OVER (PARTITION BY geo_id ORDER BY pidx) AS previous FROM obs",
)
def previous_value(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue"])
    return obs.select("geo_id", "pidx", "value", F.lag("value").over(S.series_window()).alias("previous"))


@query(
    "w12_episodes",
    obs_sql("return_rate")
    + """, f AS (SELECT geo_id, pidx, value > 36 AS high FROM obs),
    g AS (SELECT *, high AND NOT coalesce(lag(high) OVER w, FALSE) AS starts FROM f WINDOW w AS (PARTITION BY geo_id ORDER BY pidx)),
    n AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY geo_id ORDER BY pidx ROWS UNBOUNDED PRECEDING) AS episode FROM g)
    SELECT geo_id, episode::BIGINT AS episode, min(pidx) AS first_pidx, max(pidx) AS last_pidx, count(*) AS length
    FROM n WHERE high GROUP BY ALL""",
)
def episodes(spark, sf_dir):
    flagged = M.series(spark, sf_dir, ["return_rate"]).withColumn("high", F.col("value") > 36)
    runs = S.episodes(flagged, "high", ("geo_id",)).where("high")
    return runs.groupBy("geo_id", "episode").agg(
        F.min("pidx").alias("first_pidx"), F.max("pidx").alias("last_pidx"), F.count(F.lit(1)).alias("length")
    )


@query(
    "w13_look_ahead",
    obs_sql("return_rate")
    + """ SELECT geo_id, pidx, coalesce(max((value > 36)::INTEGER) OVER w, 0) AS ahead, (count(*) OVER w = 6)::INTEGER AS complete
    FROM obs WINDOW w AS (PARTITION BY geo_id ORDER BY pidx ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING)""",
)
def look_ahead(spark, sf_dir):
    w = S.series_window(("geo_id",))
    flagged = M.series(spark, sf_dir, ["return_rate"]).withColumn("high", F.col("value") > 36)
    return flagged.select(
        "geo_id",
        "pidx",
        S.any_ahead("high", 6, w).cast("int").alias("ahead"),
        S.full_ahead(6, w).cast("int").alias("complete"),
    )


@query(
    "w14_carry_stress",
    obs_sql("world_revenue", "avg_ticket")
    + f""", b AS (SELECT *, lag(value, 3) OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS base FROM obs),
    s AS (SELECT metric_id, geo_id, pidx, -((value - base) * 100 / base) AS stress FROM b WHERE base <> 0)
    SELECT metric_id, geo_id, pidx, {R('stress')} AS stress,
      CASE WHEN stress > 4 THEN 'contractionary' WHEN stress > -4 THEN 'neutral' ELSE 'expansionary' END AS read FROM s""",
)
def carry_stress(spark, sf_dir):
    out = S.carry_stress(M.series(spark, sf_dir, ["world_revenue", "avg_ticket"]))
    return out.select("metric_id", "geo_id", "pidx", r("stress"), "read")


@query(
    "w15_w16_error_quantiles",
    obs_sql("revenue")
    + f""", e AS (SELECT geo_id, pidx, value - lag(value, 3) OVER (PARTITION BY geo_id ORDER BY pidx) AS err FROM obs),
    x AS (SELECT a.geo_id, a.pidx, quantile_cont(b.err, [0.1, 0.5, 0.9]) AS q, avg(CASE WHEN b.err > 0 THEN 1.0 ELSE 0.0 END) AS up
      FROM e a JOIN e b ON a.geo_id = b.geo_id AND b.pidx <= a.pidx WHERE b.err IS NOT NULL GROUP BY ALL)
    SELECT geo_id, pidx, {R('q[1]', 3)} AS q10, {R('q[2]', 3)} AS q50, {R('q[3]', 3)} AS q90, {R('up')} AS share_up FROM x""",
)
def error_quantiles(spark, sf_dir):
    w = S.series_window()
    prefix = w.rowsBetween(Window.unboundedPreceding, 0)
    err = M.series(spark, sf_dir, ["revenue"]).withColumn("err", F.col("value") - F.lag("value", 3).over(w))
    up = F.avg(F.when(F.col("err") > 0, 1.0).when(F.col("err").isNotNull(), 0.0)).over(prefix)
    out = S.with_prefix_quantiles(err.withColumn("share_up", up), {"q": "err"}, [0.1, 0.5, 0.9]).where(F.col("q").isNotNull())
    return out.select(
        "geo_id",
        "pidx",
        *[r(F.col("q")[i], 3).alias(n) for i, n in enumerate(("q10", "q50", "q90"))],
        r("share_up"),
    )


@query(
    "w17_district_rank",
    obs_sql("segment_ticket")
    + f""", l AS (SELECT geo_id, arg_max(value, pidx) AS value FROM obs GROUP BY geo_id)
    SELECT geo_id, split_part(geo_id, '-', 2) AS parent, {R('value')} AS ticket,
      row_number() OVER (PARTITION BY split_part(geo_id, '-', 2) ORDER BY value DESC, geo_id) AS position FROM l""",
)
def district_rank(spark, sf_dir):
    newest = S.latest(M.series(spark, sf_dir, ["segment_ticket"])).withColumn("parent", F.split_part("geo_id", F.lit("-"), F.lit(2)))
    order = Window.partitionBy("parent").orderBy(F.col("value").desc(), "geo_id")
    return newest.select("geo_id", "parent", r(F.col("value")).alias("ticket"), F.row_number().over(order).cast("bigint").alias("position"))


MOVERS = (
    obs_sql("orders_count", "revenue", "avg_ticket", "return_rate", "discount_rate")
    + f""", {YOY}, {BRIDGE},
    last_ AS (SELECT metric_id, geo_id, geo_level, max(pidx) AS pidx, arg_max(yoy, pidx) AS yoy FROM y GROUP BY ALL),
    placed AS (SELECT b.place, l.* FROM last_ l JOIN bridge b USING (geo_level, geo_id)),
    first_ AS (SELECT *, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY abs(yoy) DESC, place) AS rn FROM placed)"""
)


def _movers(spark, sf_dir):
    """Newest yoy of each series with the first place that reads it."""
    from tidemark.operators.places import bridge, resolve

    obs = M.series(spark, sf_dir, ["orders_count", "revenue", "avg_ticket", "return_rate", "discount_rate"])
    newest = S.latest(S.yoy(obs).select("metric_id", "geo_id", "geo_level", "pidx", "yoy"))
    placed = resolve(newest, bridge(M.places(spark, sf_dir)))
    rest = [c for c in placed.columns if c not in ("metric_id", "geo_id")]
    first = placed.groupBy("metric_id", "geo_id").agg(F.min_by(F.struct(*rest), F.col("place")).alias("_r"))
    return first.select("metric_id", "geo_id", "_r.*")


@query("w18_first_place_per_series", MOVERS + f" SELECT metric_id, geo_id, place, {R('yoy')} AS yoy FROM first_ WHERE rn = 1")
def first_place_per_series(spark, sf_dir):
    return _movers(spark, sf_dir).select("metric_id", "geo_id", "place", r("yoy"))


@query(
    "o1_top_movers",
    MOVERS
    + f""" SELECT metric_id, geo_id, place, pidx, {R('yoy')} AS yoy FROM first_ WHERE rn = 1
    ORDER BY abs(yoy) DESC, metric_id, geo_id LIMIT 24""",
)
def top_movers(spark, sf_dir):
    ordered = _movers(spark, sf_dir).orderBy(F.abs("yoy").desc(), "metric_id", "geo_id").limit(24)
    return ordered.select("metric_id", "geo_id", "place", "pidx", r("yoy"))


@query(
    "w19_normal_percentile",
    obs_sql("revenue")
    + f""", p AS (SELECT geo_id, pidx, value, count(value) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd FROM obs
    WINDOW w AS (PARTITION BY geo_id ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    z AS (SELECT geo_id, pidx, greatest(-4.0, least(4.0, (value - mu) / sd)) AS z FROM p WHERE n >= 24 AND sd <> 0),
    t AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) AS x, 1.0::DOUBLE / (1.0 + 0.3275911::DOUBLE * abs(z) / sqrt(2.0::DOUBLE)) AS t FROM z),
    e AS (SELECT *, 1.0 - (0.254829592 * t - 0.284496736 * t * t + 1.421413741 * t ** 3 - 1.453152027 * t ** 4 + 1.061405429 * t ** 5) * exp(-x * x) AS erf FROM t)
    SELECT geo_id, pidx, {R('100 * 0.5 * (1.0 + CASE WHEN z < 0 THEN -erf ELSE erf END)')} AS percentile FROM e""",
)
def normal_percentile(spark, sf_dir):
    scored = S.zscored(M.series(spark, sf_dir, ["revenue"]), ("metric_id", "geo_id"), "value")
    out = scored.where(F.col("z").isNotNull())
    return out.select("geo_id", "pidx", r(normal_cdf(clip("z", 4.0)) * 100).alias("percentile"))


# --- Orderings and set operations ------------------------------------------------------
@query(
    "o3_o7_places_nulls_last",
    """WITH c AS (SELECT n_name AS place, count(o_orderkey) AS orders, (sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate >= DATE '2001-08-01'))::DOUBLE AS august
      FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
    SELECT place, orders, august FROM c""",
)
def places_nulls_last(spark, sf_dir):
    facts = M.order_facts(spark, sf_dir)
    agg = facts.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.when(F.col("o_orderdate") >= F.lit("2001-08-01").cast("timestamp_ntz"), M.money("o_totalprice"))).cast("double").alias("august"),
    )
    out = M.table(spark, sf_dir, "nation").join(agg, "n_nationkey", "left")
    named = out.select(F.col("n_name").alias("place"), F.coalesce("orders", F.lit(0)).alias("orders"), "august")
    return named.orderBy(F.col("august").desc_nulls_last(), "place")


@query(
    "o5_o8_top_per_place",
    obs_sql("orders_count", "revenue", "avg_ticket", "open_share", "urgent_share")
    + f""", {YOY}, l AS (SELECT metric_id, geo_id, arg_max(yoy, pidx) AS yoy FROM y GROUP BY ALL)
    SELECT * FROM (SELECT geo_id, metric_id, {R('yoy')} AS yoy,
      row_number() OVER (PARTITION BY geo_id ORDER BY abs(yoy) DESC, metric_id) AS position FROM l) WHERE position <= 2""",
)
def top_per_place(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "revenue", "avg_ticket", "open_share", "urgent_share"])
    newest = S.latest(S.yoy(obs).select("metric_id", "geo_id", "pidx", "yoy"))
    order = Window.partitionBy("geo_id").orderBy(F.abs("yoy").desc(), "metric_id")
    top = newest.withColumn("position", F.row_number().over(order).cast("bigint")).where(F.col("position") <= 2)
    return top.select("geo_id", "metric_id", r("yoy"), "position")


@query(
    "o9_extremes",
    obs_sql("segment_ticket")
    + """ SELECT pidx, arg_max(geo_id, (value, geo_id)) AS highest, arg_min(geo_id, (value, geo_id)) AS lowest FROM obs GROUP BY pidx""",
)
def extremes(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["segment_ticket"])
    rank = F.struct("value", "geo_id")
    return obs.groupBy("pidx").agg(F.max_by("geo_id", rank).alias("highest"), F.min_by("geo_id", rank).alias("lowest"))


@query(
    "u1_union_of_sources",
    obs_sql() + " SELECT metric_id, geo_level, cadence, count(*) AS observations, min(pidx) AS first_pidx, max(pidx) AS last_pidx FROM obs GROUP BY ALL",
)
def union_of_sources(spark, sf_dir):
    obs = M.series(spark, sf_dir)
    return obs.groupBy("metric_id", "geo_level", "cadence").agg(
        F.count(F.lit(1)).alias("observations"), F.min("pidx").alias("first_pidx"), F.max("pidx").alias("last_pidx")
    )


@query(
    "u2_entity_sets",
    """WITH a AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE year(o_orderdate) = 2000),
    b AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE year(o_orderdate) = 2001)
    SELECT 'added' AS change, id FROM b WHERE id NOT IN (SELECT id FROM a)
    UNION ALL SELECT 'removed', id FROM a WHERE id NOT IN (SELECT id FROM b)
    UNION ALL SELECT 'common', id FROM a WHERE id IN (SELECT id FROM b)""",
)
def entity_sets(spark, sf_dir):
    # One aggregate over both years instead of three set joins.
    orders = M.table(spark, sf_dir, "orders").where(F.year("o_orderdate").isin(2000, 2001))
    seen = orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.bool_or(F.year("o_orderdate") == 2000).alias("a"), F.bool_or(F.year("o_orderdate") == 2001).alias("b")
    )
    change = F.when(F.col("a") & F.col("b"), "common").when(F.col("b"), "added").otherwise("removed")
    return seen.select(change.alias("change"), "id")


@query(
    "u3_complete_periods",
    obs_sql("orders_count", "orders_quarter", "qty_shipped", "discount_rate")
    + """ SELECT pidx, count(*) AS series FROM obs WHERE cadence = 'monthly' GROUP BY pidx
    HAVING count(DISTINCT metric_id) = 3""",
)
def complete_periods(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "qty_shipped", "discount_rate"])
    out = obs.groupBy("pidx").agg(F.count(F.lit(1)).alias("series"), F.count_distinct("metric_id").alias("_n"))
    return out.where(F.col("_n") == 3).drop("_n")


@query(
    "u4_a29_known_periods",
    obs_sql() + " SELECT DISTINCT metric_id, cadence, pidx FROM obs",
)
def known_periods(spark, sf_dir):
    return M.series(spark, sf_dir).select("metric_id", "cadence", "pidx").distinct()


