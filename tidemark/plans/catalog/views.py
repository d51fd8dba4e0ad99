"""Composite queries a user asks for (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.periods import month_of, month_text
from tidemark.operators import desk, indices, places, regimes
from tidemark.plans import dashboards as D
from tidemark.plans import model as M
from tidemark.plans.catalog import forecasts as FQ
from tidemark.plans.catalog import signals as SQ
from tidemark.plans.catalog import streams as _streams  # noqa: F401  its SQL is shown in a document
from tidemark.plans.catalog.base import BRIDGE, DIST, ORACLE, PERIOD_M, R, obs_sql, query, r, values_sql
from tidemark.plans.catalog.joins import COLUMNS, DIFF, customer_snapshots, snapshot_sql
from tidemark.plans.catalog.aggregates import FLOWS
from tidemark.session import cut_lineage, literal_table, scratch_path
from tidemark.sources import sinks
from tidemark.sources.dims import SOURCE_SCHEMA

AS_OF = "2001-09-15"
CADENCES = ("monthly", "quarterly", "annual")
CITY_METRICS = [m[0] for m in M.METRICS if m[4] != "district"]


def sources(spark):
    return literal_table(spark, SOURCE_SCHEMA, M.SOURCES)


def bridge(spark, sf_dir):
    return places.bridge(M.places(spark, sf_dir))


def tail_columns(column: str = "series"):
    """Length, first period and sum of a tail, and the sum of its values by their place: its contents in four numbers."""
    value = lambda x: F.coalesce(x["value"], F.lit(0.0))
    placed = F.transform(column, lambda x, i: value(x) * (i + 1))
    return [
        F.size(column).cast("bigint").alias("tail_length"), F.array_min(F.transform(column, lambda x: x["pidx"])).alias("tail_from"),
        r(F.aggregate(column, F.lit(0.0), lambda a, x: a + value(x)), 1).alias("tail_sum"), r(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 0).alias("tail_weighted"),
    ]


TAILS = f"""tails AS (SELECT metric_id, geo_id, count(*) AS tail_length, min(pidx) AS tail_from, {R('sum(value)', 1)} AS tail_sum, {R('sum(value * spot)', 0)} AS tail_weighted FROM (
    SELECT *, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS spot FROM (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx DESC) <= 96)) GROUP BY ALL)"""


def cards(spark, sf_dir):
    obs = cut_lineage(M.series(spark, sf_dir, CITY_METRICS))
    return D.metric_cards(obs, M.registry(spark), sources(spark), bridge(spark, sf_dir), AS_OF, CADENCES)


_STEP = "CASE o.cadence WHEN 'monthly' THEN 12 WHEN 'quarterly' THEN 4 ELSE 1 END"
CARDS = (
    obs_sql(*CITY_METRICS)
    + f""", {values_sql('reg', 'metric_id, label, section, direction, source_id', [(m[0], m[1], m[6], m[7], m[5]) for m in M.METRICS])},
  {values_sql('src', 'source_id, max_age', [(x[0], x[4]) for x in M.SOURCES])}, {BRIDGE},
  y AS (SELECT o.*, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM obs o LEFT JOIN obs p ON p.metric_id = o.metric_id AND p.geo_id = o.geo_id AND p.pidx = o.pidx - {_STEP} AND p.value <> 0),
  past AS (SELECT *, list(value) OVER (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS l, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx DESC) AS rn FROM y),
  nw AS (SELECT *, list_aggregate(l, 'median') AS med FROM past WHERE rn = 1),
  ou AS (SELECT *, CASE WHEN len(l) >= 6 THEN abs(value - med) / nullif(1.4826::DOUBLE * list_aggregate(list_transform(l, lambda x: abs(x - med)), 'median'), 0) END AS outlier_score FROM nw),
  mx AS (SELECT metric_id, max(pidx) AS pidx, count(DISTINCT geo_id) AS g FROM obs GROUP BY ALL),
  pv AS (SELECT mx.metric_id, mx.pidx, (g >= 4 AND count(yoy) >= 4 AND greatest(count(*) FILTER (WHERE yoy > 0), count(*) FILTER (WHERE yoy < 0)) / nullif(count(yoy), 0) >= 0.6
      AND list_sort(list(abs(yoy)) FILTER (WHERE yoy IS NOT NULL))[(count(yoy) // 2 + 1)::INTEGER] > 40) AS provisional FROM mx JOIN y USING (metric_id, pidx) GROUP BY mx.metric_id, mx.pidx, g),
  cd AS (SELECT ou.*, reg.label, reg.section, reg.direction, coalesce(pv.provisional, FALSE) AS provisional, coalesce(pv.provisional, FALSE) OR coalesce(outlier_score >= 3.5, FALSE) AS suspect,
      (CASE cadence WHEN 'annual' THEN make_date(ou.pidx, 12, 31) WHEN 'quarterly' THEN last_day(make_date((ou.pidx // 4)::INTEGER, ((ou.pidx % 4) * 3 + 3)::INTEGER, 1)) ELSE last_day(make_date((ou.pidx // 12)::INTEGER, (ou.pidx % 12 + 1)::INTEGER, 1)) END) AS oe, src.max_age
    FROM ou JOIN reg USING (metric_id) LEFT JOIN src USING (source_id) LEFT JOIN pv ON pv.metric_id = ou.metric_id AND pv.pidx = ou.pidx),
  fr AS (SELECT *, (DATE '{AS_OF}' - oe)::INTEGER AS staleness_days, CASE WHEN max_age IS NULL THEN 'unknown' WHEN DATE '{AS_OF}' - oe <= max_age THEN 'fresh' WHEN DATE '{AS_OF}' - oe <= 2 * max_age THEN 'stale' ELSE 'failing' END AS fresh FROM cd),
  card AS (SELECT b.place, fr.* FROM fr JOIN bridge b USING (geo_level, geo_id))"""
)


@query(
    "q1_metric_cards",
    CARDS
    + f""", {TAILS} SELECT place, metric_id, geo_id, label, section, pidx, {R('value')} AS value, {R('yoy')} AS yoy, {R('outlier_score')} AS outlier_score, provisional::INTEGER AS provisional, suspect::INTEGER AS suspect, oe::VARCHAR AS observation_end,
    staleness_days, fresh, tail_length, tail_from, tail_sum, tail_weighted FROM card JOIN tails USING (metric_id, geo_id)""",
)
def metric_cards(spark, sf_dir):
    out = cards(spark, sf_dir)
    return out.select(
        "place", "metric_id", "geo_id", "label", "section", "pidx", r("value"), r("yoy"), r("outlier_score"),
        F.col("provisional").cast("int").alias("provisional"), F.col("suspect").cast("int").alias("suspect"),
        F.col("observation_end").cast("string").alias("observation_end"), "staleness_days", "fresh", *tail_columns(),
    )


ELIGIBLE = "yoy IS NOT NULL AND fresh <> 'failing' AND NOT suspect"


@query(
    "q5_overview_movers",
    CARDS
    + f""", mv AS (SELECT * FROM card WHERE {ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY place) = 1)
    SELECT place, metric_id, geo_id, pidx, {R('yoy')} AS yoy FROM mv ORDER BY abs(yoy) DESC, metric_id, geo_id LIMIT 24""",
)
def overview_movers(spark, sf_dir):
    return D.top_movers(cards(spark, sf_dir)).select("place", "metric_id", "geo_id", "pidx", r("yoy"))


@query(
    "q5_o2_headline",
    CARDS
    + f""", mv AS (SELECT * FROM card WHERE {ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY place) = 1)
    SELECT metric_id, geo_id, label || ' in ' || place || CASE WHEN yoy > 0 THEN ' rose ' ELSE ' fell ' END || round(abs(yoy))::BIGINT || '% over the year to ' ||
      CASE cadence WHEN 'monthly' THEN strftime(make_date((pidx // 12)::INTEGER, (pidx % 12 + 1)::INTEGER, 1), '%B %Y') WHEN 'quarterly' THEN 'Q' || (pidx % 4 + 1) || ' ' || (pidx // 4) ELSE pidx::VARCHAR END || '.' AS sentence,
      CASE WHEN geo_level = 'municipality' THEN '{D.QUALIFIER_OF_CITY}' ELSE '{D.QUALIFIER_OF_LEVEL[0]}' || geo_level || '{D.QUALIFIER_OF_LEVEL[1]}' END AS qualifier
    FROM mv WHERE geo_level IN ('municipality', 'province') AND abs(yoy) >= 5 ORDER BY abs(yoy) DESC, metric_id, geo_id LIMIT 1""",
)
def headline(spark, sf_dir):
    return D.headline(cards(spark, sf_dir)).select("metric_id", "geo_id", "sentence", "qualifier")


@query(
    "q3_district_payload",
    obs_sql("segment_orders", "segment_ticket")
    + f""", {TAILS}, n AS (SELECT o.metric_id, o.geo_id, o.pidx, o.value, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy
      FROM obs o LEFT JOIN obs p ON p.metric_id = o.metric_id AND p.geo_id = o.geo_id AND p.pidx = o.pidx - 12 AND p.value <> 0 QUALIFY row_number() OVER (PARTITION BY o.metric_id, o.geo_id ORDER BY o.pidx DESC) = 1)
    SELECT lower(n_name) AS place, metric_id, split_part(geo_id, '-', 3) AS code, pidx, {R('value')} AS value, {R('yoy')} AS yoy, tail_length, tail_from, tail_sum, tail_weighted FROM n JOIN tails USING (metric_id, geo_id) JOIN nation ON split_part(geo_id, '-', 2) = printf('%05d', n_nationkey + 1)""",
)
def district_payload(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["segment_orders", "segment_ticket"])
    out = D.district_payload(obs, M.districts(spark, sf_dir))
    return out.select("place", "metric_id", "code", "pidx", r("value"), r("yoy"), *tail_columns())


# --- City document and standings --------------------------------------------------------
DESK_METRICS = ["revenue", "avg_ticket", "return_rate", "open_share", "urgent_share", "segment_orders", "segment_ticket"]
_POOL = {"segment_orders": "sum", "segment_ticket": "mean"}


def desk_entries(spark, sf_dir):
    obs = cut_lineage(M.series(spark, sf_dir, DESK_METRICS))
    series = D.desk_series(obs, bridge(spark, sf_dir), M.districts(spark, sf_dir), desk.pooling_rule(F.col("metric_id"), _POOL))
    return desk.entries(series, M.registry(spark).select("metric_id", "direction"))


@query(
    "q2_city_payload",
    SQ.recursive(SQ.ZSQL + SQ.WIDE + SQ.VERDICT + SQ.HELD)
    + f""", cards AS (SELECT b.place, o.metric_id FROM obs o JOIN bridge b USING (geo_level, geo_id) WHERE metric_id IN ('orders_count', 'revenue', 'avg_ticket', 'open_share', 'urgent_share', 'orders_quarter', 'buyers_annual', 'qty_shipped', 'return_rate', 'discount_rate') GROUP BY ALL)
    SELECT lower(n_name) AS place, (SELECT count(*) FROM cards c WHERE c.place = lower(n_name)) + 1 AS cards, 4 AS indices, (SELECT count(*) FROM ih WHERE ih.place = lower(n_name)) AS index_points,
      (SELECT count(*) FROM tl WHERE tl.place = lower(n_name)) AS timeline, 10 AS districts, 7 AS desk, 4 AS signatures, 6 AS leadlag FROM nation""",
)
def city_payload(spark, sf_dir):
    placed = cut_lineage(SQ.placed_scores(spark, sf_dir))
    comp = SQ.components(spark)
    current, history = indices.current_index(placed, comp), cut_lineage(indices.index_history(placed, comp))
    ranked = indices.ranked_signatures(indices.match_signatures(placed, M.SIGNALS, M.places(spark, sf_dir)))
    district = D.district_payload(M.series(spark, sf_dir, ["segment_orders", "segment_ticket"]), M.districts(spark, sf_dir))
    doc = D.city_payload(
        cards(spark, sf_dir),
        regimes.summary(current, history),
        current,
        history,
        regimes.hold(regimes.verdicts(history)),
        district,
        desk_entries(spark, sf_dir),
        ranked,
        SQ.lead_lag(spark, sf_dir),
    )
    n_cards = F.aggregate(F.map_values("sections"), F.lit(0), lambda acc, c: acc + F.size(c))
    return doc.select(
        "place",
        n_cards.cast("bigint").alias("cards"),
        F.size("indices").alias("indices"),
        F.size("index_history").cast("bigint").alias("index_points"),
        F.size("regime_timeline").cast("bigint").alias("timeline"),
        *[F.size(c).alias(c) for c in ("districts", "desk", "signatures", "leadlag")],
    )


@query(
    "q5_city_standings",
    SQ.ZSQL
    + f""", {values_sql('s', 'archetype_id, metric_id, transform, expect', M.SIGNALS)}, nw AS (SELECT place, metric_id, transform, arg_max(z, month) AS z, max(month) AS month, arg_max(oriented, month) AS oriented FROM pz GROUP BY ALL),
    m AS (SELECT lower(n_name) AS place, s.archetype_id, count(*) AS total, count(z) AS available, count(*) FILTER (WHERE {SQ._FIRES}) AS firing FROM nation CROSS JOIN s
      LEFT JOIN nw ON nw.place = lower(n_name) AND nw.metric_id = s.metric_id AND nw.transform = s.transform GROUP BY ALL),
    tp AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY place ORDER BY firing::DOUBLE / nullif(available, 0) DESC NULLS LAST, available::DOUBLE / total DESC, archetype_id) = 1),
    g AS (SELECT place, index_id, CASE WHEN count(*) >= max(min_components) THEN sum(oriented * weight) / sum(weight) END AS value FROM nw JOIN comp USING (metric_id, transform) GROUP BY ALL)
    SELECT place, archetype_id AS top_signature, {R('firing::DOUBLE / nullif(available, 0)')} AS top_score, {R("(SELECT value FROM g WHERE g.place = tp.place AND index_id = 'distress')")} AS distress FROM tp""",
)
def city_standings(spark, sf_dir):
    placed = cut_lineage(SQ.placed_scores(spark, sf_dir))
    comp = SQ.components(spark)
    current = indices.current_index(placed, comp)
    ranked = indices.ranked_signatures(indices.match_signatures(placed, M.SIGNALS, M.places(spark, sf_dir)))
    out = D.standings(regimes.summary(current, indices.index_history(placed, comp)), current, ranked)
    return out.select("place", "top_signature", r("top_score"), r(F.col("indices")["distress"]).alias("distress"))


# --- Desk ---------------------------------------------------------------------------------
_PHI = """t AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) AS x, 1.0::DOUBLE / (1.0 + 0.3275911::DOUBLE * abs(z) / sqrt(2.0::DOUBLE)) AS t FROM z),
    e AS (SELECT *, 1.0 - (0.254829592 * t - 0.284496736 * t * t + 1.421413741 * t ** 3 - 1.453152027 * t ** 4 + 1.061405429 * t ** 5) * exp(-x * x) AS erf FROM t),
    d AS (SELECT *, round(100 * 0.5 * (1.0 + CASE WHEN z < 0 THEN -erf ELSE erf END), 0) AS pct FROM e)"""
DESK = (
    obs_sql(*DESK_METRICS)
    + f""", {BRIDGE}, {values_sql('dir', 'metric_id, direction', [(m[0], m[7]) for m in M.METRICS])},
  ser AS (SELECT b.place, o.metric_id, o.pidx, o.value FROM obs o JOIN bridge b USING (geo_level, geo_id)
    UNION ALL SELECT lower(n_name), metric_id, pidx, CASE metric_id WHEN 'segment_ticket' THEN avg(value) ELSE sum(value) END FROM obs JOIN nation ON geo_level = 'district' AND split_part(geo_id, '-', 2) = printf('%05d', n_nationkey + 1) GROUP BY n_name, metric_id, pidx),
  p AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd FROM ser WINDOW w AS (PARTITION BY place, metric_id ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  z AS (SELECT place, metric_id, pidx, value, CASE WHEN n >= 24 AND sd <> 0 THEN greatest(-4.0, least(4.0, (value - mu) / sd)) END AS z FROM p), {_PHI},
  ix AS (SELECT d.*, CASE WHEN direction < 0 THEN 100 - pct ELSE pct END AS idx FROM d JOIN dir USING (metric_id)),
  ent AS (SELECT *, lag(idx) OVER w AS prev FROM ix WINDOW w AS (PARTITION BY place, metric_id ORDER BY pidx) QUALIFY row_number() OVER (PARTITION BY place, metric_id ORDER BY pidx DESC) = 1)"""
)


@query(
    "q7_a14_desk_entries",
    DESK
    + f""" SELECT place, metric_id, pidx, {R('value')} AS value, {R('z')} AS z, idx AS index, prev AS index_prev, CASE WHEN idx IS NULL THEN 'unknown' WHEN idx >= 60 THEN 'expansionary' WHEN idx <= 40 THEN 'contractionary' ELSE 'neutral' END AS read FROM ent""",
)
def desk_view(spark, sf_dir):
    return desk_entries(spark, sf_dir).select("place", "metric_id", "pidx", r("value"), r("z"), "index", "index_prev", "read")


@query(
    "a22_q7_composite",
    DESK + " SELECT place, round(avg(idx) + 1e-9, 0) AS composite, count(idx) AS composite_n FROM ent WHERE metric_id NOT IN ('revenue') GROUP BY place",
)
def composite(spark, sf_dir):
    signals = desk_entries(spark, sf_dir).where(F.col("metric_id") != "revenue")
    return desk.composite(signals)


@query(
    "q8_national_cities",
    DESK
    + """, c AS (SELECT place, round(avg(idx) + 1e-9, 0) AS composite, count(idx) AS composite_n FROM ent GROUP BY place),
    k AS (SELECT place, metric_id, row_number() OVER (PARTITION BY place ORDER BY abs(idx - 50) DESC, metric_id) AS position FROM ent WHERE idx IS NOT NULL)
    SELECT c.place, composite, composite_n, string_agg(metric_id, ',' ORDER BY position) AS top FROM c LEFT JOIN k ON k.place = c.place AND position <= 2 GROUP BY ALL""",
)
def national_cities(spark, sf_dir):
    out = D.national_cities(desk_entries(spark, sf_dir))
    return out.select("place", "composite", "composite_n", F.array_join(F.transform("top", lambda x: x["metric_id"]), ",").alias("top"))


@query(
    "q8_world_tape",
    obs_sql("world_revenue", "discount_rate")
    + f""", p AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd, lag(value, 3) OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS b3 FROM obs
      WINDOW w AS (PARTITION BY metric_id, geo_id ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT metric_id, geo_id, pidx, value, greatest(-4.0, least(4.0, (value - mu) / sd)) AS z, -((value - b3) * 100 / b3) AS stress FROM p QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx DESC) = 1)
    SELECT metric_id, geo_id, pidx, {R('value')} AS value, {R('z')} AS z, {R('stress')} AS stress, CASE WHEN stress > 4 THEN 'contractionary' WHEN stress > -4 THEN 'neutral' ELSE 'expansionary' END AS read FROM l""",
)
def world_tape(spark, sf_dir):
    from tidemark.operators import series as S

    obs = M.series(spark, sf_dir, ["world_revenue", "discount_rate"])
    scored = S.zscored(obs, ("metric_id", "geo_id"), "value", 24)
    out = S.latest(S.carry_stress(scored).select("metric_id", "geo_id", "pidx", "value", "z", "stress", "read"))
    return out.select("metric_id", "geo_id", "pidx", r("value"), r("z"), r("stress"), "read")


# --- Forecast pages ---------------------------------------------------------------------
@query(
    "q9_forecast_round",
    FQ.ALL
    + FQ.FOLDS
    + FQ.SCORES
    + FQ.ISSUED
    + f" SELECT target_id, count(*) AS issued, count(*) FILTER (WHERE model_verdict = 'beats_baseline') AS skilled, {R('avg(p_up)')} AS mean_p_up, sum(folds)::BIGINT AS folds FROM iss GROUP BY target_id",
)
def forecast_round(spark, sf_dir):
    out = FQ.issued(spark, sf_dir).groupBy("target_id").agg(
        F.count(F.lit(1)).alias("issued"),
        F.count_if(F.col("model_verdict") == "beats_baseline").alias("skilled"),
        F.avg("p_up").alias("mean_p_up"),
        F.sum("folds").alias("folds"),
    )
    return out.select("target_id", "issued", "skilled", r("mean_p_up"), "folds")


_ROUND = (FQ.ALL + FQ.FOLDS + FQ.SCORES + FQ.ISSUED)[len(obs_sql(*FQ.METRICS)) :].replace(
    "AS n FROM obs)", "AS n FROM obs WHERE metric_id IN ('orders_count', 'revenue', 'orders_quarter'))"
)


@query(
    "q10_brief",
    SQ.ZSQL
    + _ROUND
    + f""", nw AS (SELECT place, metric_id, transform, max(month) AS month, arg_max(oriented, month) AS oriented FROM pz GROUP BY ALL),
    g AS (SELECT place, index_id, CASE WHEN count(*) >= max(min_components) THEN sum(oriented * weight) / sum(weight) END AS value FROM nw JOIN comp USING (metric_id, transform) GROUP BY ALL),
    sg AS (SELECT {DIST} AS geo_id, m, rev::DOUBLE / n::DOUBLE AS ticket FROM dm)
    SELECT 'forecast' AS part, geo_id AS subject, target_id AS item, {R('p50', 3)} AS value, CASE WHEN model_verdict = 'beats_baseline' THEN 'skilled' ELSE 'baseline' END AS note FROM iss
    UNION ALL SELECT 'index', place, index_id, {R('value', 3)}, CASE WHEN value IS NULL THEN 'insufficient' WHEN value > 0.5 THEN 'high' WHEN value < -0.5 THEN 'low' ELSE 'normal' END FROM g
    UNION ALL SELECT 'district', geo_id, 'ticket', {R('arg_max(ticket, m)', 3)}, 'table' FROM sg GROUP BY geo_id""",
)
def brief(spark, sf_dir):
    current = indices.current_index(SQ.placed_scores(spark, sf_dir), SQ.components(spark))
    table = D.wide_latest(M.series(spark, sf_dir, ["segment_ticket", "segment_orders"]), {"segment_ticket": "ticket", "segment_orders": "orders"}, "ticket")
    return D.brief(FQ.issued(spark, sf_dir), current, table).select("part", "subject", "item", r("value", 3), "note")


@query(
    "q11_district_report",
    obs_sql("segment_ticket", "segment_orders")
    + f""", l AS (SELECT geo_id, arg_max(value, pidx) FILTER (WHERE metric_id = 'segment_ticket') AS ticket, arg_max(value, pidx) FILTER (WHERE metric_id = 'segment_orders') AS orders FROM obs GROUP BY geo_id)
    SELECT geo_id, {R('ticket')} AS ticket, {R('orders')} AS orders, row_number() OVER (PARTITION BY split_part(geo_id, '-', 2) ORDER BY ticket DESC, geo_id) AS rank, count(*) OVER (PARTITION BY split_part(geo_id, '-', 2)) AS of FROM l""",
)
def district_report(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["segment_ticket", "segment_orders"])
    table = D.wide_latest(obs, {"segment_ticket": "ticket", "segment_orders": "orders"}, "ticket").withColumn("parent", F.split_part("geo_id", F.lit("-"), F.lit(2)))
    out = D.district_report(table, "parent", "ticket", "geo_id")
    return out.select("geo_id", r("ticket"), r("orders"), F.col("rank").cast("bigint").alias("rank"), "of")


@query(
    "q12_source_health",
    """WITH rn AS (SELECT o_orderpriority AS source_id, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS run, CASE WHEN count(*) % 3 = 0 THEN 'failed' ELSE 'ok' END AS status, max(o_orderdate)::DATE AS obs FROM orders GROUP BY ALL),
    b AS (SELECT source_id, max(run) FILTER (WHERE status = 'ok') AS last_success, arg_max(status, run) AS status, max(obs) FILTER (WHERE status = 'ok') AS latest, count(*) FILTER (WHERE status = 'ok') AS succeeded, count(*) FILTER (WHERE status <> 'ok') AS failed FROM rn GROUP BY source_id),
    f AS (SELECT source_id, count(*) FILTER (WHERE rn.status <> 'ok' AND run > coalesce(last_success, -1)) AS consecutive_failures FROM rn JOIN b USING (source_id) GROUP BY source_id)
    SELECT source_id, status, last_success, latest::VARCHAR AS latest_observation, succeeded, failed, consecutive_failures, (DATE '2001-08-20' - latest)::INTEGER AS staleness_days, (DATE '2001-08-20' - latest <= 25)::INTEGER AS fresh,
      (status = 'failed' OR DATE '2001-08-20' - latest > 25)::INTEGER AS needs_attention FROM b JOIN f USING (source_id)""",
)
def source_health(spark, sf_dir):
    out = order_sources(spark, sf_dir)
    return out.select(
        "source_id", "status", "last_success", F.col("latest_observation").cast("string").alias("latest_observation"), "succeeded", "failed",
        "consecutive_failures", "staleness_days", F.col("fresh").cast("int").alias("fresh"), F.col("needs_attention").cast("int").alias("needs_attention"),
    )


def order_sources(spark, sf_dir):
    """Health of the sources of orders: each priority is one, each month a run."""
    o = M.table(spark, sf_dir, "orders")
    runs = o.groupBy(F.col("o_orderpriority").alias("source_id"), month_of("o_orderdate").alias("run")).agg(
        F.when(F.count(F.lit(1)) % 3 == 0, "failed").otherwise("ok").alias("status"), F.max("o_orderdate").cast("date").alias("latest_observation")
    )
    ages = o.select(F.col("o_orderpriority").alias("source_id")).distinct().withColumn("max_age_days", F.lit(25))
    return D.source_health(runs, ages, "2001-08-20")


@query(
    "q13_a29_manifest",
    obs_sql()
    + """, s AS (SELECT metric_id, geo_id, count(*) AS n FROM obs GROUP BY ALL)
    SELECT count(*) AS series, sum(n)::BIGINT AS observations, string_agg(DISTINCT metric_id, ',' ORDER BY metric_id) AS metrics, (SELECT count(*) FROM nation) AS places FROM s""",
)
def manifest(spark, sf_dir):
    return D.manifest(M.series(spark, sf_dir), M.places(spark, sf_dir)).select("series", "observations", "metrics", "places")


@query(
    "q14_census_month",
    f"""WITH {snapshot_sql('a', '1996-03-01')}, {snapshot_sql('b', '1996-04-01')}, {DIFF}, {FLOWS},
    st AS (SELECT district, count(*) FILTER (WHERE state = 'O') AS open, count(*) FILTER (WHERE state = 'F') AS closed, count(*) FILTER (WHERE state = 'O' AND kind LIKE '1%') AS marked_open FROM b GROUP BY district),
    fl AS (SELECT district, sum(o)::BIGINT AS openings, sum(c)::BIGINT AS closures, sum(mo)::BIGINT AS marked_openings, sum(mc)::BIGINT AS marked_closures FROM f GROUP BY district),
    p AS (SELECT 'mun-' || printf('%05d', n_nationkey + 1) AS district FROM nation)
    SELECT district, coalesce(open, 0) AS open, coalesce(closed, 0) AS closed, coalesce(marked_open, 0) AS marked_open, {R('coalesce(100.0::DOUBLE * coalesce(closed, 0) / nullif(coalesce(open, 0) + coalesce(closed, 0), 0), 0)')} AS vacancy_rate,
      coalesce(openings, 0) AS openings, coalesce(closures, 0) AS closures, coalesce(marked_openings, 0) AS marked_openings, coalesce(marked_closures, 0) AS marked_closures FROM p LEFT JOIN st USING (district) LEFT JOIN fl USING (district)""",
)
def census_month(spark, sf_dir):
    places_ = M.table(spark, sf_dir, "nation").select(M.mun("n_nationkey").alias("district"))
    out = D.census_month(
        *customer_snapshots(spark, sf_dir, ["1996-03-01", "1996-04-01"]), places_, COLUMNS, "O", "F", lambda k: k.startswith("1")
    )
    flows = ("openings", "closures", "marked_openings", "marked_closures")
    return out.select("district", "open", "closed", "marked_open", r("vacancy_rate"), *flows)


# --- Flagship ----------------------------------------------------------------------------
@query(
    "flagship_which_place_moved_most",
    obs_sql("revenue")
    + f""", y AS (SELECT o.geo_id, o.pidx, o.value, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM obs o JOIN obs p ON o.geo_id = p.geo_id AND p.pidx = o.pidx - 12 WHERE p.value <> 0 AND o.pidx < 2001 * 12 + 7),
    l AS (SELECT geo_id, max(pidx) AS pidx, arg_max(value, pidx) AS value, arg_max(yoy, pidx) AS yoy FROM y GROUP BY geo_id)
    SELECT geo_id, {PERIOD_M} AS period, {R('value', 2)} AS value, {R('yoy')} AS yoy FROM l ORDER BY abs(yoy) DESC, geo_id LIMIT 24""",
)
def which_place_moved_most(spark, sf_dir):
    """Revenue by place, closed months only, yoy at the newest month, top 24."""
    from tidemark.operators import series as S
    from tidemark.operators.validate import closed_only

    obs = closed_only(M.with_period(M.series(spark, sf_dir, ["revenue"])), "2001-08-15")
    newest = S.latest(S.yoy(obs).select("metric_id", "geo_id", "pidx", "value", "yoy"))
    top = newest.orderBy(F.abs("yoy").desc(), "geo_id").limit(24)
    return top.select("geo_id", month_text("pidx").alias("period"), r("value", 2), r("yoy"))


def _documents_sql() -> str:
    """Entries of all documents, from the SQL of the views that they show."""
    number = lambda x: f"{x}::DOUBLE"
    recent = f"(SELECT *, row_number() OVER (PARTITION BY place ORDER BY month DESC) AS back FROM ({ORACLE['x5_hysteresis_stream']}))"
    health = f"({ORACLE['q12_source_health']})"
    parts = [
        ("'place'", "place", "cards", "metric_id || ' ' || geo_id", "pidx", "value", "fresh", f"({ORACLE['q1_metric_cards']})"),
        ("'place'", "place", "timeline", "place", "month", number("held"), "rule_id", f"{recent} WHERE back <= 36"),
        ("'overview'", "'overview'", "timeline", "place", "month", number("held"), "rule_id", f"{recent} WHERE back <= 36"),
        ("'overview'", "'overview'", "movers", "place || ' ' || metric_id || ' ' || geo_id", "pidx", "yoy", "NULL", f"({ORACLE['q5_overview_movers']})"),
        ("'overview'", "'overview'", "headline", "metric_id || ' ' || geo_id", "0", "NULL", "sentence", f"({ORACLE['q5_o2_headline']})"),
        ("'overview'", "'overview'", "attention", "source_id", "0", number("staleness_days"), "status", f"{health} WHERE needs_attention = 1"),
        ("'sources'", "'sources'", "health", "source_id", "last_success", number("staleness_days"), "status", health),
        ("'national'", "'national'", "places", "place", "composite_n", "composite", "top", f"({ORACLE['q8_national_cities']})"),
        ("'signals'", "'signals'", "pairs", "signal || ' ' || outcome", '"leading"', "median_lag", "NULL", f"({ORACLE['a23_o10_q6_signals_page']})"),
        ("'manifest'", "'manifest'", "counts", "metrics", "places", number("observations"), "NULL", f"({ORACLE['q13_a29_manifest']})"),
    ]
    return " UNION ALL ".join(
        f"SELECT {kind} AS kind, {name} AS name, '{part}' AS part, {item} AS item, ({at})::INTEGER AS at, ({value})::DOUBLE AS value, ({note})::VARCHAR AS note FROM {source}"
        for kind, name, part, item, at, value, note, source in parts
    )


@query("s14_q5_documents", _documents_sql())
def published_documents(spark, sf_dir):
    """Documents of every kind, written and read back."""
    path = scratch_path(spark, "published")
    found = cut_lineage(cards(spark, sf_dir))  # places, movers and headline read it
    documents = D.documents(
        found, cut_lineage(SQ.timeline(spark, sf_dir)), cut_lineage(order_sources(spark, sf_dir)), D.national_cities(desk_entries(spark, sf_dir)),
        SQ.lead_lag(spark, sf_dir), D.manifest(M.series(spark, sf_dir), M.places(spark, sf_dir)),
    )
    sinks.write_documents(documents, path, by="kind")
    back = spark.read.schema(D.DOCUMENT).json(path)
    flat = back.select("kind", "name", F.inline("parts")).select("kind", "name", "part", F.inline("entries"))
    # the headline's change is in its sentence
    value = F.when(F.col("part") != "headline", F.col("value"))
    return flat.select("kind", "name", "part", "item", "at", r(value).alias("value"), "note")
