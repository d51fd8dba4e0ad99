"""Indices, regimes, signatures and lead-lag evidence (R, L, W6, W9, A16-A18, A23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import indices, leadlag, places, regimes
from tidemark.plans import model as M
from tidemark.plans.catalog.base import BRIDGE, R, obs_sql, query, r, values_sql
from tidemark.session import cut_lineage, literal_table
from tidemark.sources.dims import COMPONENT_SCHEMA

INPUTS = [
    "orders_count", "revenue", "avg_ticket", "open_share", "urgent_share", "orders_quarter", "buyers_annual",
    "qty_shipped", "return_rate", "discount_rate",
]
_DIRECTION = {m[0]: m[7] for m in M.METRICS}
SCORED = sorted(
    {(m, t, _DIRECTION[m]) for _, m, t, *_ in M.COMPONENTS} | {(m, t, _DIRECTION[m]) for _, m, t, _ in M.SIGNALS if m in _DIRECTION}
)
TRANSFORMS = ["level", "yoy", "change_12"]

ZSQL = (
    obs_sql(*INPUTS)
    + f""", {values_sql('pairs', 'metric_id, transform, direction', SCORED)},
  stock AS (SELECT geo_id, unnest(range(pidx * 12, pidx * 12 + 12)) AS month, value FROM obs WHERE metric_id = 'buyers_annual'),
  per AS (SELECT n.metric_id, n.geo_id, n.geo_level, n.cadence, n.pidx, n.value, arg_max(d.value, d.month) AS base FROM obs n JOIN stock d
    ON n.geo_id = d.geo_id AND d.month BETWEEN n.pidx - 12 AND n.pidx WHERE n.metric_id = 'orders_count' GROUP BY ALL),
  xf AS (
    SELECT metric_id, geo_id, geo_level, cadence, pidx, 'level' AS transform, value AS raw FROM obs
    UNION ALL SELECT o.metric_id, o.geo_id, o.geo_level, o.cadence, o.pidx, 'yoy', 100.0::DOUBLE * (o.value - p.value) / abs(p.value) FROM obs o JOIN obs p ON o.metric_id = p.metric_id AND o.geo_id = p.geo_id
      AND p.pidx = o.pidx - CASE o.cadence WHEN 'monthly' THEN 12 WHEN 'quarterly' THEN 4 ELSE 1 END WHERE p.value <> 0
    UNION ALL SELECT o.metric_id, o.geo_id, o.geo_level, o.cadence, o.pidx, 'change_12', o.value - p.value FROM obs o JOIN obs p ON o.metric_id = p.metric_id AND o.geo_id = p.geo_id AND p.pidx = o.pidx - 12
    UNION ALL SELECT metric_id, geo_id, geo_level, cadence, pidx, 'per_1000_dwellings', 1000.0::DOUBLE * value / base FROM per WHERE base <> 0),
  st AS (SELECT xf.*, pairs.direction, count(raw) OVER p AS n, avg(raw) OVER p AS mu, stddev_pop(raw) OVER p AS sd FROM xf JOIN pairs USING (metric_id, transform)
    WINDOW p AS (PARTITION BY metric_id, geo_id, transform ORDER BY pidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  zz AS (SELECT metric_id, geo_id, geo_level, transform, cadence, pidx, raw, greatest(-4.0::DOUBLE, least(4.0::DOUBLE, (raw - mu) / sd)) AS z, direction FROM st
    WHERE n >= CASE cadence WHEN 'monthly' THEN 24 WHEN 'quarterly' THEN 12 ELSE 8 END AND sd <> 0),
  zm AS (SELECT metric_id, geo_id, geo_level, transform, raw, z, z * direction AS oriented,
    unnest(CASE cadence WHEN 'quarterly' THEN range(pidx * 3, pidx * 3 + 3) ELSE range(pidx, pidx + 1) END)::INTEGER AS month FROM zz),
  {BRIDGE}, pz AS (SELECT b.place, zm.* FROM zm JOIN bridge b USING (geo_level, geo_id)),
  {values_sql('comp', 'index_id, metric_id, transform, weight, min_components', M.COMPONENTS)},
  ih AS (SELECT place, index_id, month, sum(oriented * weight) / sum(weight) AS value, count(*) AS n FROM pz JOIN comp USING (metric_id, transform)
    GROUP BY ALL HAVING count(*) >= max(min_components))"""
)
WIDE = """, wd AS (SELECT place, month, max(value) FILTER (WHERE index_id = 'demand_momentum') AS demand_momentum, max(value) FILTER (WHERE index_id = 'housing_pressure') AS housing_pressure,
    max(value) FILTER (WHERE index_id = 'supply_response') AS supply_response, max(value) FILTER (WHERE index_id = 'distress') AS distress FROM ih GROUP BY ALL),
  dl AS (SELECT a.*, a.housing_pressure - b.housing_pressure AS delta_housing_pressure_2 FROM wd a LEFT JOIN wd b ON a.place = b.place AND b.month = a.month - 2
    WHERE (a.demand_momentum IS NOT NULL)::INT + (a.housing_pressure IS NOT NULL)::INT + (a.supply_response IS NOT NULL)::INT + (a.distress IS NOT NULL)::INT >= 2)"""


def rules_sql(rules) -> str:
    """The rule set as a CASE expression; NULL conditions fall through."""
    branches = "".join(f" WHEN {' AND '.join(p)} THEN '{rid}'" for rid, _, p in rules if p)
    return f"CASE{branches} ELSE '{rules[-1][0]}' END"


VERDICT = f", vd AS (SELECT *, {rules_sql(regimes.REGIMES_V3)} AS verdict FROM dl)"
HELD = """, vn AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY month) AS rn FROM vd),
  h AS (SELECT place, rn, verdict AS rule_id, 0 AS streak, FALSE AS held FROM vn WHERE rn = 1
    UNION ALL SELECT vn.place, vn.rn, CASE WHEN h.rule_id IN ('stress', 'dislocation') AND vn.verdict <> h.rule_id AND h.streak + 1 < 2 THEN h.rule_id ELSE vn.verdict END,
      CASE WHEN h.rule_id IN ('stress', 'dislocation') AND vn.verdict <> h.rule_id AND h.streak + 1 < 2 THEN h.streak + 1 ELSE 0 END,
      h.rule_id IN ('stress', 'dislocation') AND vn.verdict <> h.rule_id AND h.streak + 1 < 2 FROM h JOIN vn ON vn.place = h.place AND vn.rn = h.rn + 1),
  tl AS (SELECT vn.place, vn.month, vn.demand_momentum, vn.housing_pressure, vn.supply_response, vn.distress, vn.verdict, h.rule_id, h.held FROM h JOIN vn USING (place, rn))"""


def recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql[len("WITH") :]


# --- Shared plans ----------------------------------------------------------------------
def components(spark):
    return literal_table(spark, COMPONENT_SCHEMA, M.COMPONENTS)


def scores(spark, sf_dir):
    """Monthly oriented z-scores, once per series."""
    # The observations are read several times below; the facts only once.
    obs = cut_lineage(M.series(spark, sf_dir, INPUTS))
    pairs = literal_table(spark, "metric_id string, transform string, direction int", SCORED)
    stock = obs.where(F.col("metric_id") == "buyers_annual")
    return indices.oriented(obs, pairs, TRANSFORMS, ("monthly", "quarterly", "annual"), stock, ["orders_count"])


def placed_scores(spark, sf_dir):
    return places.resolve(scores(spark, sf_dir), places.bridge(M.places(spark, sf_dir)))


def index_history(spark, sf_dir):
    return indices.index_history(placed_scores(spark, sf_dir), components(spark))


def timeline(spark, sf_dir):
    return regimes.hold(regimes.verdicts(index_history(spark, sf_dir)))


# --- Queries -----------------------------------------------------------------------------
@query("l4_oriented_scores", ZSQL + f" SELECT metric_id, geo_id, transform, month, {R('raw', 3)} AS raw, {R('oriented')} AS oriented FROM zm")
def oriented_scores(spark, sf_dir):
    return scores(spark, sf_dir).select("metric_id", "geo_id", "transform", "month", r("raw", 3), r("oriented"))


@query(
    "a16_current_index",
    ZSQL
    + f""", nw AS (SELECT place, metric_id, transform, max(month) AS month, arg_max(oriented, month) AS oriented FROM pz GROUP BY ALL),
    g AS (SELECT place, index_id, sum(oriented * weight) / sum(weight) AS value, count(*) AS n, max(min_components) AS need, max(month) AS month, min(month) AS oldest FROM nw JOIN comp USING (metric_id, transform) GROUP BY ALL)
    SELECT place, index_id, {R('CASE WHEN n >= need THEN value END')} AS value, CASE WHEN n >= need THEN month END::DOUBLE AS month, n, (n < need)::INTEGER AS insufficient, oldest AS oldest_component FROM g""",
)
def current_index(spark, sf_dir):
    out = indices.current_index(placed_scores(spark, sf_dir), components(spark))
    return out.select(
        "place", "index_id", r("value"), F.col("month").cast("double").alias("month"), "n", F.col("insufficient").cast("int").alias("insufficient"), "oldest_component"
    )


@query("a17_index_history", ZSQL + f" SELECT place, index_id, month, {R('value')} AS value, n FROM ih")
def index_histories(spark, sf_dir):
    return index_history(spark, sf_dir).select("place", "index_id", "month", r("value"), "n")


@query(
    "w6_r2_index_deltas",
    ZSQL
    + f""" SELECT a.place, a.index_id, a.month, k AS step, {R('a.value - b.value')} AS delta FROM ih a CROSS JOIN (VALUES (1), (2), (3), (4), (12)) AS s(k)
    JOIN ih b ON a.place = b.place AND a.index_id = b.index_id AND b.month = a.month - k""",
)
def index_deltas(spark, sf_dir):
    wide = regimes.with_deltas(regimes.wide_indices(index_history(spark, sf_dir)))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("index_id"), F.lit(n).alias("step"), F.col(f"delta_{i}_{n}").alias("delta"))
            for i in regimes.INDEX_IDS
            for n in regimes.DELTA_STEPS
        ]
    )
    long = wide.select("place", "month", F.inline(rows)).where(F.col("delta").isNotNull())
    return long.select("place", "index_id", "month", "step", r("delta"))


_ALL_RULES = ", ".join(f"{rules_sql(rules)} AS {name.replace('-', '_')}" for name, rules in regimes.RULESETS.items())


@query("r1_r3_r4_classify", ZSQL + WIDE + f" SELECT place, month, {_ALL_RULES} FROM dl")
def classify(spark, sf_dir):
    wide = regimes.with_deltas(regimes.wide_indices(index_history(spark, sf_dir))).where(regimes.present() >= 2)
    return wide.select("place", "month", *[regimes.classify(rules).alias(name.replace("-", "_")) for name, rules in regimes.RULESETS.items()])


@query(
    "r3_rule_predicates",
    ZSQL
    + WIDE
    + """ SELECT place, month, (NOT coalesce(distress > 0.5, FALSE))::INTEGER AS not_distressed, (supply_response IS NOT NULL)::INTEGER AS has_supply,
      coalesce(abs(housing_pressure) > 0.75, FALSE)::INTEGER AS unusual, coalesce(-0.5 < demand_momentum AND demand_momentum < 0.5, FALSE)::INTEGER AS usual FROM dl""",
)
def rule_predicates(spark, sf_dir):
    wide = regimes.wide_indices(index_history(spark, sf_dir)).where(regimes.present() >= 2)
    checks = {
        "not_distressed": [("not", "distress > 0.5")],
        "has_supply": ["supply_response IS NOT NULL"],
        "unusual": ["abs(housing_pressure) > 0.75"],
        "usual": ["-0.5 < demand_momentum", "demand_momentum < 0.5"],
    }
    return wide.select("place", "month", *[regimes.rule_condition(c).cast("int").alias(n) for n, c in checks.items()])


@query(
    "r5_regime_now",
    ZSQL
    + f""", nw AS (SELECT place, metric_id, transform, max(month) AS month, arg_max(oriented, month) AS oriented FROM pz GROUP BY ALL),
    g AS (SELECT place, index_id, CASE WHEN count(*) >= max(min_components) THEN sum(oriented * weight) / sum(weight) END AS value, CASE WHEN count(*) >= max(min_components) THEN max(month) END AS month FROM nw JOIN comp USING (metric_id, transform) GROUP BY ALL),
    w AS (SELECT place, max(month) AS month, count(value) AS available, max(value) FILTER (WHERE index_id = 'demand_momentum') AS demand_momentum, max(value) FILTER (WHERE index_id = 'housing_pressure') AS housing_pressure,
      max(value) FILTER (WHERE index_id = 'supply_response') AS supply_response, max(value) FILTER (WHERE index_id = 'distress') AS distress FROM g GROUP BY place),
    lm_ AS (SELECT place, max(month) AS month FROM ih WHERE index_id = 'housing_pressure' GROUP BY place),
    dlt AS (SELECT a.place, a.value - b.value AS delta_housing_pressure_2 FROM lm_ JOIN ih a ON a.place = lm_.place AND a.month = lm_.month AND a.index_id = 'housing_pressure' LEFT JOIN ih b ON b.place = a.place AND b.index_id = a.index_id AND b.month = a.month - 2)
    SELECT place, month, available, (available >= 3)::INTEGER AS confident, {rules_sql(regimes.REGIMES_V3)} AS rule_id FROM w LEFT JOIN dlt USING (place)""",
)
def regime_now(spark, sf_dir):
    placed = cut_lineage(placed_scores(spark, sf_dir))
    comp = components(spark)
    out = regimes.summary(indices.current_index(placed, comp), indices.index_history(placed, comp))
    return out.select("place", "month", "available", F.col("confident").cast("int").alias("confident"), "rule_id")


@query("w9_q4_regime_timeline", recursive(ZSQL + WIDE + VERDICT + HELD) + f" SELECT place, month, verdict, rule_id, held::INTEGER AS held, {R('distress')} AS distress FROM tl")
def regime_timeline(spark, sf_dir):
    out = timeline(spark, sf_dir)
    return out.select("place", "month", "verdict", "rule_id", F.col("held_by_hysteresis").cast("int").alias("held"), r("distress"))


_FIRES = "((s.expect = 'up' AND z >= 0.5) OR (s.expect = 'down' AND z <= -0.5))"


@query(
    "a18_o4_signature_match",
    ZSQL
    + f""", {values_sql('s', 'archetype_id, metric_id, transform, expect', M.SIGNALS)}, nw AS (SELECT place, metric_id, transform, arg_max(z, month) AS z FROM pz GROUP BY ALL),
    m AS (SELECT lower(n_name) AS place, s.archetype_id, count(*) AS total, count(z) AS available, count(*) FILTER (WHERE {_FIRES}) AS firing FROM nation CROSS JOIN s
      LEFT JOIN nw ON nw.place = lower(n_name) AND nw.metric_id = s.metric_id AND nw.transform = s.transform GROUP BY ALL)
    SELECT place, archetype_id, total, available, firing, {R('available::DOUBLE / total')} AS coverage, {R('firing::DOUBLE / nullif(available, 0)')} AS score, (available::DOUBLE / total < 0.34)::INTEGER AS insufficient,
      row_number() OVER (PARTITION BY place ORDER BY firing::DOUBLE / nullif(available, 0) DESC NULLS LAST, available::DOUBLE / total DESC, archetype_id) AS position FROM m""",
)
def signature_match(spark, sf_dir):
    found = indices.match_signatures(placed_scores(spark, sf_dir), M.SIGNALS, M.places(spark, sf_dir))
    out = indices.ranked_signatures(found)
    return out.select(
        "place", "archetype_id", "total", "available", "firing", r("coverage"), r("score"), F.col("insufficient").cast("int").alias("insufficient"),
        F.col("position").cast("bigint").alias("position"),
    )


LEAD_INPUTS = ["orders_count", "revenue", "open_share", "qty_shipped", "avg_ticket", "return_rate", "urgent_share", "world_revenue", "orders_quarter"]


def lead_lag(spark, sf_dir):
    placed = cut_lineage(places.resolve(M.series(spark, sf_dir, LEAD_INPUTS), places.bridge(M.places(spark, sf_dir))))
    pairs = literal_table(spark, "signal string, outcome string", M.PAIRS)
    return leadlag.evaluate(placed, pairs, ("monthly", "quarterly"))


LEAD = (
    obs_sql(*LEAD_INPUTS)
    + f""", {BRIDGE}, pl AS (SELECT b.place, o.metric_id, o.cadence, o.pidx, o.value, CASE o.cadence WHEN 'monthly' THEN 12 ELSE 4 END AS year FROM obs o JOIN bridge b USING (geo_level, geo_id)),
  y AS (SELECT o.place, o.metric_id, o.cadence, o.pidx, o.year, p.value AS prior, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM pl o JOIN pl p ON o.place = p.place AND o.metric_id = p.metric_id AND p.pidx = o.pidx - o.year WHERE p.value <> 0),
  {values_sql('pairs', 'signal, outcome', M.PAIRS)},
  sides AS (SELECT place, signal, outcome, cadence, count(yoy) FILTER (WHERE y.metric_id = signal) AS n_signal, count(yoy) FILTER (WHERE y.metric_id = outcome) AS n_outcome FROM y JOIN pairs ON y.metric_id IN (signal, outcome) GROUP BY ALL),
  oc AS (SELECT y.*, signal, outcome, row_number() OVER (PARTITION BY place, signal, outcome, cadence ORDER BY pidx DESC) <= 12 AS held FROM y JOIN pairs ON y.metric_id = outcome),
  pr AS (SELECT oc.place, oc.signal, oc.outcome, oc.cadence, (oc.pidx - s.pidx)::INTEGER AS lag, oc.held, s.yoy AS x, oc.yoy AS y FROM oc JOIN y s ON s.place = oc.place AND s.metric_id = oc.signal AND s.cadence = oc.cadence AND oc.pidx - s.pidx BETWEEN 0 AND 12),
  lg AS (SELECT place, signal, outcome, cadence, lag,
      CASE WHEN count(*) FILTER (WHERE NOT held) >= 3 THEN round(corr(x, y) FILTER (WHERE NOT held), 4) END AS train_r, CASE WHEN count(*) FILTER (WHERE held) >= 3 THEN round(corr(x, y) FILTER (WHERE held), 4) END AS test_r, count(*) FILTER (WHERE held) AS n_test
    FROM pr GROUP BY ALL),
  us AS (SELECT *, n_signal >= 30 AND n_outcome >= 30 AND n_outcome > 12 AS usable FROM sides),
  bs AS (SELECT place, signal, outcome, cadence, lag AS best_lag, train_r, test_r, n_test FROM lg JOIN us USING (place, signal, outcome, cadence) WHERE usable AND abs(train_r) > 0
    QUALIFY row_number() OVER (PARTITION BY place, signal, outcome, cadence ORDER BY abs(train_r) DESC, lag) = 1),
  bl AS (SELECT oc.place, oc.signal, oc.outcome, oc.cadence, CASE WHEN count(*) >= 3 THEN round(corr(p.yoy, oc.yoy), 4) END AS baseline_r FROM oc JOIN y p ON p.place = oc.place AND p.metric_id = oc.outcome AND p.pidx = oc.pidx - oc.year AND oc.prior <> 0 WHERE oc.held GROUP BY ALL),
  ev AS (SELECT us.place, us.signal, us.outcome, us.cadence, best_lag, train_r AS in_sample_r, test_r AS holdout_r, CASE WHEN best_lag IS NOT NULL THEN baseline_r END AS baseline_r, coalesce(n_test, 0) AS observations
    FROM (SELECT pp.place, pairs.signal, pairs.outcome, us.cadence FROM (SELECT DISTINCT place FROM pl) AS pp CROSS JOIN pairs LEFT JOIN (SELECT * FROM us WHERE n_outcome > 0) AS us
      ON us.place = pp.place AND us.signal = pairs.signal AND us.outcome = pairs.outcome) AS us LEFT JOIN bs USING (place, signal, outcome, cadence) LEFT JOIN bl USING (place, signal, outcome, cadence)),
  le AS (SELECT *, CASE WHEN holdout_r IS NULL OR observations < 6 THEN 'insufficient_data' WHEN abs(holdout_r) < 0.3 THEN 'no_evidence' WHEN baseline_r IS NOT NULL AND abs(holdout_r) <= abs(baseline_r) THEN 'no_evidence'
    WHEN best_lag > 0 THEN 'leading' ELSE 'coincident' END AS verdict FROM ev)"""
)


@query(
    "l1_l2_l3_lead_lag",
    LEAD
    + f" SELECT place, signal, outcome, cadence, best_lag::DOUBLE AS best_lag, {R('in_sample_r')} AS in_sample_r, {R('holdout_r')} AS holdout_r, {R('baseline_r')} AS baseline_r, observations, verdict FROM le",
)
def lead_lag_results(spark, sf_dir):
    out = lead_lag(spark, sf_dir)
    return out.select(
        "place", "signal", "outcome", "cadence", F.col("best_lag").cast("double").alias("best_lag"), r("in_sample_r"), r("holdout_r"), r("baseline_r"), "observations", "verdict"
    )


SUMMARY = """ sm AS (SELECT signal, outcome, count(*) FILTER (WHERE verdict <> 'insufficient_data') AS tested, count(*) FILTER (WHERE verdict = 'leading') AS "leading",
    list_sort(list(best_lag) FILTER (WHERE verdict = 'leading'))[(count(*) FILTER (WHERE verdict = 'leading') // 2 + 1)::INTEGER]::DOUBLE AS median_lag FROM le GROUP BY ALL)
  SELECT *, CASE WHEN "leading" >= greatest(2, tested // 2) THEN 'leading' WHEN tested > 0 THEN 'no_evidence' ELSE 'insufficient_data' END AS verdict FROM sm"""


@query("a23_o10_q6_signals_page", LEAD + "," + SUMMARY)
def signals_page(spark, sf_dir):
    out = leadlag.pair_summary(lead_lag(spark, sf_dir)).withColumn("median_lag", F.col("median_lag").cast("double"))
    return out.orderBy(F.col("leading").desc(), "signal", "outcome")
