"""Vintages, forecasts, their evaluation and the transition probability (M, V, J11, J15, J16, A24-A26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import forecast as FC, transition, vintage
from tidemark.plans import model as M
from tidemark.plans.catalog.base import R, REV, obs_sql, query, r, values_sql
from tidemark.plans.catalog.signals import HELD, VERDICT, WIDE, ZSQL, recursive, timeline
from tidemark.session import literal_table

METRICS = ["orders_count", "revenue", "orders_quarter"]


@query(
    "v1_known_from",
    f"""WITH {REV} SELECT geo_id, pidx, revision, coalesce(published_at, observation_end + 60)::VARCHAR AS known_from, CASE WHEN published_at IS NULL THEN 'declared_lag' ELSE 'published_at' END AS basis,
      coalesce(published_at, CASE WHEN revision > 0 THEN greatest(DATE '2001-09-01', observation_end + 60) ELSE observation_end + 60 END)::VARCHAR AS restated_known_from FROM rlog""",
)
def known_from(spark, sf_dir):
    lags = literal_table(spark, "source_id string, days int", M.LAGS)
    plain = vintage.with_known_from(M.revision_log(spark, sf_dir), lags).withColumnRenamed("known_from", "known")
    both = vintage.with_known_from(plain.drop("basis"), lags, restated_after_fetch=True)
    return both.select(
        "geo_id", "pidx", "revision", F.col("known").cast("string").alias("known_from"), "basis", F.col("known_from").cast("string").alias("restated_known_from")
    )


SERIES = (
    obs_sql(*METRICS)
    + """, sr AS (SELECT *, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS n FROM obs),
  hz AS (SELECT * FROM (VALUES ('monthly', 3, 12), ('monthly', 6, 12), ('quarterly', 2, 4)) AS t(cadence, h, season)),
  sh AS (SELECT sr.*, hz.h, hz.season FROM sr JOIN hz USING (cadence)),"""
)

# Errors of the three rules, then their prefix quantiles, by plain self-joins.
BASE = (
    SERIES
    + """ er AS (
    SELECT a.metric_id, a.geo_id, a.h, a.season, a.n, a.pidx, a.value, 'seasonal_naive' AS model, a.value - b.value AS err FROM sh a JOIN sr b ON a.metric_id = b.metric_id AND a.geo_id = b.geo_id AND b.n = a.n - a.season WHERE a.n > a.season + a.h
    UNION ALL SELECT a.metric_id, a.geo_id, a.h, a.season, a.n, a.pidx, a.value, 'random_walk', a.value - b.value FROM sh a JOIN sr b ON a.metric_id = b.metric_id AND a.geo_id = b.geo_id AND b.n = a.n - a.h
    UNION ALL SELECT a.metric_id, a.geo_id, a.h, a.season, a.n, a.pidx, a.value, 'drift', a.value - (b.value + (b.value - c.value) / (a.season - 1)::DOUBLE * a.h) FROM sh a JOIN sr b ON a.metric_id = b.metric_id AND a.geo_id = b.geo_id AND b.n = a.n - 1
      JOIN sr c ON c.metric_id = a.metric_id AND c.geo_id = a.geo_id AND c.n = a.n - a.season WHERE a.n > a.season + a.h),
  pt AS (
    SELECT a.metric_id, a.geo_id, a.cadence, a.h, a.n, a.pidx, a.value, 'seasonal_naive' AS model, b.value AS point FROM sh a JOIN sr b ON a.metric_id = b.metric_id AND a.geo_id = b.geo_id AND b.n = a.n - (a.season - a.h) WHERE a.n >= a.season + a.h
    UNION ALL SELECT metric_id, geo_id, cadence, h, n, pidx, value, 'random_walk', value FROM sh WHERE n >= h + 2
    UNION ALL SELECT a.metric_id, a.geo_id, a.cadence, a.h, a.n, a.pidx, a.value, 'drift', a.value + (a.value - b.value) / (a.season - 1)::DOUBLE * a.h FROM sh a JOIN sr b ON a.metric_id = b.metric_id AND a.geo_id = b.geo_id AND b.n = a.n - (a.season - 1) WHERE a.n >= greatest(a.season, a.h) + 2),
  bp AS (SELECT pt.metric_id, pt.geo_id, pt.cadence, pt.h, pt.n, pt.pidx, pt.value, pt.model, pt.point + coalesce(quantile_cont(e.err, 0.1), 0) AS p10, pt.point + coalesce(quantile_cont(e.err, 0.5), 0) AS p50, pt.point + coalesce(quantile_cont(e.err, 0.9), 0) AS p90,
      avg(CASE WHEN e.err > 0 THEN 1.0 WHEN e.err IS NOT NULL THEN 0.0 END) AS p_up
    FROM pt LEFT JOIN er e ON e.metric_id = pt.metric_id AND e.geo_id = pt.geo_id AND e.h = pt.h AND e.model = pt.model AND e.n <= pt.n
    GROUP BY pt.metric_id, pt.geo_id, pt.cadence, pt.h, pt.n, pt.pidx, pt.value, pt.model, pt.point)"""
)
# The nearest-neighbour model, by an all-pairs join per series.
NEAR = """, vc AS (SELECT a.metric_id, a.geo_id, a.n, a.value, d.value AS v0, CASE WHEN d.value = 0 THEN 1.0 ELSE abs(d.value) END AS b, (c.value - d.value) / CASE WHEN d.value = 0 THEN 1.0 ELSE abs(d.value) END AS s1,
      (e.value - d.value) / CASE WHEN d.value = 0 THEN 1.0 ELSE abs(d.value) END AS s2, (a.value - d.value) / CASE WHEN d.value = 0 THEN 1.0 ELSE abs(d.value) END AS s3
    FROM sr a JOIN sr d ON d.metric_id = a.metric_id AND d.geo_id = a.geo_id AND d.n = a.n - 3 JOIN sr c ON c.metric_id = a.metric_id AND c.geo_id = a.geo_id AND c.n = a.n - 2
      JOIN sr e ON e.metric_id = a.metric_id AND e.geo_id = a.geo_id AND e.n = a.n - 1),
  cn AS (SELECT t.metric_id, t.geo_id, t.cadence, t.h, t.n, t.pidx, t.value, c.n AS cn, sqrt((c.s1 - tv.s1) * (c.s1 - tv.s1) + (c.s2 - tv.s2) * (c.s2 - tv.s2) + (c.s3 - tv.s3) * (c.s3 - tv.s3)) AS dist, (o.value - c.value) / abs(c.value) AS outcome
    FROM sh t JOIN vc tv ON tv.metric_id = t.metric_id AND tv.geo_id = t.geo_id AND tv.n = t.n JOIN vc c ON c.metric_id = t.metric_id AND c.geo_id = t.geo_id AND c.n >= 5 AND c.n <= t.n - t.h AND t.n - c.n > 12 AND c.value <> 0
      JOIN sr o ON o.metric_id = t.metric_id AND o.geo_id = t.geo_id AND o.n = c.n + t.h WHERE t.n >= t.h + 12 + 6),
  rk AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY metric_id, geo_id, h, n) AS total FROM cn WINDOW w AS (PARTITION BY metric_id, geo_id, h, n ORDER BY dist, cn)),
  ap AS (SELECT metric_id, geo_id, cadence, h, n, pidx, value, 'analog' AS model, value * (1 + quantile_cont(outcome, 0.1)) AS p10, value * (1 + quantile_cont(outcome, 0.5)) AS p50, value * (1 + quantile_cont(outcome, 0.9)) AS p90,
      avg(CASE WHEN outcome > 0 THEN 1.0 ELSE 0.0 END) AS p_up FROM rk WHERE k <= 12 AND total >= 4 GROUP BY metric_id, geo_id, cadence, h, n, pidx, value)"""
ALL = BASE + NEAR + ", pp AS (SELECT * FROM bp UNION ALL SELECT * FROM ap)"
FOLDS = """, fd AS (SELECT pp.metric_id, pp.geo_id, pp.cadence, pp.h, pp.model, pp.pidx AS from_pidx, t.pidx AS for_pidx, t.value AS actual, pp.value AS last_observed, p10, p50, p90, p_up,
    (greatest(0.1 * (t.value - p10), -0.9 * (t.value - p10)) + greatest(0.5 * (t.value - p50), -0.5 * (t.value - p50)) + greatest(0.9 * (t.value - p90), -0.1 * (t.value - p90))) / 3.0 AS pinball
    FROM pp JOIN sr t ON t.metric_id = pp.metric_id AND t.geo_id = pp.geo_id AND t.n = pp.n + pp.h + 1
    WHERE t.n - 1 - pp.h >= CASE pp.cadence WHEN 'monthly' THEN 48 ELSE 24 END AND pp.n >= CASE pp.cadence WHEN 'monthly' THEN 48 ELSE 24 END)"""
SCORES = """, ag AS (SELECT metric_id, geo_id, cadence, h, model, count(p50) AS folds, avg(abs(actual - p50)) AS mae, avg(pinball) AS pinball, avg(CASE WHEN actual BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END) AS coverage_80 FROM fd GROUP BY ALL HAVING count(p50) >= 8),
  bb AS (SELECT metric_id, geo_id, h, min(pinball) AS best, min(mae) AS best_mae FROM ag WHERE model <> 'analog' GROUP BY ALL),
  sc AS (SELECT ag.*, pinball / best AS pinball_ratio, mae / best_mae AS mae_ratio, CASE WHEN model <> 'analog' THEN 'baseline' WHEN pinball / best IS NULL THEN 'insufficient_data' WHEN pinball / best < 0.95 THEN 'beats_baseline' ELSE 'no_better_than_baseline' END AS verdict FROM ag LEFT JOIN bb USING (metric_id, geo_id, h)),
  ch AS (SELECT * FROM sc WHERE verdict IN ('beats_baseline', 'baseline') QUALIFY row_number() OVER (PARTITION BY metric_id, geo_id, h ORDER BY CASE verdict WHEN 'beats_baseline' THEN 0 ELSE 1 END, pinball, model) = 1)"""


def _series(spark, sf_dir, metrics=METRICS):
    return M.series(spark, sf_dir, metrics).select("metric_id", "geo_id", "cadence", "pidx", "value")


def predicted(spark, sf_dir):
    return FC.predictions(_series(spark, sf_dir), M.HORIZONS)


def walked(spark, sf_dir):
    return FC.walk_forward(predicted(spark, sf_dir), M.HORIZONS)


def _flat(predicted_rows, models):
    """All predictions made at every row, one per model and horizon."""
    rows = []
    for cadence, hs in M.HORIZONS.items():
        for h in hs:
            some = F.filter(F.col(f"m_{cadence}_{h}"), lambda m: m["model"].isin(*models) & m["p50"].isNotNull())
            rows.append(F.when(F.col("cadence") == cadence, F.struct(F.lit(h).alias("h"), some.alias("models"))))
    flat = predicted_rows.select("metric_id", "geo_id", "pidx", F.inline(F.array_compact(F.array(*rows))))
    return flat.select("metric_id", "geo_id", "pidx", "h", F.inline("models"))


_SHOWN = f"metric_id, geo_id, pidx, h, model, {R('p10', 3)} AS p10, {R('p50', 3)} AS p50, {R('p90', 3)} AS p90, {R('p_up')} AS p_up"


def _shown(df):
    return df.select("metric_id", "geo_id", "pidx", "h", "model", r("p10", 3), r("p50", 3), r("p90", 3), r("p_up"))


@query("m1_m2_m3_baselines", BASE + f" SELECT {_SHOWN} FROM bp")
def baselines(spark, sf_dir):
    rows = FC.with_baselines(_series(spark, sf_dir), M.HORIZONS).withColumnsRenamed(
        {f"b_{c}_{h}": f"m_{c}_{h}" for c, hs in M.HORIZONS.items() for h in hs}
    )
    return _shown(_flat(rows, FC.BASELINES))


@query("m4_j11_o6_analog", SERIES.rstrip(",") + NEAR + f" SELECT {_SHOWN} FROM ap")
def analog(spark, sf_dir):
    return _shown(_flat(predicted(spark, sf_dir), ["analog"]))


@query(
    "m5_m6_walk_forward",
    ALL + FOLDS + f" SELECT metric_id, geo_id, h, model, from_pidx, for_pidx, {R('actual', 3)} AS actual, {R('p50', 3)} AS p50, {R('pinball', 3)} AS pinball FROM fd",
)
def walk_forward(spark, sf_dir):
    folds = walked(spark, sf_dir).where((F.col("kind") == "fold") & F.col("p50").isNotNull())
    return folds.select(
        "metric_id", "geo_id", F.col("horizon").alias("h"), "model", "from_pidx", "for_pidx", r("actual", 3), r("p50", 3), r("pinball", 3)
    )


@query(
    "a24_m7_model_scores",
    ALL
    + FOLDS
    + SCORES
    + f" SELECT metric_id, geo_id, h, model, folds, {R('mae', 3)} AS mae, {R('pinball', 3)} AS pinball, {R('coverage_80')} AS coverage_80, {R('pinball_ratio')} AS pinball_ratio, {R('mae_ratio')} AS mae_ratio, verdict FROM sc",
)
def model_scores(spark, sf_dir):
    out = FC.scores(walked(spark, sf_dir))
    return out.select(
        "metric_id", "geo_id", F.col("horizon").alias("h"), "model", "folds", r("mae", 3), r("pinball", 3), r("coverage_80"), r("pinball_ratio"), r("mae_ratio"), "verdict"
    )


TARGETS = values_sql("tg", "target_id, metric_id, h, direction_only", M.TARGETS)
ISSUED = f""", {TARGETS}, ln AS (SELECT metric_id, geo_id, max(n) AS n FROM sr GROUP BY ALL),
  iss AS (SELECT target_id, ch.metric_id, ch.geo_id, ch.cadence, ch.h, pp.pidx AS from_pidx, pp.pidx + ch.h AS for_pidx, pp.value AS last_observed, ch.model, ch.verdict AS model_verdict,
      CASE WHEN NOT direction_only THEN p10 END AS p10, CASE WHEN NOT direction_only THEN p50 END AS p50, CASE WHEN NOT direction_only THEN p90 END AS p90, p_up, folds
    FROM ch JOIN tg USING (metric_id, h) JOIN ln USING (metric_id, geo_id) JOIN pp ON pp.metric_id = ch.metric_id AND pp.geo_id = ch.geo_id AND pp.h = ch.h AND pp.model = ch.model AND pp.n = ln.n
    WHERE ln.n >= CASE ch.cadence WHEN 'monthly' THEN 48 ELSE 24 END + ch.h + 4)"""


def targets(spark):
    return literal_table(spark, "target_id string, metric_id string, horizon int, direction_only boolean", M.TARGETS)


def issued(spark, sf_dir):
    return FC.issue(FC.choose(FC.scores(walked(spark, sf_dir))), targets(spark))


@query(
    "m7_m8_issued_forecasts",
    ALL + FOLDS + SCORES + ISSUED + f" SELECT target_id, geo_id, from_pidx, for_pidx, model, model_verdict, {R('p10', 3)} AS p10, {R('p50', 3)} AS p50, {R('p90', 3)} AS p90, {R('p_up')} AS p_up, folds FROM iss",
)
def issued_forecasts(spark, sf_dir):
    out = issued(spark, sf_dir)
    return out.select("target_id", "geo_id", "from_pidx", "for_pidx", "model", "model_verdict", r("p10", 3), r("p50", 3), r("p90", 3), r("p_up"), "folds")


@query(
    "m8_target_status",
    obs_sql(*METRICS)
    + f""", {TARGETS}, sz AS (SELECT metric_id, geo_id, cadence, count(*) AS observations FROM obs GROUP BY ALL)
    SELECT target_id, geo_id, observations, CASE cadence WHEN 'monthly' THEN 48 ELSE 24 END + h + 4 AS needed, CASE WHEN observations < CASE cadence WHEN 'monthly' THEN 48 ELSE 24 END + h + 4 THEN 'insufficient_data' ELSE 'evaluated' END AS status FROM sz JOIN tg USING (metric_id)""",
)
def target_status(spark, sf_dir):
    return FC.target_status(_series(spark, sf_dir), targets(spark)).select("target_id", "geo_id", "observations", "needed", "status")


# A frozen round made three months before the end, settled by what followed.
CUT = 24015


def frozen_round(spark, sf_dir):
    past = _series(spark, sf_dir, ["orders_count", "revenue"]).where(F.col("pidx") <= CUT)
    hz = {"monthly": [3, 6]}
    chosen = FC.choose(FC.scores(FC.walk_forward(FC.predictions(past, hz), hz)))
    return FC.issue(chosen, targets(spark))


_PAST = ALL.replace("sr AS (SELECT *, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS n FROM obs)", f"sr AS (SELECT *, row_number() OVER (PARTITION BY metric_id, geo_id ORDER BY pidx) AS n FROM obs WHERE pidx <= {CUT} AND cadence = 'monthly')")
MATURED = (
    _PAST
    + FOLDS
    + SCORES
    + ISSUED
    + """, mt AS (SELECT i.target_id, i.metric_id, i.geo_id, i.from_pidx, i.for_pidx, i.model, i.p50, o.value AS actual, abs(o.value - i.p50) AS abs_error, (o.value - i.p50) * 100 / nullif(abs(i.p50), 0) AS pct_error,
    (o.value BETWEEN i.p10 AND i.p90)::INTEGER AS inside_80, ((i.p_up > 0.5) = (o.value > i.last_observed))::INTEGER AS direction_correct
    FROM iss i JOIN obs o ON o.metric_id = i.metric_id AND o.geo_id = i.geo_id AND o.pidx = i.for_pidx)"""
)


@query(
    "m9_j15_scored_forecasts",
    MATURED + f" SELECT target_id, geo_id, from_pidx, for_pidx, model, {R('actual', 3)} AS actual, {R('abs_error', 3)} AS abs_error, {R('pct_error', 3)} AS pct_error, inside_80::DOUBLE AS inside_80, direction_correct::DOUBLE AS direction_correct FROM mt",
)
def scored_forecasts(spark, sf_dir):
    out = FC.score_matured(frozen_round(spark, sf_dir), _series(spark, sf_dir))
    return out.select(
        "target_id", "geo_id", "from_pidx", "for_pidx", "model", r("actual", 3), r("abs_error", 3), r("pct_error", 3),
        F.col("inside_80").cast("double").alias("inside_80"), F.col("direction_correct").cast("double").alias("direction_correct"),
    )


@query(
    "a26_j16_track_record",
    MATURED
    + f""", tr AS (SELECT i.target_id, m.actual, m.pct_error, m.inside_80, m.direction_correct FROM iss i LEFT JOIN mt m USING (target_id, geo_id, from_pidx))
    SELECT target_id, count(*) AS frozen, count(*) FILTER (WHERE actual IS NULL) AS pending, {R('avg(inside_80)')} AS coverage, {R('avg(direction_correct)')} AS direction_accuracy,
      {R('list_sort(list(abs(pct_error)) FILTER (WHERE pct_error IS NOT NULL))[(count(pct_error) // 2 + 1)::INTEGER]', 3)} AS median_abs_pct FROM tr GROUP BY ALL""",
)
def track_record(spark, sf_dir):
    frozen = frozen_round(spark, sf_dir)
    record = FC.track_record(frozen, FC.score_matured(frozen, _series(spark, sf_dir)))
    out = FC.record_summary(record)
    return out.select("target_id", "frozen", "pending", r("coverage"), r("direction_accuracy"), r("median_abs_pct", 3))


@query(
    "m12_ranking_agreement",
    obs_sql("segment_ticket")
    + f""", y AS (SELECT split_part(geo_id, '-', 2) AS place, geo_id, avg(value) FILTER (WHERE pidx // 12 = 1998) AS a, avg(value) FILTER (WHERE pidx // 12 = 1999) AS b FROM obs GROUP BY ALL),
    k AS (SELECT place, geo_id, rank() OVER (PARTITION BY place ORDER BY a)::DOUBLE AS ra, rank() OVER (PARTITION BY place ORDER BY b)::DOUBLE AS rb FROM y WHERE a IS NOT NULL AND b IS NOT NULL)
    SELECT place, count(*) AS items, {R('corr(ra, rb)')} AS spearman FROM k GROUP BY place HAVING count(*) >= 3""",
)
def ranking_agreement(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["segment_ticket"]).withColumn("place", F.split_part("geo_id", F.lit("-"), F.lit(2)))

    def year(y):
        rows = obs.where(F.floor(F.col("pidx") / F.lit(12.0)) == y)
        return rows.groupBy("place", "geo_id").agg(F.avg("value").alias("value"))

    out = FC.growth_ranking(year(1998), year(1999), "place", "geo_id")
    return out.where(F.col("items") >= 3).select("place", "items", r("spearman"))


# --- Transition -----------------------------------------------------------------------
WINDOW = 12
TRANSITION = (
    recursive(ZSQL + WIDE + VERDICT + HELD)
    + f""", t1 AS (SELECT *, rule_id IN ('stress', 'dislocation') AS bad, row_number() OVER (PARTITION BY place ORDER BY month) AS p, count(*) OVER (PARTITION BY place) AS total FROM tl),
  t2 AS (SELECT a.place, a.month, a.bad, a.p, a.p + {WINDOW} <= a.total AS complete, coalesce(bool_or(b.bad), FALSE) AS enters, a.bad AND NOT coalesce(max(c.bad), FALSE) AS starts, any_value(a.demand_momentum) AS d1, any_value(a.housing_pressure) AS d2, any_value(a.supply_response) AS d3, any_value(a.distress) AS d4
    FROM t1 a LEFT JOIN t1 b ON b.place = a.place AND b.p BETWEEN a.p + 1 AND a.p + {WINDOW} LEFT JOIN t1 c ON c.place = a.place AND c.p = a.p - 1 GROUP BY a.place, a.month, a.bad, a.p, a.total),
  br AS (SELECT avg(enters::INTEGER) FILTER (WHERE complete) AS base_rate, count(*) FILTER (WHERE complete) AS windows, count(*) FILTER (WHERE complete AND starts) AS episodes FROM t2)"""
)


def labelled(spark, sf_dir):
    return transition.labelled(timeline(spark, sf_dir), WINDOW)


@query("a25_w12_w13_base_rate", TRANSITION + f" SELECT {R('base_rate', 6)} AS base_rate, windows, episodes FROM br")
def base_rate(spark, sf_dir):
    return transition.base_rate(labelled(spark, sf_dir)).select(r("base_rate", 6), "windows", "episodes")


NEIGHBOURS = """, sv AS (SELECT * FROM t2 WHERE d1 IS NOT NULL AND d2 IS NOT NULL AND d3 IS NOT NULL AND d4 IS NOT NULL),
  tg AS (SELECT * FROM sv QUALIFY row_number() OVER (PARTITION BY place ORDER BY month DESC) = 1),
  cd AS (SELECT tg.place, c.enters, sqrt((c.d1 - tg.d1) ** 2 + (c.d2 - tg.d2) ** 2 + (c.d3 - tg.d3) ** 2 + (c.d4 - tg.d4) ** 2) AS dist, c.place AS cp, c.month AS cm FROM tg, sv c WHERE c.complete AND NOT (c.place = tg.place AND abs(c.month - tg.month) <= 12)),
  kn AS (SELECT place, count(*) AS neighbours, count(*) FILTER (WHERE enters) AS hits, min(dist) AS nearest FROM (SELECT * FROM cd QUALIFY row_number() OVER (PARTITION BY place ORDER BY dist, cp, cm) <= 20) GROUP BY place),
  pb AS (SELECT p.place, coalesce(neighbours >= 8, FALSE) AS ok, neighbours, hits, nearest, base_rate, episodes FROM (SELECT DISTINCT place FROM tl) p LEFT JOIN kn USING (place) CROSS JOIN br)"""


@query(
    "m10_m11_transition_probability",
    TRANSITION
    + NEIGHBOURS
    + f""" SELECT place, {R('CASE WHEN ok THEN (hits + 1)::DOUBLE / (neighbours + 2) ELSE base_rate END')} AS probability, CASE WHEN ok THEN 'analog_frequency' ELSE 'base_rate' END AS model, CASE WHEN ok THEN neighbours ELSE 0 END AS neighbours,
      {R('CASE WHEN ok THEN nearest END')} AS nearest_distance, {R('base_rate')} AS base_rate, episodes, CASE WHEN NOT ok THEN 'low' WHEN episodes >= 6 AND neighbours >= 15 THEN 'moderate' WHEN episodes >= 3 THEN 'low' ELSE 'very low' END AS confidence,
      (abs(CASE WHEN ok THEN (hits + 1)::DOUBLE / (neighbours + 2) ELSE base_rate END - base_rate) > 0.02)::INTEGER AS beats_base_rate FROM pb""",
)
def transition_probability(spark, sf_dir):
    from tidemark.session import cut_lineage

    # The labelled timeline feeds the rate, the targets and the candidates.
    marked = cut_lineage(labelled(spark, sf_dir))
    out = transition.analog_transition(marked)
    return out.select(
        "place", r("probability"), "model", "neighbours", r("nearest_distance"), r("base_rate"), "episodes", "confidence",
        F.col("beats_base_rate").cast("int").alias("beats_base_rate"),
    )


