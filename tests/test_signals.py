"""Regimes, indices, signatures, lead-lag and desk."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import desk, indices, leadlag, regimes
from tidemark.session import literal_table
from tidemark.sources import dims

IDS = regimes.INDEX_IDS


def verdict(spark, rules=regimes.REGIMES_V3, delta=None, **values):
    cols = [F.lit(values.get(i)).cast("double").alias(i) for i in IDS]
    df = spark.range(1).select(*cols, F.lit(delta).cast("double").alias("delta_housing_pressure_2"))
    return df.select(regimes.classify(rules).alias("r")).first()["r"]


def test_rule_order_and_missing_signals(spark):
    assert verdict(spark, distress=3.0, demand_momentum=-2.0) == "dislocation"
    assert verdict(spark, distress=1.5, demand_momentum=0.0) == "stress"
    assert verdict(spark) == "neutral"
    assert verdict(spark, housing_pressure=1.5, delta=-0.5) == "hot_decelerating"
    assert verdict(spark, housing_pressure=1.5) == "hot"
    assert verdict(spark, regimes.REGIMES_V1, housing_pressure=0.9, delta=-0.5) == "neutral"
    assert verdict(spark, housing_pressure=-0.2, distress=0.1, demand_momentum=0.0) == "orderly_cooling"


def test_a_rule_set_needs_a_fallback():
    with pytest.raises(ValueError):
        regimes.classify(regimes.REGIMES_V3[:-1])


def fold(states, sticky=("stress", "dislocation"), periods=2):
    held, streak, out = "", 0, []
    for s in states:
        keep = held in sticky and s != held and streak + 1 < periods
        streak = streak + 1 if keep else 0
        held = held if keep else s
        out.append((held, keep))
    return out


def test_hysteresis_matches_a_plain_fold(spark):
    rng = random.Random(11)
    states = {p: [rng.choice(["stress", "hot", "neutral", "dislocation"]) for _ in range(60)] for p in ("a", "b", "c")}
    rows = [(p, i, s) for p, seq in states.items() for i, s in enumerate(seq)]
    df = spark.createDataFrame(rows, "place string, month int, verdict string").orderBy(F.rand(3))
    for periods in (1, 2, 3):
        got = regimes.hold(df, hysteresis=periods).orderBy("month").collect()
        for p, seq in states.items():
            mine = [(r["rule_id"], r["held_by_hysteresis"]) for r in got if r["place"] == p]
            assert mine == fold(seq, periods=periods)
    labels = dict((rid, label) for rid, label, _ in regimes.REGIMES_V3)
    assert all(r["label"] == labels[r["rule_id"]] for r in regimes.hold(df).collect())


def test_index_needs_its_components(spark):
    comp = literal_table(spark, dims.COMPONENT_SCHEMA, [("i", "a", "yoy", 3.0, 2), ("i", "b", "yoy", 1.0, 2)])
    schema = "place string, metric_id string, transform string, geo_id string, geo_level string, month int, raw double, z double, oriented double"
    rows = [("p", "a", "yoy", "g", "l", 1, 0.0, 1.0, 1.0), ("p", "b", "yoy", "g", "l", 1, 0.0, 2.0, -2.0), ("p", "a", "yoy", "g", "l", 2, 0.0, 4.0, 4.0)]
    scores = spark.createDataFrame(rows, schema)
    hist = {r["month"]: r["value"] for r in indices.index_history(scores, comp).collect()}
    assert hist == {1: 0.25}
    now = indices.current_index(scores, comp).first()
    assert (now["value"], now["month"], now["oldest_component"]) == (2.5, 2, 1)
    alone = indices.current_index(scores.where("metric_id = 'a'"), comp).first()
    assert alone["value"] is None and alone["insufficient"]


def test_declared_components_are_well_formed(spark):
    comp = dims.index_components(spark)
    assert comp.count() == len(dims.INDEX_COMPONENTS)
    assert {r["index_id"] for r in comp.select("index_id").distinct().collect()} == set(IDS)
    assert {t for _, _, t, *_ in dims.INDEX_COMPONENTS} <= set(indices.TRANSFORMS) | {indices.PER_STOCK}


def test_signatures_count_only_available_signals(spark):
    places = spark.createDataFrame([("p",), ("q",)], "place string")
    scores = spark.createDataFrame([("p", "a", "yoy", 1, 0.9), ("p", "a", "yoy", 2, 0.6), ("p", "b", "yoy", 1, 0.2)], "place string, metric_id string, transform string, month int, z double")
    signals = [("x", "a", "yoy", "up"), ("x", "b", "yoy", "down"), ("x", "c", "yoy", "up")]
    got = {r["place"]: r for r in indices.match_signatures(scores, signals, places).collect()}
    assert (got["p"]["firing"], got["p"]["available"], got["p"]["total"]) == (1, 2, 3)
    assert got["p"]["signals_firing"] == ["a"] and got["p"]["signals_unavailable"] == ["c"]
    assert got["q"]["score"] is None and got["q"]["insufficient"]


def placed(spark, data):
    rows = [(p, m, "monthly", i, v) for (p, m), values in data.items() for i, v in values.items()]
    return spark.createDataFrame(rows, "place string, metric_id string, cadence string, pidx int, value double")


def test_a_true_lead_is_found_and_noise_is_not(spark):
    rng = random.Random(2)
    base = [100 + 25 * math.sin(i / 5.3) + rng.gauss(0, 4) for i in range(140)]
    data = {
        ("p", "lead"): {i: base[i] for i in range(120)},
        ("p", "lagged"): {i: base[i - 3] for i in range(3, 120)},
        ("p", "noise"): {i: 100 + rng.gauss(0, 20) for i in range(120)},
        ("p", "short"): {i: float(i + 1) for i in range(20)},
    }
    pairs = literal_table(spark, "signal string, outcome string", [("lead", "lagged"), ("noise", "lagged"), ("lead", "short")])
    got = {(r["signal"], r["outcome"]): r for r in leadlag.evaluate(placed(spark, data), pairs).collect()}
    hit = got["lead", "lagged"]
    assert (hit["best_lag"], hit["verdict"], hit["observations"]) == (3, "leading", 12)
    assert got["noise", "lagged"]["verdict"] != "leading"
    assert got["lead", "short"]["verdict"] == "insufficient_data"
    summary = {r["signal"]: r for r in leadlag.pair_summary(leadlag.evaluate(placed(spark, data), pairs)).where("outcome = 'lagged'").collect()}
    assert summary["lead"]["verdict"] == "no_evidence" and summary["lead"]["leading"] == 1


def test_desk_orients_inverted_metrics(spark):
    rng = random.Random(4)
    values = {i: 10 + rng.gauss(0, 1) for i in range(40)} | {40: 13.0}
    data = {("p", "vacancy"): values, ("p", "cafes"): values}
    directions = literal_table(spark, "metric_id string, direction int", [("vacancy", -1), ("cafes", 1)])
    got = {r["metric_id"]: r for r in desk.entries(placed(spark, data), directions).collect()}
    assert got["cafes"]["index"] + got["vacancy"]["index"] == 100
    assert got["cafes"]["read"] == "expansionary" and got["vacancy"]["read"] == "contractionary"
    assert desk.composite(spark.createDataFrame([("p", 60.0), ("p", None)], "place string, index double")).first()["composite_n"] == 1


def test_own_series_is_preferred_when_long_enough(spark):
    own = placed(spark, {("p", "m"): {i: 1.0 for i in range(8)}, ("q", "m"): {i: 1.0 for i in range(7)}})
    pool = placed(spark, {("p", "m"): {i: 2.0 for i in range(9)}, ("q", "m"): {i: 2.0 for i in range(9)}})
    got = {(r["place"], r["pooled"]) for r in desk.own_or_pooled(own, pool).collect()}
    assert got == {("p", False), ("q", True)}
