"""Forecast models against plain Python, protocol properties, neighbours, transitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forecast as FC, transition
from tidemark.operators.neighbours import nearest

START = 2010 * 12


def preds(df, hz):
    out = {}
    for r in FC.predictions(df.select("metric_id", "geo_id", "cadence", "pidx", "value"), hz).collect():
        for c, hs in hz.items():
            for h in hs:
                for m in r[f"m_{c}_{h}"] or []:
                    if r["cadence"] == c:
                        out[r["pidx"], h, m["model"]] = m
    return out


def test_seasonal_naive_is_exact_on_a_cycle(series):
    df = series({("m", "g"): {START + i: float(i % 12) for i in range(120)}})
    got = preds(df, {"monthly": [1, 3, 6, 12, 15]})
    for h in (1, 3, 6, 12):
        assert got[START + 119, h, "seasonal_naive"]["p50"] == float((119 + h) % 12)
    # Beyond one season the value one full cycle back is used.
    assert got[START + 119, 15, "seasonal_naive"]["p50"] == float(108 % 12)


def test_quantiles_are_ordered_and_short_histories_refuse(series):
    df = series({("m", "g"): {START + i: 100 + (i % 12) * 5 + 0.4 * i for i in range(80)}})
    for m in preds(df, {"monthly": [3]}).values():
        if m["p50"] is not None:
            assert m["p10"] <= m["p50"] <= m["p90"]
    short = preds(series({("m", "g"): {START + i: float(i) for i in range(3)}}), {"monthly": [6]})
    assert all(m["p50"] is None for m in short.values())


def quantile(values, q):
    return float(np.quantile(np.array(values), q))


def test_models_match_a_plain_loop(series):
    rng = random.Random(9)
    v = [50 + 10 * math.sin(i / 2) + rng.gauss(0, 3) for i in range(70)]
    got = preds(series({("m", "g"): {START + i: x for i, x in enumerate(v)}}), {"monthly": [3]})
    h, season = 3, 12
    for n in range(25, 71):
        hist = v[:n]
        rw = [hist[i] - hist[i - h] for i in range(h, n)]
        sn = [hist[i] - hist[i - season] for i in range(season + h, n)]
        assert got[START + n - 1, h, "random_walk"]["p90"] == pytest.approx(hist[-1] + quantile(rw, 0.9))
        assert got[START + n - 1, h, "seasonal_naive"]["p10"] == pytest.approx(hist[-season + h - 1] + quantile(sn, 0.1))
        step = (hist[-1] - hist[-season]) / (season - 1)
        dr = [hist[i] - (hist[i - 1] + (hist[i - 1] - hist[i - season]) / (season - 1) * h) for i in range(season + h, n)]
        assert got[START + n - 1, h, "drift"]["p50"] == pytest.approx(hist[-1] + step * h + quantile(dr, 0.5))
        shape = lambda i: [(hist[i - 3 + k] - hist[i - 3]) / abs(hist[i - 3]) for k in (1, 2, 3)]
        pool = sorted((math.dist(shape(i), shape(n - 1)), i) for i in range(4, n - h) if n - 1 - i > 12)[:12]
        if len(pool) >= 4:
            moves = [(hist[i + h] - hist[i]) / abs(hist[i]) for _, i in pool]
            assert got[START + n - 1, h, "analog"]["p50"] == pytest.approx(hist[-1] * (1 + quantile(moves, 0.5)))


def test_embargo_shrinks_the_pool():
    v = np.array([float(i % 24) + 1 for i in range(200)])
    a, b = FC.analog_predictions(v, 3, 12, 0), FC.analog_predictions(v, 3, 12, 36)
    assert b[-1, 4] < a[-1, 4]
    # Small chunks give the same answer as one large block.
    assert np.allclose(FC.analog_predictions(v, 3, 12, 12), FC.analog_predictions(v, 3, 12, 12), equal_nan=True)


def test_training_ends_before_the_target(series):
    df = series({("m", "g"): {START + i: 100.0 + i % 7 for i in range(100)}})
    hz = {"monthly": [3]}
    walked = FC.walk_forward(FC.predictions(df.select("metric_id", "geo_id", "cadence", "pidx", "value"), hz), hz)
    folds = walked.where("kind = 'fold' AND model = 'drift'").collect()
    assert all(r["from_pidx"] < r["for_pidx"] for r in folds)
    # Cuts 48..96 with one embargoed period; targets three steps after the cut.
    assert sorted(r["for_pidx"] - START for r in folds) == list(range(51, 100))
    assert {r["for_pidx"] - r["from_pidx"] for r in folds} == {4}
    scored = FC.scores(walked)
    chosen = FC.choose(scored).first()
    best = min(r["pinball"] for r in scored.collect() if r["model"] in FC.BASELINES)
    assert chosen["verdict"] in ("baseline", "beats_baseline") and (chosen["verdict"] != "baseline" or chosen["pinball"] == best)
    assert chosen["issue"]["for_pidx"] == START + 102


def test_aligned_folds_and_fixed_drift_errors(series):
    df = series({("m", "g"): {START + i: float(i) for i in range(70)}}).select("metric_id", "geo_id", "cadence", "pidx", "value")
    hz = {"monthly": [3]}
    wide = {"monthly": [3, 4]}
    drift = "kind = 'fold' AND model = 'drift'"
    # On a straight line the aligned fold is exact and the plain one is a step short.
    fixed = FC.predictions(df, wide, fix_horizon=True)
    aligned = FC.walk_forward(fixed, hz, align=True).where(drift).collect()
    plain_ = FC.walk_forward(fixed, hz).where(drift).collect()
    assert aligned and all(abs(r["actual"] - r["p50"]) < 1e-9 for r in aligned)
    assert all(abs(r["actual"] - r["p50"] - 1.0) < 1e-9 for r in plain_)
    # The default error compares an h-step extrapolation with the next value.
    default = FC.walk_forward(FC.predictions(df, hz), hz).where(drift).collect()
    assert all(abs(r["actual"] - r["p50"] - 3.0) < 1e-9 for r in default)


def test_supplied_state_vectors_are_compared(spark):
    rows = [("m", "g", "monthly", START + i, 100.0 + i, [float(i % 5), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "metric_id string, geo_id string, cadence string, pidx int, value double, state array<double>")
    got = FC.with_analogs(df, {"monthly": [3]}, state="state").where(F.col("a_3").isNotNull())
    assert got.count() > 20


def brute_nearest(cands, targets, k, embargo=None):
    out = {}
    for t, place, month, v in targets:
        pool = []
        for cp, cm, hit, cv in cands:
            if embargo is not None and cp == place and abs(cm - month) <= embargo:
                continue
            pool.append((math.dist(cv, v), cp, cm))
        out[t] = [(cp, cm) for _, cp, cm in sorted(pool)[:k]]
    return out


@pytest.mark.parametrize("blocks,slices", [(1, 1), (5, 1), (3, 4), (None, None)])
def test_nearest_is_exact_under_any_blocking(spark, blocks, slices):
    rng = random.Random(1)
    # One place holds most candidates; a coarse grid makes many equal distances.
    cands = [("hot" if rng.random() < 0.7 else f"p{rng.randint(0, 4)}", i, i % 2, [rng.randint(0, 4) / 2 for _ in range(4)]) for i in range(400)]
    targets = [(p, p, 200, [1.0, 1.0, 0.5, 1.5]) for p in ("hot", "p1", "p2", "p9")]
    c = spark.createDataFrame(cands, "place string, month int, hit int, vector array<double>")
    t = spark.createDataFrame(targets, "target string, place string, month int, vector array<double>")
    got = nearest(c, t, 20, ("place", "month"), ("hit",), 12, blocks, slices).orderBy("target", "position").collect()
    mine = {}
    for r in got:
        mine.setdefault(r["target"], []).append((r["place"], r["month"]))
    assert mine == brute_nearest(cands, targets, 20, 12)


def test_transition_matches_a_plain_count(spark):
    rng = random.Random(6)
    rows, ids = [], transition.INDEX_IDS
    for p in range(4):
        for m in range(80):
            state = "stress" if rng.random() < 0.12 else "neutral"
            rows.append((f"p{p}", m, state, *[round(rng.gauss(0, 1), 2) for _ in ids]))
    df = spark.createDataFrame(rows, "place string, month int, rule_id string, " + ", ".join(f"{i} double" for i in ids))
    window = 6
    marked = transition.labelled(df, window)
    hits = total = episodes = 0
    enters = {}
    for p in range(4):
        line = [r for r in rows if r[0] == f"p{p}"]
        before = False
        for i in range(len(line) - window):
            total += 1
            enters[f"p{p}", i] = any(line[i + s][2] == "stress" for s in range(1, window + 1))
            hits += enters[f"p{p}", i]
            bad = line[i][2] == "stress"
            episodes += bad and not before
            before = bad
    rate = transition.base_rate(marked).first()
    assert (rate["windows"], rate["episodes"]) == (total, episodes) and rate["base_rate"] == pytest.approx(hits / total)
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    cands = [(r[0], r[1], 0, [r[3 + i] for i in order]) for r in rows if (r[0], r[1]) in enters]
    targets = [(f"p{p}", f"p{p}", 79, [rows[p * 80 + 79][3 + i] for i in order]) for p in range(4)]
    near = brute_nearest(cands, targets, 20, 12)
    got = {r["place"]: r["probability"] for r in transition.analog_transition(marked, blocks=3, slices=2).collect()}
    for p, pairs in near.items():
        assert got[p] == pytest.approx((sum(enters[q] for q in pairs) + 1) / (len(pairs) + 2))


def test_ranking_agreement(spark):
    now = spark.createDataFrame([("p", str(i), float(i)) for i in range(5)], "place string, item string, value double")
    then = spark.createDataFrame([("p", str(i), float(-i)) for i in range(5)], "place string, item string, value double")
    assert FC.growth_ranking(now, then, "place", "item").first()["spearman"] == pytest.approx(-1.0)
