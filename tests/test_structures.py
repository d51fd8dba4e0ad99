"""Structures behind medians, prefix quantiles, analogs, neighbours, digests and identifiers, against plain counts."""

import hashlib
import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, stats
from tidemark.operators import forecast as FC, history as H, series as S
from tidemark.operators.neighbours import Cells, nearest


def spark_order(x):
    return (math.isnan(x), x if not math.isnan(x) else 0.0)


@pytest.mark.parametrize("bound", [100_000, 5])
def test_upper_medians_of_every_kind_of_value(spark, bound):
    rng = random.Random(3)
    inf, nan = float("inf"), float("nan")
    groups = {
        "skewed": [rng.lognormvariate(0, 4) for _ in range(3001)],
        "tied": [float(rng.randint(0, 2)) for _ in range(999)],
        "infinite": [inf] * 60 + [-inf] * 10 + [rng.gauss(0, 1) for _ in range(100)],
        "mostly inf": [inf] * 60 + [1.0] * 7,
        "mostly -inf": [-inf] * 60 + [1.0] * 7,
        "nan": [nan] * 50 + [1.0, 2.0],
        "some nan": [nan] * 50 + [float(i) for i in range(70)],
        "wide": [-1.7e308, 1.7e308, *[rng.choice([-1, 1]) * 10.0 ** rng.randint(0, 300) for _ in range(60)]],
        "one": [7.5],
        None: [float(i) for i in range(500)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("skewed", None), ("empty", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: (r.median, r.n) for r in stats.upper_median_by(df, ["k"], "v", count="n", bound=bound).collect()}
    want = {k: (sorted(vs, key=spark_order)[len(vs) // 2], len(vs)) for k, vs in groups.items()}
    assert set(got) == set(want)
    for k, (m, n) in want.items():
        assert got[k][1] == n and (got[k][0] == m or math.isnan(m) and math.isnan(got[k][0])), k


def test_upper_median_reads_its_input_twice_and_copies_nothing(spark, monkeypatch):
    written = []
    own = stats.cut_lineage
    monkeypatch.setattr(stats, "cut_lineage", lambda df: written.append(own(df)) or written[-1])
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    stats.upper_median_by(df, ["k"], "v").collect()
    assert len(written) == 2 and sum(w.count() for w in written) < 0.2 * 200_000


def test_prefix_quantiles_equal_numpy():
    rng = np.random.default_rng(1)
    for n in (1, 5, 400):
        v = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 30, n) / 4)
        got = S.prefix_quantiles(v, [0.0, 0.1, 0.5, 0.9, 1.0])
        for i in range(n):
            past = v[: i + 1][~np.isnan(v[: i + 1])]
            if not len(past):
                assert got[i] is None
            else:
                assert got[i] == pytest.approx(np.quantile(past, [0.0, 0.1, 0.5, 0.9, 1.0]).tolist())


def test_prefix_quantiles_of_a_long_series_take_seconds():
    start = time.process_time()
    got = S.prefix_quantiles(np.random.default_rng(2).normal(size=100_000), [0.1, 0.5, 0.9])
    assert time.process_time() - start < 20
    assert abs(got[-1][1]) < 0.02


def plain_analogs(v, horizon, k, embargo):
    shape = FC._shapes(v)
    out = np.full((len(v), 5), np.nan)
    for e in range(len(v)):
        pool = []
        for p in range(4, min(e - horizon, e - embargo - 1) + 1):
            if v[p] != 0 and not np.isnan(v[p]) and not np.isnan(v[p + horizon]) and not np.isnan(shape[p]).any():
                pool.append((float(np.sqrt(((shape[p] - shape[e]) ** 2).sum())), p))
        if e + 1 < horizon + embargo + 6 or np.isnan(shape[e]).any() or len(pool) < 4:
            continue
        changes = np.array([(v[p + horizon] - v[p]) / abs(v[p]) for _, p in sorted(pool)[:k]])
        out[e, :3] = v[e] * (1 + np.quantile(changes, [0.1, 0.5, 0.9]))
        out[e, 3:] = (changes > 0).mean(), len(pool)
    return out


@pytest.mark.parametrize("horizon, embargo", [(3, 12), (12, 1)])
def test_analogs_equal_all_pairs_with_ties(horizon, embargo):
    rng = np.random.default_rng(5)
    v = rng.integers(1, 6, 300).astype(float)  # many equal shapes
    v[[40, 90]] = np.nan
    v[200] = 0.0
    np.testing.assert_allclose(FC.analog_predictions(v, horizon, 12, embargo), plain_analogs(v, horizon, 12, embargo))


def test_analogs_of_a_smooth_series_compute_few_distances():
    n = 4000
    v = 100 + np.cumsum(np.sin(np.arange(n) / 9) + np.random.default_rng(0).normal(0, 0.1, n)) * 0.5
    counts: list[int] = []
    FC.analog_predictions(v, 3, 12, 12, counts=counts)
    assert counts[0] < 0.12 * n * n / 2


def test_targets_open_few_cells_and_find_all_neighbours(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(0, 20, (12, 4))
    points = np.concatenate([m + rng.normal(0, 1, (150, 4)) for m in middles])
    c = spark.createDataFrame(pd.DataFrame({"place": [f"p{i % 7}" for i in range(1800)], "month": range(1800), "vector": points.tolist()}))
    c = c.unionByName(spark.createDataFrame([("p1", 5000, None), ("p1", 5001, [float("nan")] * 4)], "place string, month long, vector array<double>"))
    asked = [(f"t{i}", "p1", 900, (middles[i] + 0.3).tolist()) for i in range(12)]
    t = spark.createDataFrame(asked, "target string, place string, month long, vector array<double>")
    cells = Cells(c, ("place", "month"), 10, 24, 12)
    opened = cells.asked(t, c, ["place", "month"]).count()
    assert cells.size.sum() == 1800 and (cells.size > 0).sum() >= 16
    assert opened < 0.6 * 12 * (cells.size > 0).sum()
    got = {}
    for r in nearest(c, t, 10, ("place", "month"), (), 12, 24).orderBy("target", "position").collect():
        got.setdefault(r.target, []).append(r.month)
    for name, place, month, v in asked:
        pool = [(math.dist(p, v), f"p{i % 7}", i) for i, p in enumerate(points.tolist()) if not (f"p{i % 7}" == place and abs(i - month) <= 12)]
        assert got[name] == [i for _, _, i in sorted(pool)[:10]]
    assert nearest(c.limit(0), t, 3, ("place", "month")).count() == 0


def test_digests_add_up(spark):
    rows = [("a", i % 50, i / 8) for i in range(300)] + [("b", 1, None), ("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, n int, v double")
    columns = ["k", "n", "v"]
    whole = H.fingerprint(df, columns, ["k"])
    old, new = H.fingerprint(df.where("n < 20"), columns, ["k"]), H.fingerprint(df.where("n >= 20"), columns, ["k"])
    as_rows = lambda d: {(r.k, r.rows, r.digest) for r in d.collect()}
    assert as_rows(H.add_fingerprints(old.unionByName(new), keys=["k"])) == as_rows(whole)
    assert as_rows(H.add_fingerprints(whole, new, ["k"]).where("rows > 0")) == as_rows(old)
    lanes = [0] * 4
    for _ in range(2):
        h = hashlib.sha256(b"b|1").hexdigest()
        lanes = [(x + int(h[16 * i : 16 * i + 16], 16)) % 2**64 for i, x in enumerate(lanes)]
    assert ("b", 2, "".join(f"{x:016x}" for x in lanes)) in as_rows(H.fingerprint(df, ["k", "n"], ["k"]))


def test_codes_beyond_their_width_stay_apart(spark):
    df = spark.range(1, 131).select(geo.district(F.lit(1), F.col("id")).alias("d"), geo.province("id").alias("p"), geo.municipality(F.col("id") * 1000).alias("m"))
    assert [df.select(c).distinct().count() for c in ("d", "p", "m")] == [130, 130, 130]
    r = spark.range(1).select(geo.district(F.lit(1), F.lit(100)).alias("d"), geo.district(F.lit(7), F.lit(3)).alias("e"), geo.geo_level_of(geo.district(F.lit(1), F.lit(100))).alias("level")).first()
    assert (r.d, r.e, r.level) == ("dist-00001-100", "dist-00007-03", None)
