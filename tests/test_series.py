"""Window kernel on stated vectors, order independence and brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollups, series as S

JAN_2024 = 2024 * 12
KEY = ("m", "mun-00001")


def points(df, column):
    return {r["pidx"]: r[column] for r in df.collect() if r[column] is not None}


def test_yoy_monthly(series):
    df = series({KEY: {JAN_2024 + i: 100.0 if i < 12 else 110.0 for i in range(24)}})
    got = points(S.yoy(df), "yoy")
    assert set(got) == {JAN_2024 + i for i in range(12, 24)} and set(got.values()) == {10.0}


def test_yoy_quarterly_and_zero_base(series):
    q = series({KEY: {8096: 100.0, 8097: 100.0, 8100: 150.0, 8101: 50.0}}, "quarterly")
    assert points(S.yoy(q, ("quarterly",)), "yoy") == {8100: 50.0, 8101: -50.0}
    zero = series({KEY: {JAN_2024 + i: 0.0 if i < 12 else 5.0 for i in range(13)}})
    assert points(S.yoy(zero), "yoy") == {}


def test_yoy_respects_gaps(series):
    # Thirteen rows, but one year back is missing: a row lag would be wrong.
    df = series({KEY: {JAN_2024 + i: float(i + 1) for i in range(14) if i != 1}})
    assert set(points(S.yoy(df), "yoy")) == {JAN_2024 + 12}


def test_zscore_vectors(series):
    values = [10.0, 10.5] * 12 + [20.0]
    df = series({KEY: {JAN_2024 + i: v for i, v in enumerate(values)}})
    got = points(S.zscored(df, ("metric_id", "geo_id"), "value"), "z")
    assert got == {JAN_2024 + 24: 4.0}
    flat = series({KEY: {JAN_2024 + i: 10.0 if i < 24 else 20.0 for i in range(25)}})
    assert points(S.zscored(flat, ("metric_id", "geo_id"), "value"), "z") == {}
    short = series({KEY: {JAN_2024 + i: float(i) for i in range(5)}})
    assert points(S.zscored(short, ("metric_id", "geo_id"), "value"), "z") == {}


def test_zscore_and_outlier_match_brute_force_in_any_order(spark, series):
    rng = random.Random(7)
    values = {JAN_2024 + i: rng.gauss(50, 9) for i in range(70) if i % 9}
    df = series({KEY: values, ("m", "mun-00002"): {p: v * 2 for p, v in values.items()}}).orderBy(F.rand(1)).repartition(3)
    z = points(S.zscored(df, ("metric_id", "geo_id"), "value").where("geo_id = 'mun-00001'"), "z")
    out = points(S.with_outlier_score(df).where("geo_id = 'mun-00001'"), "outlier")
    order = sorted(values)
    for i, p in enumerate(order):
        past = [values[q] for q in order[:i]]
        if len(past) >= 24:
            want = (values[p] - statistics.mean(past)) / statistics.pstdev(past)
            assert z[p] == pytest.approx(max(-4, min(4, want)))
        window = past[-12:]
        if len(window) >= 6:
            med = statistics.median(window)
            mad = statistics.median(abs(v - med) for v in window)
            assert out[p] == pytest.approx(abs(values[p] - med) / (1.4826 * mad))


def test_to_months(series):
    q = S.to_months(series({KEY: {2025 * 4: 5.0}}, "quarterly")).collect()
    assert {r["month"]: r["value"] for r in q} == {2025 * 12 + i: 5.0 for i in range(3)}
    a = S.to_months(series({KEY: {2025: 3.0}}, "annual")).collect()
    assert sorted(r["month"] for r in a) == [2025 * 12 + i for i in range(12)]


def test_weekly_collision_keeps_the_latest(series):
    from tidemark.functions.periods import week_of

    df = series({KEY: {0: 0.0}})
    spark = df.sparkSession
    weeks = [r["w"] for r in spark.sql("SELECT explode(sequence(date'2026-07-06', date'2026-08-03', interval 7 days)) d").select(week_of("d").alias("w")).collect()]
    got = S.to_months(series({KEY: {w: float(i) for i, w in enumerate(weeks)}}, "weekly")).collect()
    # Sundays 12, 19, 26 July and 2, 9 August.
    assert {r["month"]: r["value"] for r in got} == {2026 * 12 + 6: 2.0, 2026 * 12 + 7: 4.0}


def test_ratio_and_carry(spark):
    num = spark.createDataFrame([("g", 1, 10.0), ("g", 2, 20.0)], "geo_id string, pidx int, value double")
    den = spark.createDataFrame([("g", 1, 5.0)], "geo_id string, pidx int, value double")
    assert {r["pidx"]: r["value"] for r in S.ratio(num, den, scale=1000.0).collect()} == {1: 2000.0}
    base = 2024 * 12
    late = spark.createDataFrame([("g", base + 5, 50.0), ("g", base + 29, 50.0)], "geo_id string, pidx int, value double")
    stock = spark.createDataFrame([("g", "k", "nation", "annual", 2024, 1000.0)], "geo_id string, metric_id string, geo_level string, cadence string, pidx int, value double")
    monthly = S.to_months(stock).select("geo_id", F.col("month").alias("pidx"), "value")
    got = {r["pidx"]: r["value"] for r in S.carry_denominator(late, monthly, 12, scale=1000.0).collect()}
    # June 2026 is more than a year past the last covered month.
    assert got == {base + 5: 50.0}


def test_fill_months_and_episodes(spark):
    events = spark.createDataFrame([("a", "2024-01-05", 1.0), ("a", "2024-01-20", 2.0), ("a", "2024-04-01", 3.0)], "k string, at string, value double")
    got = S.fill_months(events.withColumn("at", F.to_date("at")), ("k",)).collect()
    assert [r["value"] for r in sorted(got, key=lambda r: r["month"])] == [2.0, 2.0, 2.0, 3.0]
    flags = spark.createDataFrame([("a", i, b) for i, b in enumerate([True, True, False, True, False])], "k string, pidx int, f boolean")
    runs = S.episodes(flags, "f", ("k",)).where("f").groupBy("episode").count().collect()
    assert sorted((r["episode"], r["count"]) for r in runs) == [(1, 2), (2, 1)]


def test_next_in_time_with_a_dominant_key(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else f"k{rng.randint(0, 3)}", rng.randint(0, 400), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = S.next_in_time(df, ["k"], "t", ["id"], "id", F.floor(F.col("t") / 25), "nxt").collect()
    order, want = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if k in order:
            want[order[k]] = i
        order[k] = i
    assert {r["id"]: r["nxt"] for r in got} == {i: want.get(i) for _, _, i in rows}


def test_multi_holder_and_pooling(spark):
    rows = spark.createDataFrame([("x", o) for o in ("a", "a", "b", "c")], "g string, o string")
    assert rollups.multi_holder_share(rows, ["g"], "o").first()["value"] == 50.0
    parts = spark.createDataFrame([("p", i, float(v)) for i in range(8) for v in (1, 3)], "place string, pidx int, value double")
    mean = rollups.pool_parts(parts, ["place"], F.lit("mean")).collect()
    assert {r["value"] for r in mean} == {2.0} and len(mean) == 8
    assert rollups.pool_parts(parts.where("pidx < 7"), ["place"], F.lit("sum")).count() == 0
