"""Period, geography, text and statistics functions on stated vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, periods as P, stats, text as X


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "period,cadence",
    [("2026", "annual"), ("2026-Q3", "quarterly"), ("2026-07", "monthly"), ("2026-W30", "weekly"), ("2026-07-25", "daily")],
)
def test_period_round_trip(spark, period, cadence):
    row = spark.range(1).select(F.lit(period).alias("p")).select(P.cadence_of("p").alias("c"), P.pidx_of_period("p").alias("i")).select(
        "c", P.period_text("i", "c").alias("back")
    ).first()
    assert (row["c"], row["back"]) == (cadence, period)


@pytest.mark.parametrize("bad", ["2026-13", "2026-Q5", "26-07", "2026/07", "July 2026", ""])
def test_malformed_periods_are_null(spark, bad):
    row = spark.range(1).select(F.lit(bad).alias("p")).select(P.cadence_of("p").alias("c"), P.pidx_of_period("p").alias("i")).first()
    assert row["c"] is None and row["i"] is None


@pytest.mark.parametrize(
    "period,n,expected",
    [
        ("2026-01", -1, "2025-12"), ("2026-12", 1, "2027-01"), ("2026-Q1", -1, "2025-Q4"), ("2026-Q4", 1, "2027-Q1"),
        ("2026", 3, "2029"), ("2020-W53", 1, "2021-W01"), ("2024-02-28", 1, "2024-02-29"),
    ],
)
def test_period_shift(spark, period, n, expected):
    assert one(spark, P.period_shift("p", n), p=period) == expected


@pytest.mark.parametrize(
    "period,expected",
    [("2024-02", "2024-02-29"), ("2026-02", "2026-02-28"), ("2026-Q2", "2026-06-30"), ("2026-W30", "2026-07-26"), ("2025", "2025-12-31")],
)
def test_period_end(spark, period, expected):
    assert str(one(spark, P.period_end("p"), p=period)) == expected


@pytest.mark.parametrize(
    "spelled,expected",
    [
        ("2026-Julio", "2026-07"), ("ENE 1999", "1999-01"), ("25/07/2026", "2026-07"), ("26-T1", "2026-Q1"),
        ("2026M07", "2026-07"), ("2026T3", "2026-Q3"), ("2026/7", "2026-07"), ("40/40/2026", None), ("soon", None),
    ],
)
def test_publisher_dates(spark, spelled, expected):
    assert one(spark, P.parse_period("p"), p=spelled) == expected


@pytest.mark.parametrize(
    "geo_id,level",
    [
        ("mun-28079", "municipality"), ("dist-28079-07", "district"), ("barrio-28079-074", "barrio"), ("prov-28", "province"),
        ("ccaa-13", "ccaa"), ("es", "nation"), ("apt-MAD", "airport"), ("port-PMI", "port"), ("mun-1", None),
    ],
)
def test_geo_levels(spark, geo_id, level):
    assert one(spark, geo.geo_level_of("g"), g=geo_id) == level


def test_numbers_and_names(spark):
    assert one(spark, X.european_number("t"), t="1.234,5") == 1234.5
    assert one(spark, X.european_number("t"), t=" nan ") is None
    assert one(spark, X.whole_number("t"), t="12.345") == 12345
    assert one(spark, X.normalise_name("t", "distrito"), t=" Distrito  Chamberí - Sur ") == "CHAMBERI-SUR"
    assert one(spark, X.canonical_number("v"), v=2.5) == "2.5"
    assert one(spark, X.canonical_number("v"), v=2.0) == "2"
    assert one(spark, X.same_value("a", "b"), a=100.0, b=100.0000000001) is True
    assert one(spark, X.base_unit_value(F.lit(2.0), "u"), u="Miles de euros") == 2000.0


def test_normal_cdf_is_close_to_erf(spark):
    zs = [x / 10 for x in range(-40, 41)]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", stats.normal_cdf("z").alias("p")).collect()
    assert max(abs(r["p"] - 0.5 * (1 + math.erf(r["z"] / math.sqrt(2)))) for r in rows) < 2e-7
    assert one(spark, stats.diffusion("z"), z=0.0) == 50.0


def test_pinball_prefers_the_tight_interval(spark):
    def loss(a, b, c):
        return one(spark, stats.mean_pinball(F.lit(100.0), F.lit(a), F.lit(b), F.lit(c)))

    assert loss(40.0, 100.0, 160.0) > loss(95.0, 100.0, 105.0)


def test_pearson_guards(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("b", 1.0, 3.0), ("c", 1.0, 2.0)], "k string, x double, y double")
    got = {r["k"]: r["r"] for r in df.groupBy("k").agg(stats.pearson(F.col("x"), F.col("y")).alias("r")).collect()}
    assert got["a"] == pytest.approx(1.0) and got["b"] is None and got["c"] is None


def test_upper_median_with_a_dominant_key_and_heavy_ties(spark):
    rng = random.Random(3)
    rows = [("hot", float(rng.choice([1, 2, 2, 2, 3, rng.randint(0, 5000)]))) for _ in range(30001)]
    rows += [(f"k{i % 5}", float(rng.randint(0, 9))) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {}
    for k in {r[0] for r in rows}:
        values = sorted(v for kk, v in rows if kk == k)
        want[k] = values[len(values) // 2]
    # In order at once, and after repeated narrowing.
    for steps, bound in ((1000, 100_000), (7, 3)):
        got = {r["k"]: r["median"] for r in stats.upper_median_by(df, ["k"], "v", steps=steps, bound=bound).collect()}
        assert got == want


def test_upper_median_keeps_null_keys_and_concentrated_values(spark):
    rng = random.Random(5)
    near = [(None, 1e9 if i == 0 else 1.0 + rng.random() / 1e6) for i in range(4001)]
    rows = near + [("a", None), ("a", 2.0), ("a", 1.0), ("b", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = stats.upper_median_by(df, ["k"], "v", count="n", steps=10, bound=5).collect()
    assert {r["k"]: (r["median"], r["n"]) for r in found} == {None: (sorted(v for _, v in near)[2000], 4001), "a": (2.0, 2), "b": (4.0, 1)}
