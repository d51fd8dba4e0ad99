"""Does one series lead another?  Lag search on training data, judged on a hold-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import STEPS_PER_YEAR
from tidemark.functions.stats import pearson, upper_median
from tidemark.operators.series import at_offset, percent_change, series_window, year_before

# Search depth, hold-out length, least history and thresholds.
MAX_LAG = 12
HOLDOUT = 12
MIN_OBSERVATIONS = 30
MIN_PAIRS = 6
MIN_STRENGTH = 0.3

# The declared signal and outcome pairs.
DECLARED_PAIRS = [
    ("wiki_city_attention", "hotel_nights"),
    ("wiki_city_attention", "airport_flights"),
    ("wiki_city_foreign_share", "hotel_travellers"),
    ("wiki_city_attention", "population_padron"),
    ("wiki_hardship_index", "foreclosures"),
    ("wiki_hardship_index", "evictions"),
    ("wiki_hardship_index", "unemployment_registered"),
    ("wiki_relocation_index", "population_padron"),
    ("news_volume", "housing_transactions"),
    ("news_tone", "unemployment_registered"),
    ("airport_flights", "airport_passengers"),
    ("airport_flights", "hotel_nights"),
    ("contracts_registered", "affiliations"),
    ("property_transfers", "housing_transactions"),
    ("mortgages_count", "appraised_value"),
    ("euribor_12m", "mortgages_count"),
    ("unemployment_registered", "foreclosures"),
    ("locales_closures", "unemployment_registered"),
    ("horeca_openings", "affiliations"),
    ("str_listings", "rent_reference"),
]

KEY = ["place", "signal", "outcome", "cadence"]


def aligned(series: DataFrame, pairs: DataFrame, cadences: Sequence[str] = ("monthly",)) -> DataFrame:
    """Both sides of every declared pair on one row per period.

    ``series`` carries ``place, metric_id, cadence, pidx, value``; ``pairs`` is
    the literal table (signal, outcome).  ``x`` and ``y`` are year-over-year
    changes, ``seasonal`` is the outcome's change one year earlier.
    """
    own = series_window(("place", "metric_id"))
    changes = series.select(
        "place",
        "metric_id",
        "cadence",
        "pidx",
        percent_change(F.col("value"), year_before("value", own, cadences)).alias("yoy"),
        year_before("value", own, cadences).alias("_prior"),
    )
    last_year = None
    for c in cadences:
        hit, prior = F.col("cadence") == c, at_offset("yoy", -STEPS_PER_YEAR[c], own)
        last_year = F.when(hit, prior) if last_year is None else last_year.when(hit, prior)
    changes = changes.withColumn("_seasonal", F.when(F.col("_prior") != 0, last_year))
    small = pairs
    signal = changes.join(small.withColumnRenamed("signal", "metric_id"), "metric_id").select(
        "place", F.col("metric_id").alias("signal"), "outcome", "cadence", "pidx",
        F.col("yoy").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("seasonal"),
    )
    outcome = changes.join(small.withColumnRenamed("outcome", "metric_id"), "metric_id").select(
        "place", "signal", F.col("metric_id").alias("outcome"), "cadence", "pidx",
        F.lit(None).cast("double").alias("x"), F.col("yoy").alias("y"), F.col("_seasonal").alias("seasonal"),
    )
    return signal.unionByName(outcome).groupBy(*KEY, "pidx").agg(
        F.max("x").alias("x"), F.max("y").alias("y"), F.max("seasonal").alias("seasonal")
    )


def with_split(rows: DataFrame, holdout: int | None = HOLDOUT) -> DataFrame:
    """Mark held-out rows: the newest ``holdout`` periods with an outcome, or all of them (None)."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("pidx").desc())
    whole = Window.partitionBy(*KEY)
    counted = rows.withColumn("_rank", F.count("y").over(newest.rowsBetween(Window.unboundedPreceding, 0)))
    return counted.select(
        *KEY, "pidx", "x", "y", "seasonal",
        F.count("x").over(whole).alias("n_signal"),
        F.count("y").over(whole).alias("n_outcome"),
        (F.col("y").isNotNull() & (F.lit(True) if holdout is None else F.col("_rank") <= holdout)).alias("held_out"),
    )


def lag_table(rows: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Correlations of every lag, on training and on held-out periods.

    The signal ``lag`` periods earlier is a RANGE look-up on the row of the
    outcome, so no self-join is formed and pairs are never multiplied out
    across a shuffle.
    """
    w = series_window(KEY)
    lags = F.array(*[F.struct(F.lit(n).alias("lag"), at_offset("x", -n, w).alias("_x")) for n in range(max_lag + 1)])
    spread = rows.select("*", lags.alias("_lags")).where(F.col("y").isNotNull())
    flat = spread.select(*KEY, "y", "held_out", "n_signal", "n_outcome", F.inline("_lags"))
    train_x = F.when(~F.col("held_out"), F.col("_x"))
    test_x = F.when(F.col("held_out"), F.col("_x"))
    return flat.groupBy(*KEY, "lag").agg(
        F.round(pearson(train_x, F.col("y")), 4).alias("train_r"),
        F.round(pearson(test_x, F.col("y")), 4).alias("test_r"),
        F.count(test_x).alias("n_test"),
        F.max("n_signal").alias("n_signal"),
        F.max("n_outcome").alias("n_outcome"),
    )


def evaluate(
    series: DataFrame,
    pairs: DataFrame,
    cadences: Sequence[str] = ("monthly",),
    max_lag: int = MAX_LAG,
    holdout: int = HOLDOUT,
    least: int = MIN_OBSERVATIONS,
) -> DataFrame:
    """Verdict per place and declared pair, in each cadence that the outcome has there.

    Series of different cadence never pair and read as insufficient data, and so
    does a pair without any outcome at a place (its cadence is NULL).
    """
    rows = with_split(aligned(series, pairs, cadences), holdout)
    usable = (F.col("n_signal") >= least) & (F.col("n_outcome") >= least) & (F.col("n_outcome") > holdout)
    lags = lag_table(rows, max_lag)
    strength = F.when(usable & (F.abs("train_r") > 0), F.abs("train_r"))
    best = lags.groupBy(*KEY).agg(
        F.max_by(
            F.struct("lag", "train_r", "test_r", "n_test"),
            F.when(strength.isNotNull(), F.struct(strength, -F.col("lag"))),
        ).alias("b"),
        F.max(usable).alias("usable"),
    )
    baseline = rows.groupBy(*KEY).agg(
        F.round(pearson(F.when(F.col("held_out"), F.col("seasonal")), F.col("y")), 4).alias("baseline_r")
    )
    found = F.col("b").isNotNull()
    tested = best.join(baseline, KEY)
    # The declared pairs are a table given in code; each place gets every one of them.
    declared = [F.struct(F.lit(p["signal"]).alias("signal"), F.lit(p["outcome"]).alias("outcome")) for p in pairs.select("signal", "outcome").distinct().collect()]
    every = series.select("place").distinct().select("place", F.inline(F.array(*declared)))
    out = every.join(tested, ["place", "signal", "outcome"], "left").select(
        *KEY,
        F.col("b.lag").alias("best_lag"),
        F.col("b.train_r").alias("in_sample_r"),
        F.col("b.test_r").alias("holdout_r"),
        F.when(found, F.col("baseline_r")).alias("baseline_r"),
        F.coalesce("b.n_test", F.lit(0)).alias("observations"),
    )
    return out.withColumn("verdict", verdict())


def verdict():
    r, base = F.abs("holdout_r"), F.abs("baseline_r")
    return (
        F.when(F.col("holdout_r").isNull() | (F.col("observations") < MIN_PAIRS), "insufficient_data")
        .when(r < MIN_STRENGTH, "no_evidence")
        .when(base.isNotNull() & (r <= base), "no_evidence")
        .when(F.col("best_lag") > 0, "leading")
        .otherwise("coincident")
    )


def pair_summary(results: DataFrame) -> DataFrame:
    """Per pair: how many places tested it, in how many it leads, median lag."""
    out = results.groupBy("signal", "outcome").agg(
        F.count_if(F.col("verdict") != "insufficient_data").alias("tested"),
        F.count_if(F.col("verdict") == "leading").alias("leading"),
        upper_median("CASE WHEN verdict = 'leading' THEN best_lag END").alias("median_lag"),
    )
    need = F.greatest(F.lit(2), F.floor(F.col("tested") / F.lit(2.0)))
    return out.withColumn(
        "verdict",
        F.when(F.col("leading") >= need, "leading")
        .when(F.col("tested") > 0, "no_evidence")
        .otherwise("insufficient_data"),
    )
