"""Ordered threshold rules and the hysteresis that holds sticky states.

Rules are data: ``(rule_id, label, [predicate, ...])`` in priority order.  A
predicate is Spark SQL over index columns and ``delta_<index>_<n>`` columns;
the predicates of a rule are joined by AND, and one that meets a missing value
is false.  A predicate in ``("not", text)`` form is negated after that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import at_offset, series_window

# The published rule sets.
INDEX_IDS = ["demand_momentum", "housing_pressure", "supply_response", "distress"]
STICKY = ["stress", "dislocation"]
HYSTERESIS = 2
DELTA_STEPS = [1, 2, 3, 4, 12]

REGIMES_V1 = [
    ("dislocation", "Dislocation", ["distress > 2.0", "demand_momentum < -1.0"]),
    ("stress", "Stress", ["distress > 1.0"]),
    ("hot_decelerating", "Hot but decelerating", ["housing_pressure > 1.0", "delta_housing_pressure_2 < 0"]),
    ("orderly_cooling", "Orderly cooling", ["housing_pressure < 0", "distress <= 0.5", "demand_momentum > -0.5"]),
    ("expansion", "Expansion", ["demand_momentum > 0.5", "distress < 0.5"]),
    ("neutral", "No clear regime", []),
]
REGIMES_V2 = [
    ("dislocation", "Dislocation", ["distress > 2.0", "demand_momentum < -1.0"]),
    ("stress", "Stress", ["distress > 1.0"]),
    ("hot_decelerating", "Hot but decelerating", ["housing_pressure > 0.75", "delta_housing_pressure_2 < 0"]),
    ("supply_squeeze", "Pressure without supply", ["housing_pressure > 0.75", "supply_response < -0.25"]),
    ("hot", "Hot", ["housing_pressure > 0.75"]),
    ("orderly_cooling", "Orderly cooling", ["housing_pressure < 0", "distress <= 0.5", "demand_momentum > -0.5"]),
    ("expansion", "Expansion", ["demand_momentum > 0.5", "distress < 0.5"]),
    ("neutral", "No clear regime", []),
]
REGIMES_V3 = [
    ("dislocation", "Dislocation", ["distress > 2.0", "demand_momentum < -1.0"]),
    ("stress", "Stress", ["distress > 1.0"]),
    ("hot_decelerating", "Hot but decelerating", ["housing_pressure > 0.75", "delta_housing_pressure_2 < 0"]),
    ("cooling_reversing", "Cheap but tightening", ["housing_pressure < -0.75", "delta_housing_pressure_2 > 0"]),
    ("supply_squeeze", "Pressure without supply", ["housing_pressure > 0.75", "supply_response < -0.25"]),
    ("supply_catching_up", "Supply catching up", ["housing_pressure < -0.75", "supply_response > 0.25"]),
    ("hot", "Hot", ["housing_pressure > 0.75"]),
    ("affordability_improving", "Easing", ["housing_pressure < -0.75"]),
    ("orderly_cooling", "Orderly cooling", ["housing_pressure < 0", "distress <= 0.5", "demand_momentum > -0.5"]),
    ("expansion", "Expansion", ["demand_momentum > 0.5", "distress < 0.5"]),
    ("neutral", "No clear regime", []),
]
RULESETS = {"regimes-v1": REGIMES_V1, "regimes-v2": REGIMES_V2, "regimes-v3": REGIMES_V3}


def predicate(spec: str | tuple[str, str]) -> Column:
    if isinstance(spec, tuple):
        return ~F.coalesce(F.expr(spec[1]), F.lit(False))
    return F.coalesce(F.expr(spec), F.lit(False))


def rule_condition(predicates: Sequence[str | tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [predicate(p) for p in predicates], F.lit(True))


def classify(rules: Sequence[tuple]) -> Column:
    """First matching rule id.  The last rule must have no predicates."""
    if rules[-1][2]:
        raise ValueError("the last rule must always match")
    out = None
    for rule_id, _, predicates in rules:
        hit = rule_condition(predicates)
        out = F.when(hit, rule_id) if out is None else out.when(hit, rule_id)
    return out


def label_of(rule_id: Column, rules: Sequence[tuple]) -> Column:
    out = None
    for rid, label, _ in rules:
        out = F.when(rule_id == rid, label) if out is None else out.when(rule_id == rid, label)
    return out


def wide_indices(history: DataFrame, index_ids: Sequence[str] = INDEX_IDS) -> DataFrame:
    """One row per place and month with a column per index."""
    return history.groupBy("place", "month").agg(
        *[F.max(F.when(F.col("index_id") == i, F.col("value"))).alias(i) for i in index_ids]
    )


def with_deltas(wide: DataFrame, index_ids: Sequence[str] = INDEX_IDS, steps: Sequence[int] = DELTA_STEPS) -> DataFrame:
    """Change of every index over each step, by exact month."""
    w = series_window(("place",), "month")
    return wide.select(
        "*", *[(F.col(i) - at_offset(i, -n, w)).alias(f"delta_{i}_{n}") for i in index_ids for n in steps]
    )


def present(index_ids: Sequence[str] = INDEX_IDS) -> Column:
    return reduce(lambda a, b: a + b, [F.col(i).isNotNull().cast("int") for i in index_ids])


def verdicts(
    history: DataFrame, rules: Sequence[tuple] = REGIMES_V3, index_ids: Sequence[str] = INDEX_IDS
) -> DataFrame:
    """Unheld verdict of every place and month with at least two indices."""
    wide = with_deltas(wide_indices(history, index_ids), index_ids)
    judged = wide.where(present(index_ids) >= 2).withColumn("verdict", classify(rules))
    return judged.select("place", "month", *index_ids, "verdict")


def hold(
    judged: DataFrame,
    sticky: Sequence[str] = STICKY,
    hysteresis: int = HYSTERESIS,
    rules: Sequence[tuple] = REGIMES_V3,
) -> DataFrame:
    """Timeline in which a sticky state ends only after consecutive contrary verdicts.

    An ordered fold over each place's months (a calendar-bounded array), inside
    the JVM.
    """
    rest = [c for c in judged.columns if c not in ("place", "verdict")]
    months = F.sort_array(F.collect_list(F.struct("month", "verdict", *[c for c in rest if c != "month"])))
    folded = judged.groupBy("place").agg(months.alias("_m"))
    states = F.array(*[F.lit(s) for s in sticky])

    def step(acc: Column, m: Column) -> Column:
        leaving = F.array_contains(states, acc["held"]) & (m["verdict"] != acc["held"])
        keeps = leaving & (acc["streak"] + 1 < hysteresis)
        state = F.when(keeps, acc["held"]).otherwise(m["verdict"])
        return F.struct(
            state.alias("held"),
            F.when(keeps, acc["streak"] + 1).otherwise(F.lit(0)).alias("streak"),
            F.concat(acc["out"], F.array(F.struct(state.alias("rule_id"), keeps.alias("held_by_hysteresis")))).alias("out"),
        )

    start = F.struct(
        F.lit("").alias("held"),
        F.lit(0).alias("streak"),
        F.array().cast("array<struct<rule_id:string,held_by_hysteresis:boolean>>").alias("out"),
    )
    run = folded.select("place", "_m", F.aggregate("_m", start, step, lambda a: a["out"]).alias("_s"))
    flat = run.select("place", F.inline(F.arrays_zip("_m", "_s")))
    return flat.select(
        "place",
        *[F.col(f"_m.{c}").alias(c) for c in rest],
        F.col("_m.verdict").alias("verdict"),
        F.col("_s.rule_id").alias("rule_id"),
        label_of(F.col("_s.rule_id"), rules).alias("label"),
        F.col("_s.held_by_hysteresis").alias("held_by_hysteresis"),
    )


def summary(current: DataFrame, history: DataFrame, rules: Sequence[tuple] = REGIMES_V3, index_ids: Sequence[str] = INDEX_IDS) -> DataFrame:
    """Regime now: inputs, how many are available, confidence and period.

    Levels are the current indices; each delta runs from the newest month of
    that index's own history.
    """
    now = current.groupBy("place").agg(
        *[F.max(F.when(F.col("index_id") == i, F.col("value"))).alias(i) for i in index_ids],
        F.max("month").alias("month"),
        F.count("value").alias("available"),
    )
    w = series_window(("place", "index_id"), "month")
    moves = history.select("place", "index_id", "month", *[(F.col("value") - at_offset("value", -n, w)).alias(f"d{n}") for n in DELTA_STEPS])
    newest = moves.groupBy("place", "index_id").agg(F.max_by(F.struct(*[f"d{n}" for n in DELTA_STEPS]), "month").alias("d"))
    deltas = newest.groupBy("place").agg(
        *[
            F.max(F.when(F.col("index_id") == i, F.col(f"d.d{n}"))).alias(f"delta_{i}_{n}")
            for i in index_ids
            for n in DELTA_STEPS
        ]
    )
    judged = now.join(deltas, "place", "left").withColumn("rule_id", classify(rules))
    return judged.select(
        "place",
        "month",
        *index_ids,
        "available",
        (F.col("available") >= 3).alias("confident"),
        "rule_id",
        label_of(F.col("rule_id"), rules).alias("label"),
    )


