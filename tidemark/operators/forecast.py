"""Walk-forward-scored forecasts.

A baseline's prediction at a row depends only on the rows before it, so every
fold of every series comes out of one window pass: the prediction made at row
``t`` is simply read ``horizon + embargo`` rows later.  Only the nearest-
neighbour model and the quantiles of a growing past need more than a window
frame; they run as one pass per series, over an index that grows with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import join_null_safe, plain
from tidemark.functions.periods import by_cadence
from tidemark.functions.stats import mean_pinball, upper_median_by
from tidemark.operators.series import series_window, with_prefix_quantiles
from tidemark.schema import SERIES_KEY
from tidemark.session import cut_lineage

# Evaluation protocol.
BASELINES = ["drift", "random_walk", "seasonal_naive"]
SEASON = {"monthly": 12, "quarterly": 4, "annual": 1}
MIN_TRAIN = {"monthly": 48, "quarterly": 24, "annual": 10}
EMBARGO = {"monthly": 1, "quarterly": 1, "annual": 0}
SKILL_MARGIN = 0.05
MIN_FOLDS = 8
NEIGHBOURS = 12
NEIGHBOUR_EMBARGO = 12

_Q = [0.1, 0.5, 0.9]
_PREDICTION = "struct<model:string,p10:double,p50:double,p90:double,p_up:double,n_train:int>"


# --- Nearest neighbours within a series ------------------------------------------
def _shapes(v: np.ndarray) -> np.ndarray:
    """Relative shape of the last three steps ending at each position."""
    out = np.full((len(v), 3), np.nan)
    if len(v) > 3:
        base = np.abs(v[:-3])
        base = np.where(base == 0, 1.0, base)
        for k in (1, 2, 3):
            out[3:, k - 1] = (v[k : len(v) - 3 + k] - v[:-3]) / base
    return out


class VantageIndex:
    """Vectors added in order, searched for the nearest ones by exact pruning.

    Distances of every vector to a few vantage points are kept, the vectors in
    order of the first.  By the triangle inequality a vector can be among the
    nearest only if none of these distances differs from the query's by more
    than the distance of the ``k``-th found so far; only for such a vector is its
    distance computed.  What was added last is searched whole until it is merged.
    """

    def __init__(self, points: np.ndarray, merged: int = 64):
        self.points, self.size = points, merged
        self.position = np.zeros(0, np.int64)
        self.vectors, self.far = np.zeros((0, points.shape[1])), np.zeros((0, len(points)))
        self.new: list[tuple[int, np.ndarray]] = []
        self.computed = 0

    def add(self, position: int, vector: np.ndarray) -> None:
        self.new.append((position, vector))
        if len(self.new) >= self.size:
            vectors = np.array([v for _, v in self.new])
            far = np.sqrt(((vectors[:, None, :] - self.points[None]) ** 2).sum(axis=2))
            order = np.argsort(far[:, 0], kind="stable")
            at = np.searchsorted(self.far[:, 0], far[order, 0], "right")
            self.position = np.insert(self.position, at, np.array([p for p, _ in self.new])[order])
            self.vectors = np.insert(self.vectors, at, vectors[order], axis=0)
            self.far = np.insert(self.far, at, far[order], axis=0)
            self.new = []

    def _measure(self, vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
        self.computed += len(vectors)
        return np.sqrt(((vectors - vector) ** 2).sum(axis=1))

    def nearest(self, vector: np.ndarray, k: int) -> np.ndarray:
        """Positions of the ``k`` nearest, of equal distances the earlier first."""
        position = np.array([p for p, _ in self.new], np.int64)
        distance = self._measure(np.array([v for _, v in self.new]), vector) if self.new else np.zeros(0)
        if len(self.position):
            own = np.sqrt(((self.points - vector) ** 2).sum(axis=1))
            middle = int(np.searchsorted(self.far[:, 0], own[0]))
            low, high = max(0, middle - k), min(len(self.far), middle + k)
            near = slice(low, high)
            position = np.concatenate([position, self.position[near]])
            distance = np.concatenate([distance, self._measure(self.vectors[near], vector)])
            reach = np.partition(distance, k - 1)[k - 1] if len(distance) >= k else np.inf
            reach = reach * (1 + 1e-9) + 1e-300
            a, b = np.searchsorted(self.far[:, 0], own[0] - reach, "left"), np.searchsorted(self.far[:, 0], own[0] + reach, "right")
            rest = np.concatenate([np.arange(a, max(a, low)), np.arange(min(high, b), b)])
            rest = rest[(np.abs(self.far[rest, 1:] - own[1:]) <= reach).all(axis=1)]
            position = np.concatenate([position, self.position[rest]])
            distance = np.concatenate([distance, self._measure(self.vectors[rest], vector)])
        return position[np.lexsort((position, distance))[:k]]


def analog_predictions(
    v: np.ndarray, horizon: int, k: int, embargo: int, state: np.ndarray | None = None, counts: list[int] | None = None
) -> np.ndarray:
    """p10, p50, p90, p_up and number of candidates for every end position.

    Candidates enter a :class:`VantageIndex` once the horizon and the embargo
    have passed them.  ``counts`` collects the number of distances computed.
    """
    n = len(v)
    out = np.full((n, 5), np.nan)
    shape = _shapes(v) if state is None else state
    first = shape.shape[1] + 1
    with np.errstate(divide="ignore", invalid="ignore"):
        outcome = np.full(n, np.nan)
        if n > horizon:
            outcome[: n - horizon] = np.where(v[:-horizon] != 0, (v[horizon:] - v[:-horizon]) / np.abs(v[:-horizon]), np.nan)
    complete = ~np.isnan(shape).any(axis=1)
    usable = (np.arange(n) >= first) & ~np.isnan(outcome) & complete
    some = shape[complete & np.isfinite(shape).all(axis=1)]
    # vantage points: the corners of what is there and its middle
    points = np.array([some.min(axis=0), some.max(axis=0), np.median(some, axis=0)]) if len(some) else np.zeros((3, shape.shape[1]))
    index = VantageIndex(points)
    entered = added = 0
    rows, near = [], []
    for end in range(n):
        while entered <= min(end - horizon, end - embargo - 1):
            if usable[entered]:
                if np.isfinite(shape[entered]).all():  # an infinite one is near to none
                    index.add(entered, shape[entered])
                added += 1
            entered += 1
        if end + 1 >= horizon + embargo + 6 and complete[end] and added >= 4:
            rows.append(end)
            near.append(index.nearest(shape[end], k) if np.isfinite(shape[end]).all() else np.zeros(0, np.int64))
            out[end, 4] = added
    if counts is not None:
        counts.append(index.computed)
    if rows:
        width = max(1, *map(len, near))
        changes = np.array([np.pad(outcome[x], (0, width - len(x)), constant_values=np.nan) for x in near])
        out[rows, :3] = v[rows, None] * (1 + np.nanquantile(changes, _Q, axis=1).T)
        out[rows, 3] = (changes > 0).sum(axis=1) / (~np.isnan(changes)).sum(axis=1)
    return out


def with_analogs(
    series: DataFrame,
    horizons: Mapping[str, Sequence[int]],
    keys: Sequence[str] = SERIES_KEY,
    k: int = NEIGHBOURS,
    embargo: int = NEIGHBOUR_EMBARGO,
    state: str | None = None,
) -> DataFrame:
    """Add ``a_<horizon>``: [p10, p50, p90, p_up, candidates] at every row.

    ``horizons`` maps a cadence to its horizons.  ``state`` optionally names an
    array column to compare instead of the series' own recent shape.
    """
    every = sorted({h for hs in horizons.values() for h in hs})
    rest = [c for c in series.columns if c != state]
    fields = [series.schema[c] for c in rest]
    schema = T.StructType(fields + [T.StructField(f"a_{h}", T.ArrayType(T.DoubleType())) for h in every])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pidx", kind="stable").reset_index(drop=True)
        v = pdf["value"].to_numpy(dtype=float)
        vectors = None if state is None else np.array([np.asarray(x, dtype=float) for x in pdf[state]])
        own = horizons.get(pdf["cadence"].iloc[0], ())
        out = pdf[rest].copy()
        for h in every:
            if h in own:
                got = analog_predictions(v, h, k, embargo, vectors)
                out[f"a_{h}"] = [None if np.isnan(row[0]) else row.tolist() for row in got]
            else:
                out[f"a_{h}"] = None
        return plain(out)

    return series.groupBy(*keys).applyInPandas(run, schema)


# --- Baselines as prefix windows ---------------------------------------------------
def _errors(season: int, h: int, w, fix_horizon: bool) -> dict[str, Column]:
    n, v = F.col("n"), F.col("value")
    # The drift error extrapolates h steps from one row back; the fixed form
    # extrapolates from h rows back, so that its horizon is the one published.
    back = h if fix_horizon else 1
    step = (F.lag("value", back).over(w) - F.lag("value", back + season - 1).over(w)) / F.lit(float(max(season - 1, 1)))
    if season == 1:
        step = F.lit(0.0)
    return {
        "seasonal_naive": F.when(n > season + h, v - F.lag("value", season).over(w)),
        "random_walk": F.when(n > h, v - F.lag("value", h).over(w)),
        "drift": F.when(n > season + h, v - (F.lag("value", back).over(w) + step * F.lit(float(h)))),
    }


def _points(season: int, h: int, w) -> dict[str, Column]:
    n, v = F.col("n"), F.col("value")
    back = season - h if h <= season else season - 1
    slope = F.lit(0.0) if season == 1 else (v - F.lag("value", season - 1).over(w)) / F.lit(float(season - 1))
    seasonal = v if back == 0 else F.lag("value", back).over(w)
    return {
        "seasonal_naive": F.when(n >= season + h, seasonal),
        "random_walk": F.when(n >= h + 2, v),
        "drift": F.when(n >= max(season, h) + 2, v + slope * F.lit(float(h))),
    }


def with_baselines(
    series: DataFrame, horizons: Mapping[str, Sequence[int]], keys: Sequence[str] = SERIES_KEY, fix_horizon: bool = False
) -> DataFrame:
    """Add ``b_<cadence>_<horizon>``: the baseline predictions made at each row."""
    w = series_window(keys)
    prefix = w.rowsBetween(Window.unboundedPreceding, 0)
    combos = [(c, h) for c, hs in horizons.items() for h in hs]
    out = series.withColumn("n", F.row_number().over(w))
    errors, points = {}, {}
    for c, h in combos:
        for model, e in _errors(SEASON[c], h, w, fix_horizon).items():
            errors[f"_e_{c}_{h}_{model}"] = F.when(F.col("cadence") == c, e)
        for model, p in _points(SEASON[c], h, w).items():
            points[f"_p_{c}_{h}_{model}"] = F.when(F.col("cadence") == c, p)
    out = out.withColumns({**errors, **points})
    spread, up = {name.replace("_e_", "_q_", 1): name for name in errors}, {}
    for name in errors:
        up[name.replace("_e_", "_u_", 1)] = F.avg(F.when(F.col(name) > 0, 1.0).when(F.col(name).isNotNull(), 0.0)).over(prefix)
    out = with_prefix_quantiles(out.withColumns(up), spread, _Q, keys)
    packed = {}
    for c, h in combos:
        rows = []
        for model in BASELINES:
            tag = f"{c}_{h}_{model}"
            point, q = F.col(f"_p_{tag}"), F.col(f"_q_{tag}")
            rows.append(
                F.struct(
                    F.lit(model).alias("model"),
                    *[(point + F.coalesce(q[i], F.lit(0.0))).alias(name) for i, name in enumerate(("p10", "p50", "p90"))],
                    F.when(point.isNotNull(), F.col(f"_u_{tag}")).alias("p_up"),
                    F.col("n").cast("int").alias("n_train"),
                ).cast(_PREDICTION)
            )
        packed[f"b_{c}_{h}"] = F.array(*rows)
    scratch = [*errors, *points, *spread, *up]
    return out.withColumns(packed).drop(*scratch)


def predictions(
    series: DataFrame, horizons: Mapping[str, Sequence[int]], keys: Sequence[str] = SERIES_KEY, fix_horizon: bool = False, **analog
) -> DataFrame:
    """One row per observation with all models' predictions from it.

    ``preds`` is an array of (cadence, horizon, models); models refuse with NULL.
    """
    out = with_baselines(with_analogs(series, horizons, keys, **analog), horizons, keys, fix_horizon)
    arrays = {}
    for c, hs in horizons.items():
        for h in hs:
            a = F.col(f"a_{h}")
            near = F.struct(
                F.lit("analog").alias("model"), a[0].alias("p10"), a[1].alias("p50"), a[2].alias("p90"),
                a[3].alias("p_up"), a[4].cast("int").alias("n_train"),
            ).cast(_PREDICTION)
            arrays[f"m_{c}_{h}"] = F.concat(F.col(f"b_{c}_{h}"), F.array(near))
    keep = [c for c in series.columns if c in (*keys, "cadence", "pidx", "value")]
    return out.withColumns(arrays).select(*keep, "n", *arrays)


def walk_forward(
    predicted: DataFrame,
    horizons: Mapping[str, Sequence[int]],
    keys: Sequence[str] = SERIES_KEY,
    min_train: Mapping[str, int] = MIN_TRAIN,
    embargo: Mapping[str, int] = EMBARGO,
    align: bool = False,
) -> DataFrame:
    """Folds and the final prediction of every series, horizon and model.

    A fold's training ends ``embargo`` periods before its cut, yet it predicts
    ``horizon`` steps from there; with ``align`` it predicts ``horizon +
    embargo`` steps, for which ``predicted`` must hold those horizons too.

    ``kind`` is ``fold`` (a past prediction with its actual) or ``issue`` (the
    prediction from the newest observation).
    """
    w = series_window(keys)
    latest = F.lead("pidx").over(w).isNull()
    events = []
    for c, hs in horizons.items():
        for h in hs:
            gap = h + embargo[c]
            # Position of the cut is n - 1 - h; training ends `embargo` earlier.
            scored = (F.col("n") - 1 - h >= min_train[c]) & (F.col("n") - gap >= min_train[c])
            fold = F.struct(
                F.lit("fold").alias("kind"),
                F.lit(h).alias("horizon"),
                F.col("pidx").alias("for_pidx"),
                F.lag("pidx", gap).over(w).alias("from_pidx"),
                F.col("value").alias("actual"),
                F.lag("value", gap).over(w).alias("last_observed"),
                F.lag(f"m_{c}_{gap if align else h}", gap).over(w).alias("models"),
            )
            issue = F.struct(
                F.lit("issue").alias("kind"),
                F.lit(h).alias("horizon"),
                (F.col("pidx") + h).alias("for_pidx"),
                F.col("pidx").alias("from_pidx"),
                F.lit(None).cast("double").alias("actual"),
                F.col("value").alias("last_observed"),
                F.col(f"m_{c}_{h}").alias("models"),
            )
            mine = F.col("cadence") == c
            events.append(F.when(mine & scored, fold))
            events.append(F.when(mine & latest & (F.col("n") >= min_train[c] + h + 4), issue))
    flat = predicted.select(*keys, "cadence", "n", F.array_compact(F.array(*events)).alias("_events"))
    flat = flat.select(*keys, "cadence", "n", F.inline("_events"))
    out = flat.select(
        *keys, "cadence", "n", "kind", "horizon", "for_pidx", "from_pidx", "actual", "last_observed", F.inline("models")
    )
    return out.withColumn("pinball", mean_pinball("actual", "p10", "p50", "p90"))


def scores(walked: DataFrame, keys: Sequence[str] = SERIES_KEY, margin: float = SKILL_MARGIN, least: int = MIN_FOLDS) -> DataFrame:
    """Hold-out score, verdict and newest prediction per series, horizon and model."""
    usable = (F.col("kind") == "fold") & F.col("p50").isNotNull()
    inside = (F.col("actual") >= F.col("p10")) & (F.col("actual") <= F.col("p90"))
    newest = F.struct("n", "from_pidx", "for_pidx", "last_observed", "p10", "p50", "p90", "p_up", "n_train")
    agg = walked.groupBy(*keys, "cadence", "horizon", "model").agg(
        F.count_if(usable).alias("folds"),
        F.avg(F.when(usable, F.abs(F.col("actual") - F.col("p50")))).alias("mae"),
        F.avg(F.when(usable, F.col("pinball"))).alias("pinball"),
        F.avg(F.when(usable, F.when(inside, 1.0).otherwise(0.0))).alias("coverage_80"),
        F.max(F.when(F.col("kind") == "issue", newest)).alias("issue"),
    )
    agg = agg.where(F.col("folds") >= least)
    target = Window.partitionBy(*keys, "horizon")
    is_base = F.col("model").isin(BASELINES)
    best = F.min(F.when(is_base, F.col("pinball"))).over(target)
    best_mae = F.min(F.when(is_base, F.col("mae"))).over(target)
    out = agg.withColumn("pinball_ratio", F.try_divide("pinball", best)).withColumn("mae_ratio", F.try_divide("mae", best_mae))
    ratio = F.col("pinball_ratio")
    return out.withColumn(
        "verdict",
        F.when(is_base, "baseline")
        .when(ratio.isNull(), "insufficient_data")
        .when(ratio < 1 - margin, "beats_baseline")
        .otherwise("no_better_than_baseline"),
    )


def choose(scored: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Model allowed to publish: the best skilled one, else the best baseline."""
    tier = F.when(F.col("verdict") == "beats_baseline", 0).when(F.col("verdict") == "baseline", 1)
    rest = F.struct("model", "verdict", "pinball", "pinball_ratio", "folds", "issue")
    out = scored.where(tier.isNotNull()).groupBy(*keys, "cadence", "horizon").agg(
        F.min_by(rest, F.struct(tier, "pinball", "model")).alias("c")
    )
    return out.select(*keys, "cadence", "horizon", "c.*")


def issue(chosen: DataFrame, targets: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Forecast records of all declared targets over all their series.

    ``targets`` is the literal table (target_id, metric_id, horizon,
    direction_only); direction-only targets carry no quantiles.
    """
    rows = chosen.where(F.col("issue").isNotNull()).join(targets, ["metric_id", "horizon"])
    shown = ~F.col("direction_only")
    return rows.select(
        "target_id",
        *keys,
        "cadence",
        "horizon",
        F.col("issue.from_pidx").alias("from_pidx"),
        F.col("issue.for_pidx").alias("for_pidx"),
        F.col("issue.last_observed").alias("last_observed"),
        "model",
        F.col("verdict").alias("model_verdict"),
        *[F.when(shown, F.col(f"issue.{q}")).alias(q) for q in ("p10", "p50", "p90")],
        F.col("issue.p_up").alias("p_up"),
        "folds",
        "pinball_ratio",
    )


def target_status(series: DataFrame, targets: DataFrame, keys: Sequence[str] = SERIES_KEY, min_train: Mapping[str, int] = MIN_TRAIN) -> DataFrame:
    """Whether each series is long enough for each target."""
    sizes = series.groupBy(*keys, "cadence").agg(F.count("value").alias("observations"))
    need = by_cadence("cadence", dict(min_train)) + F.col("horizon") + 4
    out = sizes.join(targets, "metric_id").withColumn("needed", need)
    return out.withColumn("status", F.when(F.col("observations") < F.col("needed"), "insufficient_data").otherwise("evaluated"))


# --- After the fact ------------------------------------------------------------------
def score_matured(frozen: DataFrame, actuals: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Score frozen forecasts whose outcome has been published.

    ``done`` holds the keys already scored; they are never scored again.
    """
    open_ = frozen if done is None else frozen.join(done, ["target_id", "geo_id", "from_pidx"], "left_anti")
    real = actuals.select("metric_id", "geo_id", F.col("pidx").alias("for_pidx"), F.col("value").alias("actual"))
    out = open_.join(real, ["metric_id", "geo_id", "for_pidx"])
    error = F.col("actual") - F.col("p50")
    up = F.col("actual") > F.col("last_observed")
    return out.select(
        "target_id", "metric_id", "geo_id", "from_pidx", "for_pidx", "model", "p50", "actual",
        F.abs(error).alias("abs_error"),
        F.try_divide(error * 100, F.when(F.col("p50") != 0, F.abs("p50"))).alias("pct_error"),
        ((F.col("actual") >= F.col("p10")) & (F.col("actual") <= F.col("p90"))).cast("int").alias("inside_80"),
        ((F.col("p_up") > 0.5) == up).cast("int").alias("direction_correct"),
    )


def track_record(frozen: DataFrame, scored: DataFrame) -> DataFrame:
    """Every frozen forecast with its score, or pending."""
    marks = scored.select("target_id", "geo_id", "from_pidx", "actual", "pct_error", "inside_80", "direction_correct")
    out = frozen.join(marks, ["target_id", "geo_id", "from_pidx"], "left")
    return out.withColumn("pending", F.col("actual").isNull())


def record_summary(record: DataFrame, keys: Sequence[str] = ("target_id",)) -> DataFrame:
    out = record.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frozen"),
        F.count_if("pending").alias("pending"),
        F.avg("inside_80").alias("coverage"),
        F.avg("direction_correct").alias("direction_accuracy"),
    )
    errors = cut_lineage(record.select(*keys, F.abs("pct_error").alias("_e")))  # read twice
    errors = upper_median_by(errors, list(keys), "_e", out="median_abs_pct")
    return join_null_safe(out, errors, list(keys), "left")


def growth_ranking(now: DataFrame, then: DataFrame, group: str, item: str) -> DataFrame:
    """Spearman agreement per group between two rankings of the same items."""
    from tidemark.functions.stats import pearson

    both = now.select(group, item, F.col("value").alias("_a")).join(then.select(group, item, F.col("value").alias("_b")), [group, item])

    def ranks(c: str) -> Column:
        return (
            F.rank().over(Window.partitionBy(group).orderBy(c))
            + (F.count(F.lit(1)).over(Window.partitionBy(group, c)) - 1) / F.lit(2.0)
        ).cast("double")

    ranked = both.withColumns({"_ra": ranks("_a"), "_rb": ranks("_b")})
    return ranked.groupBy(group).agg(F.count(F.lit(1)).alias("items"), pearson(F.col("_ra"), F.col("_rb")).alias("spearman"))
