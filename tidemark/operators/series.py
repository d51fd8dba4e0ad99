"""Window kernel over period-indexed series.

A series is the set of rows sharing ``keys`` (by default metric and geography)
with at most one row per period, so a window partition is bounded by the
calendar, never by the size of the raw facts.  Every calendar look-up is a
RANGE frame on ``pidx`` and every row look-back a ROWS frame, all on one window
specification: one exchange and one sort serve all of them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.frames import join_null_safe, plain
from tidemark.functions.periods import MIN_HISTORY, STEPS_PER_YEAR, by_cadence, first_month, last_month
from tidemark.functions.stats import clip
from tidemark.schema import SERIES_KEY


def series_window(keys: Sequence[str] = SERIES_KEY, order: str = "pidx") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


# --- Column builders ----------------------------------------------------------
def at_offset(value: str, n: int, w: WindowSpec) -> Column:
    """The value exactly ``n`` periods away on the calendar (negative is past)."""
    return F.first(F.col(value)).over(w.rangeBetween(n, n))


def year_before(value: str, w: WindowSpec, cadences: Sequence[str]) -> Column:
    """The value exactly one year earlier, for the cadences present."""
    out = None
    for name in cadences:
        hit = F.col("cadence") == name
        prior = at_offset(value, -STEPS_PER_YEAR[name], w)
        out = F.when(hit, prior) if out is None else out.when(hit, prior)
    return out


def percent_change(now: Column, base: Column) -> Column:
    """Percent change on the magnitude of the base; NULL on a missing or zero base."""
    return F.try_divide(F.lit(100.0) * (now - base), F.when(base != 0, F.abs(base)))


def rolling(value: str, n: int, w: WindowSpec, how: str = "mean") -> Column:
    """Mean or sum over ``n`` consecutive rows; NULL until the window is full."""
    frame = w.rowsBetween(-(n - 1), 0)
    total = F.avg(value).over(frame) if how == "mean" else F.sum(value).over(frame)
    return F.when(F.count(value).over(frame) == n, total)


class OrderedBlocks:
    """Numbers in order, in blocks of bounded size: adding one and reading some by rank costs little at any length."""

    def __init__(self, size: int = 1024):
        self.size, self.blocks, self.tops, self.n = size, [[]], [], 0

    def add(self, x: float) -> None:
        at = min(bisect_left(self.tops, x), len(self.blocks) - 1)
        block = self.blocks[at]
        insort(block, x)
        self.n += 1
        if len(block) >= 2 * self.size:
            half = len(block) // 2
            self.blocks[at : at + 1] = [block[:half], block[half:]]
            self.tops[at : at + 1] = [block[half - 1], block[-1]]
        elif at < len(self.tops):
            self.tops[at] = block[-1]
        else:
            self.tops.append(block[-1])

    def at(self, ranks: Sequence[int]) -> list[float]:
        """The numbers at ascending ranks, in one walk over the blocks."""
        out, before = [], 0
        blocks = iter(self.blocks)
        block = next(blocks)
        for rank in ranks:
            while rank - before >= len(block):
                before += len(block)
                block = next(blocks)
            out.append(block[rank - before])
        return out


def prefix_quantiles(values: np.ndarray, levels: Sequence[float]) -> list[list[float] | None]:
    """Interpolated quantiles of all present values up to each place; NULL before the first.

    NaN counts as missing.  The order statistics are carried along, so n places
    cost about n log n.
    """
    held, out, last = OrderedBlocks(), [], None
    for x in np.asarray(values, float).tolist():
        if x == x:
            held.add(x)
            places = [(held.n - 1) * q for q in levels]
            ranks = sorted({r for p in places for r in (int(p), min(int(p) + 1, held.n - 1))})
            found = dict(zip(ranks, held.at(ranks)))
            last = []
            for p in places:
                low, high = int(p), min(int(p) + 1, held.n - 1)
                last.append(found[low] if p == low else (low + 1 - p) * found[low] + (p - low) * found[high])
        out.append(last)
    return out


def with_prefix_quantiles(df: DataFrame, columns: Mapping[str, str], levels: Sequence[float], keys: Sequence[str] = SERIES_KEY, order: str = "pidx") -> DataFrame:
    """Add arrays of quantiles of a column over its row and all rows before it, by new name and column."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in columns]])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        for new, column in columns.items():
            out[new] = prefix_quantiles(out[column].to_numpy(dtype=float), levels)
        return plain(out)

    return df.groupBy(*keys).applyInPandas(run, schema)


def expanding_z(value: str, w: WindowSpec, min_history: Column | int, bound: float = 4.0) -> Column:
    """Score against all strictly earlier rows (population spread), clipped."""
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    spread = F.stddev_pop(value).over(past)
    need = F.lit(min_history) if isinstance(min_history, int) else min_history
    score = F.try_divide(F.col(value) - F.avg(value).over(past), F.when(spread != 0, spread))
    return F.when(F.count(value).over(past) >= need, clip(score, bound))


def with_outlier_score(
    df: DataFrame, value: str = "value", keys: Sequence[str] = SERIES_KEY, window: int = 12, least: int = 6, out: str = "outlier"
) -> DataFrame:
    """Distance from the median of the previous rows, in scaled MADs.

    The frame holds at most ``window`` values.  Median and MAD are separate
    projections so that neither is formed again per element.
    """
    frame = series_window(keys).rowsBetween(-window, -1)
    past = df.withColumn("_past", F.collect_list(value).over(frame))
    centred = past.withColumn("_past", F.sort_array("_past")).withColumn("_median", _middle(F.col("_past")))
    spread = centred.withColumn("_dev", F.sort_array(F.transform("_past", lambda x: F.abs(x - F.col("_median")))))
    mad = _middle(F.col("_dev"))
    score = F.try_divide(F.abs(F.col(value) - F.col("_median")), F.when(mad != 0, F.lit(1.4826) * mad))
    return spread.withColumn(out, F.when(F.size("_past") >= least, score)).drop("_past", "_median", "_dev")


def _middle(ordered: Column) -> Column:
    """Interpolated median of a sorted array."""
    n = F.size(ordered)
    low, high = F.floor((n - 1) / F.lit(2.0)).cast("int"), F.floor(n / F.lit(2.0)).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / F.lit(2.0)


# --- Transforms ---------------------------------------------------------------
def yoy(df: DataFrame, cadences: Sequence[str] = ("monthly",), keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Year-over-year percent change; rows without a base are dropped."""
    w = series_window(keys)
    changed = df.withColumn("yoy", percent_change(F.col("value"), year_before("value", w, cadences)))
    return changed.where(F.col("yoy").isNotNull())


def change(df: DataFrame, n: int, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Absolute change over ``n`` periods of the series' own cadence."""
    w = series_window(keys)
    return df.withColumn("change", F.col("value") - at_offset("value", -n, w)).where(F.col("change").isNotNull())


# Name -> Column builder over (window, cadences present).  Users may add theirs.
TRANSFORMS = {
    "level": lambda w, cadences: F.col("value"),
    "yoy": lambda w, cadences: percent_change(F.col("value"), year_before("value", w, cadences)),
    "change_12": lambda w, cadences: F.col("value") - at_offset("value", -12, w),
    "change_4": lambda w, cadences: F.col("value") - at_offset("value", -4, w),
    "roll_3": lambda w, cadences: rolling("value", 3, w),
    "roll_12": lambda w, cadences: rolling("value", 12, w),
}


def transformed(
    df: DataFrame,
    names: Sequence[str],
    cadences: Sequence[str] = ("monthly",),
    keys: Sequence[str] = SERIES_KEY,
) -> DataFrame:
    """Long table with one row per (series, period, transform) that has a value.

    All requested transforms are computed in the same window pass and then
    unpivoted inside the partition.
    """
    w = series_window(keys)
    wide = df
    for name in names:
        wide = wide.withColumn(f"t_{name}", TRANSFORMS[name](w, cadences))
    pairs = F.array(*[F.struct(F.lit(n).alias("transform"), F.col(f"t_{n}").alias("raw")) for n in names])
    rest = [c for c in df.columns]
    return (
        wide.select(*rest, F.inline(pairs))
        .where(F.col("raw").isNotNull())
    )


def zscored(
    df: DataFrame,
    keys: Sequence[str] = (*SERIES_KEY, "transform"),
    value: str = "raw",
    min_history: Column | int | None = None,
    bound: float = 4.0,
) -> DataFrame:
    """Add ``z``; by default the minimum history follows the cadence."""
    need = by_cadence("cadence", MIN_HISTORY) if min_history is None else min_history
    return df.withColumn("z", expanding_z(value, series_window(keys), need, bound))


def to_months(df: DataFrame, keys: Sequence[str] = SERIES_KEY, value_columns: Sequence[str] = ("value",)) -> DataFrame:
    """Project each observation onto the months it covers (column ``month``).

    Weekly and daily readings that end in one month compete for it: the latest
    wins, found with ``lead`` so that no second exchange is needed.
    """
    ends = df.withColumn("_m", last_month("pidx", "cadence"))
    nxt = F.lead("_m").over(series_window(keys))
    kept = ends.withColumn("_next", nxt).where(F.col("_next").isNull() | (F.col("_next") != F.col("_m")))
    months = F.explode(F.sequence(first_month("pidx", "cadence"), F.col("_m"))).alias("month")
    rest = [c for c in df.columns if c not in ("pidx", "cadence", *value_columns)]
    return kept.select(*rest, months, *value_columns)


# --- Alignment of two series --------------------------------------------------
def ratio(num: DataFrame, den: DataFrame, on: Sequence[str] = ("geo_id", "pidx"), scale: float = 1.0) -> DataFrame:
    """Divide two series period by period; a missing or zero base drops the row."""
    base = den.select(*on, F.col("value").alias("_den"))
    out = num.join(base, list(on)).where(F.col("_den") != 0)
    return out.withColumn("value", F.lit(scale) * F.col("value") / F.col("_den")).drop("_den")


def ratio_of_metrics(
    df: DataFrame, num: str, den: str, keys: Sequence[str] = ("geo_id", "pidx"), scale: float = 1.0
) -> DataFrame:
    """Same as :func:`ratio` for two metrics of one table, without a join."""
    wide = df.where(F.col("metric_id").isin(num, den)).groupBy(*keys).agg(
        F.max(F.when(F.col("metric_id") == num, F.col("value"))).alias("_num"),
        F.max(F.when(F.col("metric_id") == den, F.col("value"))).alias("_den"),
    )
    kept = wide.where(F.col("_num").isNotNull() & (F.col("_den") != 0))
    return kept.select(*keys, (F.lit(scale) * F.col("_num") / F.col("_den")).alias("value"))


def carry_denominator(
    num: DataFrame, den: DataFrame, max_gap: int, keys: Sequence[str] = ("geo_id",), scale: float = 1.0
) -> DataFrame:
    """As-of division with a tolerance.

    Each numerator row uses the denominator of its own period, else the latest
    one at most ``max_gap`` periods earlier.  A denominator of a slower cadence
    is first projected with :func:`to_months`; without that only equal
    cadences meet.  Both sides are stacked and read
    through one RANGE frame, so no range join is formed.
    """
    extra = [c for c in num.columns if c not in (*keys, "pidx", "value")]
    left = num.select(*keys, "pidx", *extra, "value", F.lit(None).cast("double").alias("_den"), F.lit(True).alias("_n"))
    right = den.select(
        *keys,
        "pidx",
        *[F.lit(None).cast(num.schema[c].dataType).alias(c) for c in extra],
        F.lit(None).cast("double").alias("value"),
        F.col("value").alias("_den"),
        F.lit(False).alias("_n"),
    )
    frame = series_window(keys).rangeBetween(-max_gap, 0)
    both = left.unionByName(right).withColumn("_base", F.last("_den", ignorenulls=True).over(frame))
    kept = both.where(F.col("_n") & F.col("value").isNotNull() & (F.col("_base") != 0))
    return kept.withColumn("value", F.lit(scale) * F.col("value") / F.col("_base")).drop("_den", "_n", "_base")


# --- Selection ------------------------------------------------------------------
def latest(df: DataFrame, keys: Sequence[str] = SERIES_KEY, order: str = "pidx") -> DataFrame:
    """Newest row of each series, as a map-side combinable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def tail(df: DataFrame, n: int, keys: Sequence[str] = SERIES_KEY, order: str = "pidx") -> DataFrame:
    """The newest ``n`` rows of each series."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def fill_months(events: DataFrame, keys: Sequence[str] = ("metric_id", "geo_id"), ties: Sequence[str] = ("value",)) -> DataFrame:
    """Dated events (``at date, value``) to the value in force in each month.

    The last event of a month wins, of several on one day the last by ``ties``;
    months between the first and the last event repeat the value before them.
    """
    monthly = events.withColumn("month", F.year("at") * 12 + F.month("at") - 1)
    known = monthly.groupBy(*keys, "month").agg(F.max_by("value", F.struct("at", *ties)).alias("value"))
    nxt = F.lead("month").over(series_window(keys, "month"))
    spans = known.withColumn("_until", F.coalesce(nxt - 1, F.col("month")))
    return spans.select(*keys, F.explode(F.sequence("month", "_until")).alias("month"), "value")


def episodes(df: DataFrame, flag: str, keys: Sequence[str], order: str = "pidx") -> DataFrame:
    """Number the runs of a true flag (gaps and islands)."""
    w = series_window(keys, order)
    before = F.coalesce(F.lag(flag).over(w), F.lit(False))
    starts = df.withColumn("starts", F.col(flag) & ~before)
    number = F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return starts.withColumn("episode", F.when(F.col(flag), number))


def next_in_time(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], value: str, bucket: Column, out: str
) -> DataFrame:
    """The value of the next row of a key in time order, for raw facts.

    A key may hold a large share of the rows, so the order is formed per key
    and time bucket; the last row of a bucket takes the first value of the
    key's next bucket, from a table with one row per key and bucket.
    """
    dealt = df.withColumn("_b", bucket)
    inside = Window.partitionBy(*keys, "_b").orderBy(time, *ties)
    led = dealt.withColumns({"_next": F.lead(value).over(inside), "_last": F.lead(time).over(inside).isNull()})
    heads = dealt.groupBy(*keys, "_b").agg(F.min_by(value, F.struct(time, *ties)).alias("_head"))
    follow = heads.select(*keys, "_b", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_b")).alias("_follow"))
    joined = join_null_safe(led, follow, [*keys, "_b"])
    return joined.select(*df.columns, F.when(F.col("_last"), F.col("_follow")).otherwise(F.col("_next")).alias(out))


def any_ahead(flag: str, n: int, w: WindowSpec) -> Column:
    """Whether the flag holds in one of the next ``n`` rows."""
    return F.coalesce(F.max(flag).over(w.rowsBetween(1, n)), F.lit(False))


def full_ahead(n: int, w: WindowSpec) -> Column:
    """Whether ``n`` further rows exist."""
    return F.count(F.lit(1)).over(w.rowsBetween(1, n)) == n


def carry_stress(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Negated percent change over three rows, with its reading."""
    base = F.lag("value", 3).over(series_window(keys))
    out = df.withColumn("stress", -F.try_divide((F.col("value") - base) * 100, F.when(base != 0, base)))
    read = F.when(F.col("stress") > 4, "contractionary").when(F.col("stress") > -4, "neutral").otherwise("expansionary")
    return out.where(F.col("stress").isNotNull()).withColumn("read", read)
