"""Entity snapshots: monthly state, differences, replay, stocks and flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_entity(df: DataFrame, entity: str, preferred: Column, order: Sequence[str]) -> DataFrame:
    """One row per entity: a preferred one if any, else the first."""
    rest = [c for c in df.columns if c != entity]
    rank = F.struct(F.when(preferred, 0).otherwise(1).alias("_p"), *order)
    return (
        df.groupBy(entity)
        .agg(F.min_by(F.struct(*rest), rank).alias("_r"))
        .select(entity, *[F.col(f"_r.{c}").alias(c) for c in rest])
    )


def diff(previous: DataFrame, current: DataFrame, entity: str, columns: Sequence[str], state: str) -> DataFrame:
    """Changes between two snapshots (one row per entity on each side).

    ``change`` is added, removed, state_changed or attributes_changed; ``old``
    and ``new`` are structs of ``columns``.
    """
    old = previous.select(entity, F.struct(*columns).alias("old"))
    new = current.select(entity, F.struct(*columns).alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~F.col(f"old.{state}").eqNullSafe(F.col(f"new.{state}")), "state_changed")
        .otherwise("attributes_changed")
    )
    both = old.join(new, entity, "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return both.select(entity, change.alias("change"), "old", "new")


def replay(base: DataFrame, changes: DataFrame, upto: int, entity: str, columns: Sequence[str]) -> DataFrame:
    """State after applying every change up to a period, in one aggregate.

    ``changes`` carries ``pidx``; the base precedes all of them.  The last
    event of each entity decides, and removed entities disappear.
    """
    start = base.select(entity, F.lit(-(2**31)).alias("pidx"), F.lit("added").alias("change"), F.struct(*columns).alias("new"))
    log = changes.where(F.col("pidx") <= upto).select(entity, "pidx", "change", "new")
    last = start.unionByName(log).groupBy(entity).agg(F.max_by(F.struct("change", "new"), "pidx").alias("_r"))
    alive = last.where(F.col("_r.change") != "removed")
    return alive.select(entity, *[F.col(f"_r.new.{c}").alias(c) for c in columns])


def stock_counts(
    snapshot: DataFrame, places: DataFrame, place: str, is_open: Column, is_closed: Column, marked: Column
) -> DataFrame:
    """Open, closed and marked-open entities per place, zeros included."""
    counts = snapshot.groupBy(place).agg(
        F.count_if(is_open).alias("open"),
        F.count_if(is_closed).alias("closed"),
        F.count_if(is_open & marked).alias("marked_open"),
    )
    out = places.select(place).distinct().join(counts, place, "left")
    n_open, n_closed = F.coalesce("open", F.lit(0)), F.coalesce("closed", F.lit(0))
    share = F.coalesce(F.try_divide(F.lit(100.0) * n_closed, n_open + n_closed), F.lit(0.0))
    return out.select(
        place,
        n_open.alias("open"),
        n_closed.alias("closed"),
        F.coalesce("marked_open", F.lit(0)).alias("marked_open"),
        share.alias("vacancy_rate"),
    )


def flow_counts(changes: DataFrame, place: str, open_state: str, state: str, kind: str, marked) -> DataFrame:
    """Openings and closures per place from a snapshot difference.

    An opening belongs to the new place and a closure to the old one.  ``marked``
    maps a kind Column to a boolean Column.  Each change emits at most two rows.
    """

    def holds(side: str) -> Column:
        return F.coalesce(F.col(f"{side}.{state}") == open_state, F.lit(False))

    def holds_marked(side: str) -> Column:
        return holds(side) & F.coalesce(marked(F.col(f"{side}.{kind}")), F.lit(False))

    was, now, was_m, now_m = holds("old"), holds("new"), holds_marked("old"), holds_marked("new")
    events = F.array(
        F.struct(
            F.col(f"new.{place}").alias(place),
            (now & ~was).alias("opening"),
            F.lit(False).alias("closure"),
            (now_m & ~was_m).alias("marked_opening"),
            F.lit(False).alias("marked_closure"),
        ),
        F.struct(
            F.col(f"old.{place}").alias(place),
            F.lit(False).alias("opening"),
            (was & ~now).alias("closure"),
            F.lit(False).alias("marked_opening"),
            (was_m & ~now_m).alias("marked_closure"),
        ),
    )
    flows = changes.select(F.inline(events)).where(F.col(place).isNotNull())
    return flows.groupBy(place).agg(
        F.count_if("opening").alias("openings"),
        F.count_if("closure").alias("closures"),
        F.count_if("marked_opening").alias("marked_openings"),
        F.count_if("marked_closure").alias("marked_closures"),
    )
