"""Composite views a reader asks for: cards, overview, desk, brief, health.

Every view is one DataFrame over all places; nested sections are structs and
arrays bounded by the calendar or by the declared metrics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import period_text, pidx_end, pretty_period
from tidemark.operators import desk, indices, leadlag
from tidemark.operators.places import resolve
from tidemark.operators.series import percent_change, series_window, with_outlier_score, year_before
from tidemark.operators.snapshots import diff, flow_counts, stock_counts
from tidemark.operators.validate import freshness
from tidemark.schema import SERIES_KEY

# Attention metrics and levels that may not lead the front page,
# the suspect threshold, the lengths of published tails, and scope labels.
ATTENTION = r"^(wiki_|news_|search_)"
HEADLINE_LEVELS = ["municipality", "province"]
SUSPECT = 3.5
# The qualifiers below a headline.
QUALIFIER_OF_CITY = "Published for the municipality itself."
QUALIFIER_OF_LEVEL = ("Published at ", " level.")
TAIL = 96
SHORT_TAIL = 36
TOP_MOVERS = 24


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def headline_eligible(least: float = 5.0) -> Column:
    level = F.col("geo_level").isin(HEADLINE_LEVELS)
    return level & ~F.col("metric_id").rlike(ATTENTION) & (F.abs("yoy") >= least)


def mover_eligible() -> Column:
    return F.col("yoy").isNotNull() & (F.col("fresh") != "failing") & ~F.coalesce(F.col("suspect"), F.lit(False))


def headline_sentence(subject, place, change, period) -> Column:
    """``Revenue in X rose 12% over the year to July 2026.``"""
    c = _c(change)
    return F.concat(
        _c(subject),
        F.lit(" in "),
        _c(place),
        F.when(c > 0, " rose ").otherwise(" fell "),
        F.round(F.abs(c), 0).cast("bigint").cast("string"),
        F.lit("% over the year to "),
        pretty_period(period),
        F.lit("."),
    )


def wide_latest(series: DataFrame, columns: dict[str, str], required: str, key: str = "geo_id") -> DataFrame:
    """Newest value of several metrics side by side; the required one must exist."""
    picks = [
        F.max_by(F.when(F.col("metric_id") == m, F.col("value")), F.when(F.col("metric_id") == m, F.col("pidx"))).alias(name)
        for m, name in columns.items()
    ]
    wanted = series.where(F.col("metric_id").isin(*columns))
    return wanted.groupBy(key).agg(*picks).where(F.col(required).isNotNull())


def newest_with_tail(
    series: DataFrame, cadences: Sequence[str], keys: Sequence[str] = SERIES_KEY, tail: int = TAIL, outlier: bool = True
) -> DataFrame:
    """Newest reading of each series with its yoy, outlier score and tail.

    One window specification serves the look-ups, the score and the tail.
    """
    w = series_window(keys)
    rows = series.withColumn("yoy", percent_change(F.col("value"), year_before("value", w, cadences)))
    rows = with_outlier_score(rows, keys=keys) if outlier else rows.withColumn("outlier", F.lit(None).cast("double"))
    newest_first = series_window(keys).rowsBetween(1, tail)
    rows = rows.withColumn("_after", F.count(F.lit(1)).over(newest_first))
    in_tail = F.when(F.col("_after") < tail, F.struct("pidx", "value"))
    out = rows.groupBy(*keys, "geo_level", "cadence").agg(
        F.max_by(F.struct("pidx", "value", "yoy", F.col("outlier").alias("outlier_score")), "pidx").alias("_r"),
        F.sort_array(F.collect_list(in_tail)).alias("series"),
    )
    return out.select(*keys, "geo_level", "cadence", "_r.*", "series")


def metric_cards(
    series: DataFrame,
    registry: DataFrame,
    sources: DataFrame,
    bridge: DataFrame,
    as_of: str,
    cadences: Sequence[str] = ("monthly",),
) -> DataFrame:
    """A card per place and metric: newest value, change, doubts, freshness, tail.

    Cards are built per series and only then given to the places that read it.
    """
    newest = newest_with_tail(series, cadences)
    doubtful = indices.provisional_releases(series, cadences).where("provisional").select(
        "metric_id", "pidx", F.lit(True).alias("provisional")
    )
    meta = registry.select("metric_id", "label", "unit", "section", "direction", "source_id")
    ages = sources.select("source_id", "max_age_days")
    cards = (
        newest.join(meta, "metric_id")
        .join(ages, "source_id", "left")
        .join(doubtful, ["metric_id", "pidx"], "left")
    )
    end = pidx_end("pidx", F.col("cadence"))
    cards = cards.withColumns(
        {
            "provisional": F.coalesce("provisional", F.lit(False)),
            "observation_end": end,
            "staleness_days": F.datediff(F.lit(as_of).cast("date"), end),
            "fresh": freshness(end, "max_age_days", as_of),
            "period": period_text("pidx", "cadence"),
        }
    )
    cards = cards.withColumn("suspect", F.col("provisional") | F.coalesce(F.col("outlier_score") >= SUSPECT, F.lit(False)))
    return resolve(cards, bridge).withColumn("is_city_level", F.col("geo_level") == "municipality")


def first_place(cards: DataFrame) -> DataFrame:
    """One row per distinct series: the first place that reads it."""
    rest = [c for c in cards.columns if c not in ("metric_id", "geo_id", "series")]
    first = cards.groupBy("metric_id", "geo_id").agg(F.min_by(F.struct(*rest), F.col("place")).alias("_r"))
    return first.select("metric_id", "geo_id", "_r.*")


def movers(cards: DataFrame) -> DataFrame:
    """Eligible changes, each series once."""
    return first_place(cards.where(mover_eligible()))


def top_movers(cards: DataFrame, n: int = TOP_MOVERS) -> DataFrame:
    """The largest changes: a top-k report."""
    return movers(cards).orderBy(F.abs("yoy").desc(), "metric_id", "geo_id").limit(n)


def headline(cards: DataFrame) -> DataFrame:
    """The single most striking change, as a sentence.  At most one row."""
    rows = movers(cards).where(headline_eligible())
    # the order of ``top_movers``: a tie goes to the first in the list
    best = rows.agg(
        F.min_by(F.struct("metric_id", "geo_id", "place", "label", "yoy", "period", "geo_level"), F.struct(-F.abs("yoy"), "metric_id", "geo_id")).alias("h")
    )
    flat = best.where(F.col("h").isNotNull()).select("h.*")
    scope = F.when(F.col("geo_level") == "municipality", QUALIFIER_OF_CITY).otherwise(
        F.concat(F.lit(QUALIFIER_OF_LEVEL[0]), "geo_level", F.lit(QUALIFIER_OF_LEVEL[1]))
    )
    return flat.withColumns({"sentence": headline_sentence("label", "place", "yoy", "period"), "qualifier": scope})


def sections(cards: DataFrame) -> DataFrame:
    """Cards of a place grouped by section, ordered by label."""
    card = F.struct("label", "metric_id", "geo_id", "geo_level", "period", "value", "yoy", "suspect", "fresh", "series")
    grouped = cards.groupBy("place", "section").agg(F.sort_array(F.collect_list(card)).alias("cards"))
    return grouped.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("section", "cards"))).alias("sections"))


def district_payload(series: DataFrame, parts: DataFrame, cadences: Sequence[str] = ("monthly",)) -> DataFrame:
    """Newest reading, change and tail of every part of a place."""
    newest = newest_with_tail(series, cadences, outlier=False)
    return newest.join(parts.withColumnRenamed("part", "geo_id"), "geo_id").withColumn("code", F.substring_index("geo_id", "-", -1))


def standings(now: DataFrame, current: DataFrame, ranked: DataFrame) -> DataFrame:
    """Regime, index values and leading archetype per place."""
    values = current.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("index_id", "value"))).alias("indices"))
    top = ranked.where("position = 1").select("place", F.col("archetype_id").alias("top_signature"), F.col("score").alias("top_score"))
    return now.select("place", "month", "rule_id", "label", "confident").join(values, "place", "left").join(top, "place", "left")


def city_payload(
    cards: DataFrame,
    now: DataFrame,
    current: DataFrame,
    history: DataFrame,
    timeline: DataFrame,
    districts: DataFrame,
    desk_entries: DataFrame,
    ranked: DataFrame,
    evidence: DataFrame,
) -> DataFrame:
    """One nested document per place with all its sections."""

    def listed(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.groupBy("place").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))

    out = now.select("place", F.struct("rule_id", "label", "month", "available", "confident").alias("regime"))
    pieces = [
        sections(cards),
        listed(current, "indices", "index_id", "value", "month", "n", "insufficient"),
        listed(history, "index_history", "index_id", "month", "value"),
        listed(timeline, "regime_timeline", "month", "rule_id", "held_by_hysteresis"),
        listed(districts, "districts", "metric_id", "code", "pidx", "value", "yoy"),
        listed(desk_entries, "desk", "metric_id", "pidx", "value", "yoy", "z", "index", "read"),
        listed(ranked, "signatures", "position", "archetype_id", "firing", "available", "total", "score"),
        listed(evidence, "leadlag", "signal", "outcome", "best_lag", "holdout_r", "verdict"),
    ]
    for piece in pieces:
        out = out.join(piece, "place", "left")
    return out


def desk_series(series: DataFrame, bridge: DataFrame, parts: DataFrame, how: Column) -> DataFrame:
    """Series of each place for the desk: its own, else its pooled districts."""
    from tidemark.operators.places import parts_of
    from tidemark.operators.rollups import pool_parts

    own = resolve(series.where(F.col("geo_level") != "district"), bridge)
    district = parts_of(series.where(F.col("geo_level") == "district"), parts).where(how.isNotNull())
    pooled = pool_parts(district, ["place", "metric_id", "cadence"], how)
    return desk.own_or_pooled(own, pooled)


def national_cities(signals: DataFrame) -> DataFrame:
    """Places by composite, missing last, with their most unusual signals."""
    totals = desk.composite(signals)
    top = desk.top_signals(signals).groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("position", "metric_id", "index"))).alias("top")
    )
    return totals.join(top, "place", "left").orderBy(F.col("composite").desc_nulls_last(), "place")


def brief(issued: DataFrame, current: DataFrame, district_table: DataFrame) -> DataFrame:
    """Forecasts with their skill flag, index verdicts and the district table."""
    skill = F.when(F.col("model_verdict") == "beats_baseline", "skilled").otherwise("baseline")
    forecasts = issued.select(F.lit("forecast").alias("part"), F.col("geo_id").alias("subject"), F.col("target_id").alias("item"), F.col("p50").alias("value"), skill.alias("note"))
    verdict = F.when(F.col("value").isNull(), "insufficient").when(F.col("value") > 0.5, "high").when(F.col("value") < -0.5, "low").otherwise("normal")
    readings = current.select(F.lit("index"), "place", "index_id", "value", verdict)
    table = district_table.select(F.lit("district"), "geo_id", F.lit("ticket"), "ticket", F.lit("table"))
    return forecasts.union(readings).union(table)


def district_report(table: DataFrame, parent: str, value: str, order_key: str) -> DataFrame:
    """Rank of each district among the districts of its place."""
    from pyspark.sql import Window

    order = Window.partitionBy(parent).orderBy(F.col(value).desc(), order_key)
    whole = Window.partitionBy(parent)
    return table.withColumns({"rank": F.row_number().over(order), "of": F.count(F.lit(1)).over(whole)})


def source_health(runs: DataFrame, sources: DataFrame, as_of: str) -> DataFrame:
    """Status counters, trailing failures and freshness per source.

    ``runs`` is (source_id, run, status, latest_observation date).
    """
    good = F.col("status").isin("ok", "skipped", "partial")
    base = runs.groupBy("source_id").agg(
        F.max(F.when(good, F.col("run"))).alias("last_success"),
        F.max_by("status", "run").alias("status"),
        F.max(F.when(good, F.col("latest_observation"))).alias("latest_observation"),
        F.count_if(good).alias("succeeded"),
        F.count_if(~good).alias("failed"),
    )
    after = runs.join(base.select("source_id", "last_success"), "source_id").groupBy("source_id").agg(
        F.count_if(~good & (F.col("last_success").isNull() | (F.col("run") > F.col("last_success")))).alias("consecutive_failures")
    )
    out = base.join(after, "source_id").join(sources.select("source_id", "max_age_days"), "source_id", "left")
    stale = F.datediff(F.lit(as_of).cast("date"), F.col("latest_observation"))
    fresh = F.coalesce(stale <= F.col("max_age_days"), F.lit(False))
    return out.withColumns({"staleness_days": stale, "fresh": fresh, "needs_attention": (F.col("status") == "failed") | ~fresh})


def manifest(series: DataFrame, places: DataFrame) -> DataFrame:
    """Counts published with every build."""
    per = series.groupBy("metric_id", "geo_id").agg(F.count(F.lit(1)).alias("n"))
    totals = per.agg(
        F.count(F.lit(1)).alias("series"),
        F.sum("n").alias("observations"),
        F.array_join(F.sort_array(F.collect_set("metric_id")), ",").alias("metrics"),
    )
    return totals.withColumn("places", places.agg(F.count(F.lit(1))).scalar())


def census_month(
    previous: DataFrame, current: DataFrame, places: DataFrame, columns: Sequence[str], open_state: str, closed_state: str, marked
) -> DataFrame:
    """Stock, vacancy, openings and closures of a month, per district."""
    state, kind, place, entity = "state", "kind", "district", "id"
    stock = stock_counts(
        current, places, place, F.col(state) == open_state, F.col(state) == closed_state, F.coalesce(marked(F.col(kind)), F.lit(False))
    )
    flows = flow_counts(diff(previous, current, entity, columns, state), place, open_state, state, kind, marked)
    flow_names = [c for c in flows.columns if c != place]
    return stock.join(flows, place, "left").select(*stock.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in flow_names])


def _entries(rows: DataFrame, part: str, homes: Sequence[tuple[str, str | Column]], item, at=None, value=None, note=None, rank=None) -> DataFrame:
    """Rows as entries of the ``part`` of every document in ``homes`` (kind, name): each row fans out to all of them."""
    docs = F.array(*[F.struct(F.lit(kind).alias("kind"), (F.lit(name) if isinstance(name, str) else name).alias("name")) for kind, name in homes])
    entry = F.struct(
        (F.lit(0) if rank is None else _c(rank)).cast("bigint").alias("rank"), _c(item).cast("string").alias("item"),
        (F.lit(0) if at is None else _c(at)).cast("int").alias("at"), (F.lit(None) if value is None else _c(value)).cast("double").alias("value"),
        (F.lit(None) if note is None else _c(note)).cast("string").alias("note"),
    )
    return rows.select(docs.alias("docs"), entry.alias("entry")).select(F.inline("docs"), F.lit(part).alias("part"), "entry")


DOCUMENT = "kind string, name string, parts array<struct<part:string,entries:array<struct<rank:bigint,item:string,at:int,value:double,note:string>>>>"


def documents(cards: DataFrame, timeline: DataFrame, health: DataFrame, national: DataFrame, signals: DataFrame, totals: DataFrame) -> DataFrame:
    """All published documents as (kind, name, parts): places, overview, national, signals, sources and manifest.

    Every reading is an entry of one or more documents; one grouped pass over all
    entries makes the documents of every kind.  A document holds as many
    entries as there are metrics, places, sources and months, never facts.
    """
    place = F.col("place")
    ranked = top_movers(cards).withColumn("rank", F.row_number().over(Window.orderBy(F.abs("yoy").desc(), "metric_id", "geo_id")))  # ``TOP_MOVERS`` rows
    series_name = F.concat_ws(" ", "metric_id", "geo_id")
    recent = timeline_tail(timeline)
    pieces = [
        _entries(cards, "cards", [("place", place)], series_name, "pidx", "value", "fresh"),
        _entries(recent.withColumn("place", place), "timeline", [("place", place), ("overview", "overview")], "place", "month", F.col("held_by_hysteresis").cast("int"), "rule_id", "month"),
        _entries(ranked, "movers", [("overview", "overview")], F.concat_ws(" ", "place", "metric_id", "geo_id"), "pidx", "yoy", None, "rank"),
        _entries(headline(cards), "headline", [("overview", "overview")], series_name, None, "yoy", "sentence"),
        _entries(health.where("needs_attention"), "attention", [("overview", "overview")], "source_id", None, "staleness_days", "status"),
        _entries(health, "health", [("sources", "sources")], "source_id", "last_success", "staleness_days", "status"),
        _entries(national, "places", [("national", "national")], "place", "composite_n", "composite", F.array_join(F.transform("top", lambda x: x["metric_id"]), ",")),
        _entries(signals_page(signals), "pairs", [("signals", "signals")], F.concat_ws(" ", "signal", "outcome"), "leading", "median_lag", None),
        _entries(totals, "counts", [("manifest", "manifest")], "metrics", "places", "observations", None, "series"),
    ]
    rows = reduce(DataFrame.unionByName, pieces)
    parts = rows.groupBy("kind", "name", "part").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return parts.groupBy("kind", "name").agg(F.sort_array(F.collect_list(F.struct("part", "entries"))).alias("parts"))


def signals_page(evidence: DataFrame) -> DataFrame:
    return leadlag.pair_summary(evidence).orderBy(F.col("leading").desc(), "signal")


def timeline_tail(timeline: DataFrame, n: int = SHORT_TAIL) -> DataFrame:
    from tidemark.operators.series import tail

    return tail(timeline, n, ("place",), "month")


