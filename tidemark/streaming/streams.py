"""Incremental forms of the roll-ups, the history merge and the hysteresis."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.frames import plain
from tidemark.operators.history import appended, quarantined
from tidemark.schema import OBS_KEY


def closed_buckets(stream: DataFrame, time: str, width: str, delay: str, keys: Sequence[str], value: str) -> DataFrame:
    """Tumbling roll-up that emits a bucket once the watermark has passed it."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
        .select(F.col("window.start").alias("bucket"), *keys, "n", "total", "mean")
    )


def dropped_as_late(job) -> int:
    """Rows of a streaming query that came behind the watermark and were left out, over its recent batches."""
    return sum(op["numRowsDroppedByWatermark"] for p in job.recentProgress for op in p["stateOperators"])


class Buckets(StatefulProcessor):
    """Open buckets of each key and the newest time it has seen.

    A bucket closes once the key's newest time is ``delay`` beyond its end, and
    is given out then.  A row of an earlier batch's closed bucket is late: it
    comes back as it is and changes nothing.  Rows pass in batches, so a key with
    very many rows needs no more memory than its open buckets.
    """

    def __init__(self, keys: Sequence[str], time: str, width: pd.Timedelta, delay: pd.Timedelta, value: str):
        self.keys, self.time, self.width, self.delay, self.value = list(keys), time, width, delay, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "at timestamp")
        self.open = handle.getMapState("open", "bucket timestamp", "n bigint, total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        newest = pd.Timestamp(self.newest.get()[0]) if self.newest.exists() else None
        before = newest
        named = dict(zip(self.keys, key))
        held: dict[pd.Timestamp, list] = {}
        for pdf in rows:
            pdf = pdf[pdf[self.time].notna()]
            if pdf.empty:
                continue
            bucket = pdf[self.time].dt.floor(self.width)
            late = bucket + self.width <= before - self.delay if before is not None else pd.Series(False, index=pdf.index)
            if late.any():
                yield plain(pd.DataFrame({"kind": "late", **named, "bucket": bucket[late], "n": None, "total": None, "at": pdf[self.time][late], "value": pdf[self.value][late]}))
            for start, part in pdf[~late].groupby(bucket[~late])[self.value]:
                n, total = held.get(start, (0, 0.0))
                held[start] = (n + len(part), total + float(part.sum()))
            top = pdf[self.time].max()
            newest = top if newest is None or top > newest else newest
        for start, (n, total) in held.items():
            name = (start.to_pydatetime(),)
            if self.open.containsKey(name):
                n, total = n + self.open.getValue(name)[0], total + self.open.getValue(name)[1]
            self.open.updateValue(name, (n, total))
        if newest is None:
            return
        self.newest.update((newest.to_pydatetime(),))
        closed = sorted(pd.Timestamp(name[0]) for name in self.open.keys() if pd.Timestamp(name[0]) + self.width <= newest - self.delay)
        if closed:
            sums = [self.open.getValue((c.to_pydatetime(),)) for c in closed]
            for c in closed:
                self.open.removeKey((c.to_pydatetime(),))
            yield plain(pd.DataFrame({"kind": "closed", **named, "bucket": closed, "n": [x[0] for x in sums], "total": [x[1] for x in sums], "at": pd.NaT, "value": None}))

    def close(self) -> None:
        pass


def buckets_and_late_rows(stream: DataFrame, time: str, width: str, delay: str, keys: Sequence[str], value: str) -> DataFrame:
    """Tumbling roll-up of each key with its late rows: (kind, keys..., bucket, n, total, at, value).

    ``kind`` is ``closed`` for a finished bucket and ``late`` for a row that came
    after its bucket was given out.  Lateness is kept per key in the state, so it
    is exact over any number of batches.  Needs the RocksDB state store provider.
    """
    fields = [f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join(["kind string", *fields, "bucket timestamp", "n bigint", "total double", "at timestamp", "value double"])
    rows = stream.select(*keys, F.col(time).cast("timestamp").alias(time), F.col(value).cast("double").alias(value))
    processor = Buckets(keys, time, pd.Timedelta(width), pd.Timedelta(delay), value)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "none")


def first_seen(stream: DataFrame, time: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """First row per key within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


class Revisions(StatefulProcessor):
    """The newest value and revision of each observation, and what a batch does to it.

    As in a merge of tables, the first row of a batch in ingest order decides;
    rows of the batch after it are dropped.
    """

    def __init__(self, columns: Sequence[str], allowed: bool | None = None):
        self.columns, self.allowed = list(columns), allowed  # None: each row says so itself

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", "value double, revision int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            least = pdf.sort_values("seq", kind="stable").head(1)
            if first is None or least["seq"].iloc[0] < first["seq"].iloc[0]:
                first = least
        row = first.iloc[0]
        value = None if pd.isna(row["value"]) else float(row["value"])
        action, prior, revision, flag = "added", None, int(row["revision"]), row["quality_flag"]
        if self.state.exists():
            prior, known = self.state.get()
            same = prior is None and value is None or None not in (prior, value) and round(prior, 6) == round(value, 6)
            if same:
                action = "unchanged"
            elif row["restatable"] if self.allowed is None else self.allowed:
                action, revision, flag = "revised", known + 1, "revised"
            else:
                action = "quarantined"
        if action in ("added", "revised"):
            self.state.update((value, revision))
        out = first.assign(revision=revision, quality_flag=flag, action=action, prior_value=prior)
        yield plain(out[[*self.columns, "action", "prior_value"]])

    def close(self) -> None:
        pass


def revision_stream(stream: DataFrame, revisions_allowed: Column | bool = True, keys: Sequence[str] = OBS_KEY) -> DataFrame:
    """Canonical records with what each does to the history: ``action``, ``prior_value`` and the revision to store.

    The newest value of an observation is state under its key, so a batch never
    reads what has been written.  Needs the RocksDB state store provider.
    """
    fixed = revisions_allowed if isinstance(revisions_allowed, bool) else None
    schema = T.StructType([*stream.schema.fields, T.StructField("action", T.StringType()), T.StructField("prior_value", T.DoubleType())])
    rows = stream if fixed is not None else stream.withColumn("restatable", F.coalesce(revisions_allowed, F.lit(False)))
    return rows.groupBy(*keys).transformWithStateInPandas(Revisions(stream.columns, fixed), schema, "append", "none")


def merge_batches(
    stream: DataFrame, history_path: str, quarantine_path: str, checkpoint: str, revisions_allowed: Column | bool = True
):
    """Start the revision-aware upsert log over a stream of canonical records.

    Every batch writes its own folder from the state alone, so a batch replayed
    after a failure overwrites itself instead of adding twice, and its cost does
    not grow with the log.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        decisions = batch.persist()  # history and quarantine both read it
        appended(decisions).write.mode("overwrite").parquet(f"{history_path}/batch_id={batch_id}")
        quarantined(decisions).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        decisions.unpersist()

    decided = revision_stream(stream, revisions_allowed)
    return (
        decided.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def compact(spark: SparkSession, path: str, target: str, through: int, schema: T.StructType, files: int = 1) -> None:
    """Rewrite the folders of all batches up to ``through`` as one, in order of the observations, in the new folder ``target``."""
    rows = read_batches(spark, path, schema).where(F.col("batch_id") <= through)
    key = [c for c in OBS_KEY if c in rows.columns]
    rows.repartitionByRange(files, *key).sortWithinPartitions(*key, "batch_id").write.parquet(f"{target}/through={through}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, compacted: str | None = None) -> DataFrame:
    """Rows of all batch folders with ``batch_id``; with a ``compacted`` folder only later batches are read one by one."""
    fields = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if compacted is None:
        return spark.read.schema(fields).parquet(path)
    whole = T.StructType([*fields.fields, T.StructField("through", T.LongType())])
    old = spark.read.schema(whole).parquet(compacted)
    last = old.agg(F.max("through")).first()[0]
    old = old.where(F.col("through") == last).drop("through")
    return old.unionByName(spark.read.schema(fields).parquet(path).where(F.col("batch_id") > last))


class Hysteresis(StatefulProcessor):
    """Keeps the held state, the exit streak and the newest month of each entity.

    Inside a batch the rows of an entity are sorted here.  A row that is not
    newer than those of an earlier batch would change what has been given out:
    it comes back as ``late``, without a state, and changes nothing.
    """

    def __init__(self, sticky: Sequence[str], periods: int):
        self.sticky, self.periods = set(sticky), periods

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("held", "held string, streak int, newest int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        held, streak, newest = self.state.get() if self.state.exists() else ("", 0, None)
        pdf = pd.concat(list(rows)).sort_values("month", kind="stable")
        late = pdf["month"] <= newest if newest is not None else pd.Series(False, index=pdf.index)
        pdf, behind = pdf[~late], pdf[late]
        states, kept = [], []
        for verdict in pdf["verdict"]:
            hold = held in self.sticky and verdict != held and streak + 1 < self.periods
            streak = streak + 1 if hold else 0
            held = held if hold else verdict
            states.append(held)
            kept.append(hold)
        if len(pdf):
            self.state.update((held, streak, int(pdf["month"].iloc[-1])))
            yield plain(pd.DataFrame({"place": key[0], "month": pdf["month"], "verdict": pdf["verdict"], "rule_id": states, "held_by_hysteresis": kept, "late": False}))
        if len(behind):
            yield plain(pd.DataFrame({"place": key[0], "month": behind["month"], "verdict": behind["verdict"], "rule_id": None, "held_by_hysteresis": False, "late": True}))

    def close(self) -> None:
        pass


def hold_stream(stream: DataFrame, sticky: Sequence[str], periods: int) -> DataFrame:
    """Hysteresis over a stream of (place, month, verdict).

    Needs the RocksDB state store provider.
    """
    return stream.groupBy("place").transformWithStateInPandas(
        Hysteresis(sticky, periods),
        "place string, month int, verdict string, rule_id string, held_by_hysteresis boolean, late boolean",
        "append",
        "none",
    )
