"""Structured Streaming forms (X).

Each query runs a stream over files to completion, into files of the shared
folder, and reads the result back.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemark.operators import regimes
from tidemark.plans import model as M
from tidemark.plans.catalog.base import R, REV, query, r
from tidemark.plans.catalog.signals import HELD, VERDICT, WIDE, ZSQL, index_history, recursive
from tidemark.session import cut_lineage, scratch_path
from tidemark.streaming import streams

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark, sf_dir):
    schema = M.table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_files(df, path: str, mode: str = "append"):
    job = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out")


@query(
    "x1_closed_buckets",
    f"""SELECT date_trunc('day', ts)::DATE::VARCHAR AS day, event_type, count(*) AS n, {R('sum(value)', 3)} AS total, {R('avg(value)')} AS mean FROM events
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY ALL""",
)
def closed_buckets(spark, sf_dir):
    rolled = streams.closed_buckets(event_stream(spark, sf_dir), "ts", "1 day", "1 day", ["event_type"], "value")
    out = run_to_files(rolled, scratch_path(spark, "x1"))
    return out.select(F.col("bucket").cast("date").cast("string").alias("day"), "event_type", "n", r("total", 3), r("mean"))


@query("x2_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def first_seen(spark, sf_dir):
    first = streams.first_seen(event_stream(spark, sf_dir), "ts", "90 days", ["user_id", "event_type"])
    return run_to_files(first.select("user_id", "event_type", "ts"), scratch_path(spark, "x2")).select("user_id", "event_type")


@contextmanager
def keyed_state(spark):
    """The state store that keyed processors need, for the streams started inside."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _merged(spark, sf_dir, allowed: bool):
    """Feed the three restatements of the line revenue as three arrivals."""
    root = scratch_path(spark, "x3")
    log = cut_lineage(M.revision_log(spark, sf_dir))
    with keyed_state(spark):
        for arrival in range(3):
            arrived = log.where(F.col("revision") == arrival).withColumns({"revision": F.lit(0), "quality_flag": F.lit("ok")})
            arrived.write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(log.schema).parquet(f"{root}/in")
            streams.merge_batches(stream, f"{root}/history", f"{root}/quarantine", f"{root}/checkpoint", allowed).awaitTermination()
    return root, log.schema


@query(
    "x3_revision_merge_stream",
    f"""WITH {REV}, c AS (SELECT *, lag(round(value, 6)) OVER (PARTITION BY geo_id, pidx ORDER BY revision) IS DISTINCT FROM round(value, 6) AS changed FROM rlog),
    k AS (SELECT geo_id, pidx, value, row_number() OVER (PARTITION BY geo_id, pidx ORDER BY revision) - 1 AS revision FROM c WHERE changed)
    SELECT geo_id, pidx, value, revision::INTEGER AS revision, CASE WHEN revision > 0 THEN 'revised' ELSE 'ok' END AS quality_flag FROM k""",
)
def revision_merge_stream(spark, sf_dir):
    root, schema = _merged(spark, sf_dir, True)
    # the first arrivals rewritten as one folder, the last as it came
    streams.compact(spark, f"{root}/history", f"{root}/compacted", 1, schema)
    return streams.read_batches(spark, f"{root}/history", schema, f"{root}/compacted").select("geo_id", "pidx", "value", "revision", "quality_flag")


@query(
    "x4_restatement_quarantine_stream",
    f"""WITH {REV}, f AS (SELECT geo_id, pidx, arg_min(value, revision) AS first_value FROM rlog GROUP BY ALL)
    SELECT geo_id, pidx, value FROM rlog JOIN f USING (geo_id, pidx) WHERE round(value, 6) <> round(first_value, 6)""",
)
def restatement_quarantine_stream(spark, sf_dir):
    root, schema = _merged(spark, sf_dir, False)
    return streams.read_batches(spark, f"{root}/quarantine", schema).select("geo_id", "pidx", "value")


@query(
    "x4_late_rows_stream",
    f"""WITH a AS (SELECT *, user_id % 3 AS arrival, date_trunc('day', ts) AS bucket FROM events),
    t AS (SELECT event_type, arrival, max(ts) AS top FROM a GROUP BY ALL),
    s AS (SELECT event_type, arrival, max(top) OVER (PARTITION BY event_type ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM t)
    SELECT event_type, bucket::DATE::VARCHAR AS day, ts::VARCHAR AS at, {R('value')} AS value FROM a JOIN s USING (event_type, arrival)
    WHERE bucket + INTERVAL 1 DAY <= newest - INTERVAL 1 DAY""",
)
def late_rows_stream(spark, sf_dir):
    """The events of three sets of users arrive one after the other, so the later sets come late."""
    root = scratch_path(spark, "x4late")
    events = M.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    with keyed_state(spark):
        for arrival in range(3):
            events.where(F.pmod("user_id", F.lit(3)) == arrival).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
            out = run_to_files(streams.buckets_and_late_rows(stream, "ts", "1 day", "1 day", ["event_type"], "value"), root)
    late = out.where(F.col("kind") == "late")
    return late.select("event_type", F.col("bucket").cast("date").cast("string").alias("day"), F.col("at").cast("string").alias("at"), r("value"))


@query(
    "x5_hysteresis_stream",
    recursive(ZSQL + WIDE + VERDICT + HELD) + " SELECT place, month, verdict, rule_id, held::INTEGER AS held FROM tl",
)
def hysteresis_stream(spark, sf_dir):
    root = scratch_path(spark, "x5")
    judged = regimes.verdicts(index_history(spark, sf_dir)).select("place", "month", "verdict")
    judged = cut_lineage(judged)
    low, high = judged.agg(F.coalesce(F.min("month"), F.lit(0)), F.coalesce(F.max("month"), F.lit(0))).first()
    # Three arrivals, each a batch of its own; state is read back in between.
    edges = [low, *(low + (high + 1 - low) * n // 3 for n in (1, 2)), high + 1]
    with keyed_state(spark):
        for start, end in zip(edges, edges[1:]):
            judged.where(F.col("month").between(start, end - 1)).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema("place string, month int, verdict string").parquet(f"{root}/in")
            out = run_to_files(streams.hold_stream(stream, regimes.STICKY, regimes.HYSTERESIS), root)
    return out.select("place", "month", "verdict", "rule_id", F.col("held_by_hysteresis").cast("int").alias("held"))
