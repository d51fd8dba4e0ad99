"""Keyed state of the streams: merges that never read the log, late rows as rows, compaction."""

import datetime as dt
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.plans.catalog.streams import keyed_state, run_to_files
from tidemark.streaming import streams


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Map(dict):
    containsKey = dict.__contains__
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.pop


class Handle:
    """State of one key, kept in memory."""

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, value):
        return Map()


def test_late_rows_are_exact_over_many_batches():
    rng = random.Random(2)
    day, delay = pd.Timedelta("1 day"), pd.Timedelta("2 days")
    p = streams.Buckets(["k"], "ts", day, delay, "value")
    p.init(Handle())
    start = pd.Timestamp("2001-01-01")
    late, closed, want_late, held, newest, given = [], {}, [], defaultdict(lambda: [0, 0.0]), None, set()
    for batch in range(150):
        rows = [(start + pd.Timedelta(hours=batch * 5 - rng.choice([0, 0, 3, 40, 300])), float(rng.randint(0, 9))) for _ in range(rng.randint(1, 6))]
        for at, value in rows:
            bucket = at.floor(day)
            if newest is not None and bucket + day <= newest - delay:
                want_late.append((at, value))
            else:
                held[bucket][0] += 1
                held[bucket][1] += value
        newest = max([at for at, _ in rows] + ([newest] if newest is not None else []))
        parts = [pd.DataFrame(rows[:2], columns=["ts", "value"]), pd.DataFrame(rows[2:], columns=["ts", "value"])]
        for out in p.handleInputRows(("k",), iter(parts), None):
            for r in out.itertuples():
                if r.kind == "late":
                    late.append((r.at, r.value))
                else:
                    assert r.bucket not in given
                    given.add(r.bucket)
                    closed[r.bucket] = [r.n, r.total]
    assert len(want_late) > 50 and late == want_late
    assert closed == {b: v for b, v in held.items() if b + day <= newest - delay}


def test_late_rows_of_a_stream(spark, tmp_path):
    with keyed_state(spark):
        for at in ("2001-01-10", "2001-01-20", "2001-01-02", "2001-01-19"):
            rows = spark.sql(f"SELECT TIMESTAMP '{at} 05:00:00' AS ts, 'k' AS k, 1.5D AS value UNION ALL SELECT NULL, 'k', 1.0D")
            rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
            out = run_to_files(streams.buckets_and_late_rows(stream, "ts", "1 day", "1 day", ["k"], "value"), str(tmp_path / "run"))
    got = {(r.kind, r.bucket.day, r.n, r.value) for r in out.collect()}
    assert got == {("closed", 10, 1, None), ("late", 2, None, 1.5)}


def records(spark, rows):
    df = spark.createDataFrame(rows, "metric_id string, geo_id string, period string, value double, seq long")
    return H.canonicalise(df.withColumns({"unit": F.lit("u"), "source_id": F.lit("s")}), "2026-08-01")


@pytest.mark.parametrize("allowed", [True, False, None])
def test_merges_by_state_equal_merges_of_tables(spark, tmp_path, allowed):
    """Ten arrivals; ``None`` lets only one metric be restated.  What a batch reads does not grow."""
    rng = random.Random(5)
    rule = F.col("metric_id") == "m1" if allowed is None else allowed
    log, refused, read = None, [], []
    root = str(tmp_path)
    with keyed_state(spark):
        for arrival in range(4):
            rows = [(rng.choice(["m1", "m2"]), "mun-00001", f"2026-{rng.randint(1, 9):02d}", rng.choice([1.0, 2.0, 2.0000000001, None]), i) for i in range(12)]
            batch = records(spark, rows)
            batch.coalesce(1).write.mode("append").parquet(f"{root}/in")
            job = streams.merge_batches(spark.readStream.schema(batch.schema).parquet(f"{root}/in"), f"{root}/h", f"{root}/q", f"{root}/c", rule)
            job.awaitTermination()
            read.append(sum(p["numInputRows"] for p in job.recentProgress))
            decided = H.merge(batch.limit(0) if log is None else log, batch, rule)
            refused += [(r.metric_id, r.period, r.value, r.prior_value) for r in H.quarantined(decided).collect()]
            new = spark.createDataFrame(H.appended(decided).collect(), batch.schema)
            log = new if log is None else log.unionByName(new)
    assert read == [12] * 4
    key = lambda r: (r.metric_id, r.period, r.value if r.value is not None else -1.0, r.revision, r.quality_flag)
    got = streams.read_batches(spark, f"{root}/h", log.schema)
    assert sorted(map(key, got.collect())) == sorted(map(key, log.collect()))
    found = streams.read_batches(spark, f"{root}/q", H.quarantined(decided).schema).collect()
    assert sorted(map(str, [(r.metric_id, r.period, r.value, r.prior_value) for r in found])) == sorted(map(str, refused))
    streams.compact(spark, f"{root}/h", f"{root}/compact", 2, log.schema)
    again = streams.read_batches(spark, f"{root}/h", log.schema, f"{root}/compact")
    assert sorted(map(key, again.collect())) == sorted(map(key, log.collect()))
    folders = {f.rsplit("/", 2)[1] for f in again.inputFiles()}
    assert "through=2" in folders
