"""Cases that caps, fixed lists and ties once hid."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from scripts.check_oracle import TABLES, canonical
from tidemark import session
from tidemark.operators import indices, leadlag, neighbours, series
from tidemark.plans import dashboards
from tidemark.plans.catalog import ORACLE, QUERIES
from tidemark.sources import readers, sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """The smallest tables with an order line number beyond 1000, a sixth segment and customers without one."""
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    path = str(tmp_path_factory.mktemp("odd"))
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "lineitem":
            df = df.withColumn("l_linenumber", F.when((F.col("l_orderkey") % 3 == 0) & (F.col("l_linenumber") == 1), 1001).otherwise(F.col("l_linenumber")).cast(df.schema["l_linenumber"].dataType))
        if name == "customer":
            seg = F.when(F.col("c_custkey") % 7 == 0, "YACHTING").when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
            df = df.withColumn("c_mktsegment", seg)
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    con = duckdb.connect()
    for name in TABLES:
        if os.path.isdir(f"{path}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    return path, con


@pytest.mark.parametrize("name", ["w7_current_view", "j8_as_of_view", "j3_parts_of_place", "q3_district_payload"])
def test_all_lines_and_all_segments_count(spark, odd, name):
    path, con = odd
    got, want = QUERIES[name](spark, path).toPandas(), con.execute(ORACLE[name]).df()
    assert len(got) and canonical(got) == canonical(want)


def test_last_revision_is_the_whole_revenue(spark, odd):
    path, con = odd
    got = QUERIES["w7_current_view"](spark, path).agg(F.sum("value")).first()[0]
    whole = con.execute("SELECT sum(l_extendedprice) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey").fetchone()[0]
    assert got == pytest.approx(float(whole))


def test_every_declared_pair_comes_back(spark):
    rows = [("a", "m1", "monthly", 24000 + i, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "place string, metric_id string, cadence string, pidx int, value double")
    pairs = spark.createDataFrame([("m1", "m2"), ("m2", "m1"), ("m3", "m4")], "signal string, outcome string")
    got = {(r.signal, r.outcome): r.verdict for r in leadlag.evaluate(df, pairs).collect()}
    assert got == {("m1", "m2"): "insufficient_data", ("m2", "m1"): "insufficient_data", ("m3", "m4"): "insufficient_data"}


def test_unknown_transforms_raise(spark):
    df = spark.createDataFrame([], "metric_id string, geo_id string, geo_level string, cadence string, pidx int, value double")
    pairs = spark.createDataFrame([], "metric_id string, transform string, direction int")
    with pytest.raises(ValueError, match="per_head"):
        indices.oriented(df, pairs, ["yoy", "per_head"])


def test_headline_is_the_first_of_the_movers(spark):
    rows = [("p", m, "g", "municipality", "L", y, 24000, "monthly", "2000-01", True, False) for m, y in (("aaa", 10.0), ("zzz", -10.0))]
    cards = spark.createDataFrame(rows, "place string, metric_id string, geo_id string, geo_level string, label string, yoy double, pidx int, cadence string, period string, fresh boolean, suspect boolean")
    both = cards.withColumns({"is_city_level": F.lit(True), "provisional": F.lit(False), "section": F.lit("s")})
    dashboards_eligible, headline_eligible = dashboards.mover_eligible, dashboards.headline_eligible
    dashboards.mover_eligible = dashboards.headline_eligible = lambda: F.lit(True)
    try:
        assert dashboards.top_movers(both).first().metric_id == dashboards.headline(both).first().metric_id == "aaa"
    finally:
        dashboards.mover_eligible, dashboards.headline_eligible = dashboards_eligible, headline_eligible


def test_several_events_of_one_day_have_an_order(spark):
    rows = [("m", "g", "2001-01-05", 2.0), ("m", "g", "2001-01-05", 1.0), ("m", "g", "2001-01-04", 9.0)]
    df = spark.createDataFrame(rows, "metric_id string, geo_id string, at string, value double").withColumn("at", F.to_date("at"))
    assert [r.value for r in series.fill_months(df).collect()] == [2.0]


def test_next_row_of_null_keys(spark):
    rows = [(None, 1, 1), (None, 2, 2), ("u", 1, 3), ("u", 70, 4)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = series.next_in_time(df, ["k"], "t", [], "v", F.floor(F.col("t") / 60), "nxt").collect()
    assert sorted((r.k or "", r.v, r.nxt or 0) for r in got) == [("", 1, 2), ("", 2, 0), ("u", 3, 4), ("u", 4, 0)]


def test_a_key_offered_twice_is_frozen_once_and_scores_are_appended_once(spark, tmp_path):
    rows = [("t", "g", 1, 5.0), ("t", "g", 1, 4.0), ("t", "g", 2, 3.0)]
    df = spark.createDataFrame(rows, "target_id string, geo_id string, from_pidx int, value double")
    path = str(tmp_path / "frozen")
    sinks.freeze_forecasts(df, None, path)
    sinks.freeze_forecasts(df, spark.read.parquet(path), path)
    assert sorted((r.from_pidx, r.value) for r in spark.read.parquet(path).collect()) == [(1, 4.0), (2, 3.0)]


def test_nested_timelines_may_be_missing(spark):
    docs = spark.createDataFrame([("a", '{"timeline":[{"data":[{"d":"20010203","v":2}]}]}'), ("b", '{"timeline":[]}'), ("c", "{}")], "k string, value string")
    got = readers.parse_timeline_json(docs, ["k"], "timeline array<struct<data:array<struct<d:string,v:double>>>>", "timeline[0].data", "d", "v").collect()
    assert [(r.k, r.period, r.value) for r in got] == [("a", "2001-02", 2.0)]


def test_neighbours_keep_ties_in_order(spark):
    cand = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(40)], "id int, vector array<double>")
    target = spark.createDataFrame([("t", [0.0, 0.0])], "target string, vector array<double>")
    for blocks in (1, 5):
        got = neighbours.nearest(cand, target, 5, ["id"], blocks=blocks).orderBy("position").collect()
        assert [r.id for r in got] == [0, 3, 6, 9, 12]


def test_clusters_must_name_a_shared_folder(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake())


def test_hysteresis_over_several_batches_reports_late_rows(spark, tmp_path):
    from tidemark.plans.catalog.streams import PROVIDER, ROCKSDB, run_to_files
    from tidemark.streaming import streams

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        for rows in ([("p", 1, "hot"), ("p", 2, "cold")], [("p", 3, "cold"), ("p", 4, "hot")], [("p", 2, "late"), ("p", 5, "cold")]):
            spark.createDataFrame(rows, "place string, month int, verdict string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema("place string, month int, verdict string").parquet(f"{tmp_path}/in")
            out = run_to_files(streams.hold_stream(stream, ["hot"], 2), str(tmp_path / "run"))
    finally:
        spark.conf.set(PROVIDER, before)
    got = sorted((r.month, r.verdict, r.rule_id, r.held_by_hysteresis, r.late) for r in out.collect())
    assert got == [(1, "hot", "hot", False, False), (2, "cold", "hot", True, False), (2, "late", None, False, True), (3, "cold", "cold", False, False), (4, "hot", "hot", False, False), (5, "cold", "hot", True, False)]


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    from tidemark.streaming import streams

    dropped = []
    for at in ("2001-01-10", "2001-01-20", "2001-01-02"):
        row = spark.sql(f"SELECT TIMESTAMP '{at} 05:00:00' AS ts, 'k' AS k, 1.0D AS value")
        row.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(row.schema).parquet(f"{tmp_path}/in")
        out = streams.closed_buckets(stream, "ts", "1 day", "1 day", ["k"], "value")
        job = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        job.awaitTermination()
        dropped.append(streams.dropped_as_late(job))
    assert dropped == [0, 0, 1]
