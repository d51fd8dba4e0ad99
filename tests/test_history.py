"""Merge, validation, snapshots, vintages, sinks and readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H, snapshots, validate as V, vintage
from tidemark.session import literal_table, scratch_path
from tidemark.sources import dims, readers, sinks


def records(spark, rows):
    """(metric, geo, period, value, seq) to canonical records."""
    df = spark.createDataFrame(rows, "metric_id string, geo_id string, period string, value double, seq long")
    return H.canonicalise(df.withColumns({"unit": F.lit("u"), "source_id": F.lit("s")}), "2026-08-01")


def test_merge_cases(spark):
    log = records(spark, [("m", "mun-00001", "2026-01", 100.0, 1), ("m", "mun-00001", "2026-02", 100.0, 2), ("m", "mun-00001", "2026-03", 100.0, 3)])
    batch = records(
        spark,
        [
            ("m", "mun-00001", "2026-01", 100.0000000001, 1), ("m", "mun-00001", "2026-02", 105.0, 2), ("m", "mun-00001", "2026-02", 999.0, 3),
            ("m", "mun-00001", "2026-04", 7.0, 4),
        ],
    )
    allowed = {r["period"]: (r["action"], r["value"], r["revision"]) for r in H.merge(log, batch, True).collect()}
    assert allowed == {"2026-01": ("unchanged", 100.0000000001, 0), "2026-02": ("revised", 105.0, 1), "2026-04": ("added", 7.0, 0)}
    refused = H.merge(log, batch, False)
    q = H.quarantined(refused).collect()
    assert [(r["period"], r["prior_value"], r["reason"]) for r in q] == [("2026-02", "100", "unexpected_revision")]
    # Merging the same batch again changes nothing.
    after = log.unionByName(H.appended(H.merge(log, batch, True)))
    assert H.appended(H.merge(after, batch, True)).count() == 0
    now = {r["period"]: (r["value"], r["quality_flag"]) for r in H.current_view(after).collect()}
    assert now["2026-02"] == (105.0, "revised") and now["2026-03"] == (100.0, "ok")


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = records(spark, [("m", "mun-00001", f"2026-{i:02d}", float(i), i) for i in range(1, 13)])
    columns = ["metric_id", "geo_id", "period", "revision", "value"]
    a = H.fingerprint(df, columns).first()
    assert a == H.fingerprint(df.repartition(5).orderBy(F.rand(2)), columns).first()
    assert a != H.fingerprint(df.withColumn("value", F.col("value") + 1e-3), columns).first()


def test_validation_reasons_and_gate(spark):
    metrics = literal_table(spark, dims.METRIC_SCHEMA, [("m", "M", "u", "monthly", "municipality", "s", "x", 1, 0.0, 50.0)])
    rec = records(spark, [("m", "mun-00001", "2026-01", 50.0, 1), ("m", "mun-00001", "2026-02", 51.0, 2), ("k", "mun-00001", "2026-03", 1.0, 3), ("m", "prov-01", "2026-04", 1.0, 4), ("m", "mun-00001", "2026", 1.0, 5)])
    checked = V.with_reason(rec, metrics)
    assert {r["seq"]: r["reason"] for r in checked.collect()} == {1: None, 2: "out_of_range", 3: "unknown_metric", 4: "wrong_level", 5: "bad_period"}
    assert V.batch_gate(checked).first()["passes"] is False
    assert V.admitted(checked).count() == 0
    assert V.admitted(checked, max_reject_ratio=0.9).count() == 1
    wide = literal_table(spark, "source_id string, metric_id string, lo double, hi double", [("s", "m", 0.0, 60.0)])
    assert V.keep_valid(rec, metrics, wide).count() == 3


def test_incomplete_tail(spark, series):
    values = {i: 100.0 for i in range(20)} | {20: 90.0, 21: 30.0, 22: 5.0}
    df = series({("m", "g"): values}).withColumn("source_id", F.lit("s"))
    assert V.drop_incomplete_tail(df).agg(F.max("pidx")).first()[0] == 20
    short = df.where("pidx >= 11")
    assert V.drop_incomplete_tail(short).count() == short.count()


def test_snapshots_replay_equals_state(spark):
    schema = "id string, kind string, district string, state string"
    a = spark.createDataFrame([("1", "561", "01", "open"), ("2", "471", "02", "open"), ("3", "563", "01", "closed"), ("4", "1", "03", "open")], schema)
    b = spark.createDataFrame([("1", "561", "01", "closed"), ("2", "563", "02", "open"), ("4", "1", "03", "open"), ("5", "561", "02", "open")], schema)
    cols = ["kind", "district", "state"]
    d = snapshots.diff(a, b, "id", cols, "state")
    assert {r["id"]: r["change"] for r in d.collect()} == {"1": "state_changed", "2": "attributes_changed", "3": "removed", "5": "added"}
    back = snapshots.replay(a, d.withColumn("pidx", F.lit(1)), 1, "id", cols)
    assert sorted(back.collect()) == sorted(b.select("id", *cols).collect())
    marked = lambda k: k.startswith("561") | k.startswith("563")
    flows = {r["district"]: (r["openings"], r["closures"], r["marked_openings"], r["marked_closures"]) for r in snapshots.flow_counts(d, "district", "open", "state", "kind", marked).collect()}
    assert flows == {"01": (0, 1, 0, 1), "02": (1, 0, 2, 0)}


def test_vintages(spark):
    rec = records(spark, [("m", "mun-00001", "2026-01", 1.0, 1), ("m", "mun-00001", "2026-01", 2.0, 2)])
    rec = rec.withColumns({"revision": (F.col("seq") - 1).cast("int"), "published_at": F.when(F.col("seq") == 2, F.lit(dt.date(2026, 6, 1)))})
    dated = vintage.with_known_from(rec, literal_table(spark, "source_id string, days int", [("s", 45)]))
    assert vintage.as_of(dated, "2026-03-16").count() == 0
    assert vintage.as_of(dated, "2026-03-17").first()["value"] == 1.0
    assert vintage.as_of(dated, "2026-06-01").first()["value"] == 2.0
    many = {str(r["as_of"]): r["value"] for r in vintage.as_of_many(dated, ["2026-01-01", "2026-04-01", "2026-07-01"]).collect()}
    assert many == {"2026-04-01": 1.0, "2026-07-01": 2.0}


def test_history_sink_replaces_only_its_partitions(spark):
    path = scratch_path(spark, "t")
    sinks.write_history(records(spark, [("a", "mun-00001", "2026-01", 1.0, 1), ("b", "mun-00001", "2026-01", 1.0, 2)]), path)
    sinks.write_history(records(spark, [("b", "mun-00001", "2026-01", 5.0, 1)]), path)
    assert {r["metric_id"]: r["value"] for r in readers.read_table(spark, path).collect()} == {"a": 1.0, "b": 5.0}
    plan = readers.read_table(spark, path, "s", "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_id" in plan


def test_csv_history_reader(spark):
    root = scratch_path(spark, "csv")
    spark.createDataFrame([("m", "mun-00001", "", "2026-01", "1.5", "u", "s", "2026-01-31", "", "2026-02-01", "", "")], readers.HISTORY_TEXT).write.option("header", True).csv(f"{root}/s")
    row = readers.read_history(spark, root).first()
    assert (row["value"], row["geo_level"], row["revision"], row["quality_flag"], row["published_at"]) == (1.5, "municipality", 0, "ok", None)


def test_delimited_reader_finds_columns_by_name(spark):
    path = scratch_path(spark, "latin")
    table = spark.createDataFrame([("Málaga", "x", "3")], "`Name` string, `Other` string, `N` string").coalesce(1)
    table.write.option("encoding", "ISO-8859-1").option("sep", ";").option("header", True).csv(path)
    got = readers.read_delimited(spark, path, {"N": "n", "name": "place"}, encoding="ISO-8859-1").collect()
    assert [(r["n"], r["place"]) for r in got] == [("3", "Málaga")]


def test_gazette_paragraphs(spark):
    text = '<documento><p class="parrafo"> Constitución. <b>X</b></p><p class="parrafo">Extinción y declaración\nde concurso</p><p class="parrafo">declaracion de concurso</p></documento>'
    docs = spark.createDataFrame([("28", text)], "province string, text string")
    rows = readers.paragraphs(docs, ["province"], "text", readers.GAZETTE_PARAGRAPH)
    kinds = readers.event_kinds(rows, ["province"], readers.GAZETTE_KINDS).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in kinds} == {"company_incorporations": 1, "company_dissolutions": 1, "insolvencies": 1}


def test_write_once(spark):
    path = scratch_path(spark, "frozen")
    a = spark.createDataFrame([("t", "g", 1, 5.0)], "target_id string, geo_id string, from_pidx int, p50 double")
    sinks.freeze_forecasts(a, None, path)
    b = spark.createDataFrame([("t", "g", 1, 9.0), ("t", "g", 2, 6.0)], a.schema)
    sinks.freeze_forecasts(b, spark.read.parquet(path), path)
    assert sorted((r["from_pidx"], r["p50"]) for r in spark.read.parquet(path).collect()) == [(1, 5.0), (2, 6.0)]


@pytest.mark.parametrize("recheck,expected", [(0, [1, 2, 6]), (2, [1, 2, 5, 6])])
def test_periods_to_fetch(spark, recheck, expected):
    avail = spark.createDataFrame([("s", i) for i in range(1, 7)], "source_id string, pidx int")
    stored = spark.createDataFrame([("s", 3), ("s", 5)], "source_id string, pidx int")
    assert sorted(r["pidx"] for r in H.periods_to_fetch(avail, stored, recheck).collect()) == expected


def test_null_source_is_wrong_source(spark):
    from tidemark.operators.validate import with_reason

    metrics = spark.createDataFrame([("m", "u", "monthly", "municipality", "s", 0.0, 9.0)], "metric_id string, unit string, cadence string, geo_level string, source_id string, lo double, hi double")
    rows = [("m", "mun-00001", "municipality", "2001-01", 1.0, "u", None), ("m", "mun-00001", "municipality", "2001-01", 1.0, "u", "s")]
    records = spark.createDataFrame(rows, "metric_id string, geo_id string, geo_level string, period string, value double, unit string, source_id string")
    got = {r["source_id"]: r["reason"] for r in with_reason(records, metrics).collect()}
    assert got == {None: "wrong_source", "s": None}


def test_a_batch_reads_only_its_months_of_the_stored_log(spark):
    log = records(spark, [("m", "mun-00001", f"{y}-{m:02d}", float(m), 12 * y + m) for y in (2024, 2025) for m in range(1, 13)])
    path = scratch_path(spark, "log")
    H.write_log(log, path)
    batch = records(spark, [("m", "mun-00001", "2025-03", 9.0, 1), ("m", "mun-00001", "2026-01", 1.0, 2)])
    decided = H.merge_stored(path, batch, True)
    assert {r.period: (r.action, r.prior_value, r.revision) for r in decided.collect()} == {"2025-03": ("revised", 3.0, 1), "2026-01": ("added", None, 0)}
    schema = log.withColumn("stored", F.lit("")).schema
    read = H.touched_log(spark.read.schema(schema).parquet(path), batch)
    assert "PartitionFilters: [" in (plan := read._jdf.queryExecution().executedPlan().toString()) and "2025-03" in plan
    assert read.select(F.input_file_name().alias("f")).distinct().count() == 1 and read.count() == 1


def test_later_rows_win_on_any_number_of_partitions(spark, tmp_path):
    for name, value in (("a", 1.0), ("b", 2.0)):
        rows = [("m", "mun-00001", "2026-01", value + i / 10) for i in range(5)]
        spark.createDataFrame(rows, "metric_id string, geo_id string, period string, value double").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    for partitions in (1, 7):
        raw = spark.read.parquet(f"{tmp_path}/a", f"{tmp_path}/b").withColumns({"unit": F.lit("u"), "source_id": F.lit("s")})
        rec = H.canonicalise(raw, "2026-08-01").repartition(partitions)
        assert rec.select("seq").distinct().count() == 10
        assert H.current_view(rec).first()["value"] == 2.4 and H.first_in_batch(rec).first()["value"] == 1.0
    again = H.canonicalise(raw, "2026-08-01", batch=3)
    assert again.agg(F.min("seq")).first()[0] > rec.agg(F.max("seq")).first()[0]


def test_rows_of_text_files_keep_their_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # files are split
    try:
        for name, n in (("b", 700), ("a", 300)):
            (tmp_path / f"{name}.csv").write_text("".join(f"{name},{i}\n" for i in range(n)))
        text = spark.read.schema("f string, n int").csv(str(tmp_path))
        assert text.rdd.getNumPartitions() > 2
        rows = H.with_ingest_order(text).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.f, r.n) for r in rows] == [("a", i) for i in range(300)] + [("b", i) for i in range(700)]
