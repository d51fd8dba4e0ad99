import os
import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from scripts.check_oracle import canonical
from tidemark.llm import packing, queries

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, and of each kind that a stage catches a few."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    clean = {i: text(rng.randint(60, 300)) for i in range(400)}
    rows = dict(clean)
    rows[500] = rows[3]
    rows[501] = rows[4].replace(rows[4].split()[30], "changed", 1)
    items = [(1, text(30)), (2, text(12))]
    rows[502] = text(40) + " " + items[0][1].upper() + " " + text(40)
    rows[503] = text(70) + "\ntoken = abcdefghij1234567890 " + text(20)
    rows[504] = "too short"
    rows[505] = " ".join(w + "%&$" for w in text(90).split())
    rows[506] = None
    path = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in rows.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_stages_catch_what_is_planted_and_keep_clean_documents(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = set(rows)
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:4], [{504, 505, 506}, {500, 501}, {502}, set()]):
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        left -= gone
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "[assign]" in texts[503] and "abcdefghij" not in texts[503]
    assert all(texts[i] == rows[i] for i in left - {503})
    packed = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in packed} == left
    assert sum(r.length for r in packed) == sum(len(packing.encode(t)) // 4 + 1 for t in texts.values())


def test_rows_are_judged_one_by_one_whatever_their_doc_ids_are(spark, folder, tmp_path):
    path, rows = folder
    texts = {i: rows[i] for i in range(300)}
    odd = [(None, rows[504]), (None, rows[502]), (None, rows[7]), (8, rows[8]), (8, rows[8]), (9, rows[504]), (10, rows[502])]
    docs = spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in [*texts.items(), *odd]], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, path)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(texts.items())


def test_every_query_of_the_subpackage_is_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "best-fit packing" and len(corpus_pipeline.STAGES) == 5


def test_empty_documents_pass_all_stages(spark, folder, tmp_path):
    path, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_run_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    for name, query in queries.QUERIES.items():
        rows = query(spark, folder).count()
        if name.startswith("op12_"):  # words, not documents
            assert rows > 0
        elif name.startswith("op13_"):
            assert rows == vectors
        else:
            assert rows >= n if name.startswith("op4_") else rows == n, name


def test_sql_of_the_operators(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    for name, sql in queries.ORACLE.items():
        got, want = queries.QUERIES[name](spark, folder).toPandas(), con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want), name


def test_columns_of_any_name_pass_through_the_stages(spark, folder, tmp_path):
    path, rows = folder
    names = ["row_of_stage", "file_of_row", "place_of_row", "rank_of_file", "kept_row", "rejected_id", "_file", "_place", "_rank", "scope", "node", "label", "h", "row", "x0"]
    some = [(i, t, "en", "s0", len(t or ""), *[f"{n}{i}" for n in names]) for i, t in rows.items() if i < 60 or i >= 500]
    docs = spark.createDataFrame(some, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
    kept = docs.collect()
    assert len(kept) >= 55 and all(r[n] == f"{n}{r.doc_id}" for r in kept for n in names)
    assert corpus_pipeline.best_fit_packing(spark, docs, path).count() >= len(kept)


def test_texts_are_not_shuffled_for_the_keys_of_rows(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no estimate were small
    try:
        rows, row = corpus_pipeline._rows(docs)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows.select(row).distinct().count() == rows.count()


def test_written_results_leave_no_shuffle_files(spark, tmp_path):
    from tidemark import session

    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    try:
        with session.shuffles_dropped(spark):
            assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
    sums = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    written = session.cut_lineage(sums)
    assert written.count() == sums.count() == session.cut_lineage(sums).count()
