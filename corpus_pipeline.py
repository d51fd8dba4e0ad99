"""A corpus pipeline over ``documents``: every stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, quality, secret_scan, simhash
from tidemark.llm.common import broadcast_if_small
from tidemark.session import cut_lineage, scratch_path


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores where ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, and the name of that key: the rank of its file and its place there.

    What is in no files is written first.
    """
    row, file, place, rank = (_unused(docs, n) for n in ("row_of_stage", "file_of_row", "place_of_row", "rank_of_file"))
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        # a column called _metadata hides the rows' own
        hidden = docs.columns
        written = cut_lineage(docs.toDF(*(f"c{i}" for i in range(len(hidden)))))
        placed = written.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(hidden)), F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    # one row a file; written, so that texts are not shuffled by their file to meet the few ranks
    ranks = broadcast_if_small(cut_lineage(placed.select(file).distinct().withColumn(rank, F.row_number().over(Window.orderBy(file)).cast("bigint"))))
    return placed.join(ranks, file).select(*docs.columns, (F.shiftleft(rank, 40) + F.col(place)).alias(row)), row


def _named(rows: DataFrame, row: str) -> DataFrame:
    """``rows`` as the operators judge them, each under a doc_id of its own."""
    return rows.withColumn("doc_id", F.col(row))


def _without(rows: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    """``rows`` but for those whose keys are ``rejected``, whatever their doc_ids are."""
    name = _unused(rows, "rejected_id")
    # written, so that its size is known before the join and texts need not be shuffled where few go
    names = cut_lineage(rejected.select(F.col("doc_id").alias(name)))
    return rows.join(names, F.col(row) == F.col(name), "left_anti").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go.

    Null and empty texts have no words and go; repeated rows are judged alike,
    each for itself; an empty table stays empty; other columns are kept, whatever their names.
    """
    rows, row = _rows(docs)
    return _without(rows, row, quality.quality(_named(rows, row)).filter("NOT kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (Jaccard 0.8 on five-word shingles) the row with the smallest doc_id stays.

    Among rows of that doc_id the first of the input stays; rows without a doc_id come after all others.
    Null and empty texts are alike and one of them stays; other columns are kept, whatever their names.
    """
    rows, row = _rows(docs)
    found = simhash.near_duplicates(_named(rows, row), **simhash.SIMILAR).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), F.col(row).alias("row"))
    named = found.join(rows.select("doc_id", row), row).select("component_id", order.alias("o"))
    first = named.groupBy("component_id").agg(F.min("o").alias("first"))
    # components have a name, but for rows without a doc_id that are like no other
    others = named.join(first, named["component_id"].eqNullSafe(first["component_id"])).filter("o <> first")
    return _without(rows, row, others.select(F.col("o.row").alias("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go.

    Null and empty texts hit nothing and stay; each row is judged for itself;
    an empty benchmark lets all stay; other columns are kept, whatever their names.
    """
    rows, row = _rows(docs)
    found = decontaminate.contamination(_named(rows, row), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, row, found.filter("contaminated"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by their kind; no document goes and null texts stay null."""
    return secret_scan.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences; null and empty texts are the closing id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: The stages hash, iterate and tokenize; no SQL gives their rows, so tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
