"""Benchmark decontamination: a broadcast hash set of test n-grams, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, is_small
from tidemark.session import cut_lineage

#: Words of a window.
N = 10
#: The hash set is broadcast up to so many windows (8 bytes each and the table's overhead,
#: about 100 MB), beyond that the windows meet in a shuffled join.
SET_ROWS = 2_000_000


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def _windows(array: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words; none if there are fewer words."""
    starts = F.when(F.size(array) >= n, F.sequence(F.lit(1), F.size(array) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(array, i, n)))


def test_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, h, gram) of the distinct windows of each item; a shorter item with words is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.explode(F.array(words(F.col("text")))).alias("w")).filter("size(w) > 0")
    grams = F.expr(f"transform(sequence(1, greatest(size(w) - {n - 1}, 1)), i -> slice(w, i, {n}))")
    return items.select("item_id", F.explode(grams).alias("gram")).distinct().select("item_id", F.xxhash64("gram").alias("h"), "gram")


def hits(docs: DataFrame, windows: DataFrame, set_rows: int = SET_ROWS) -> DataFrame:
    """(doc, n_words, at, h, gram): one row at=-1 for each row of ``docs`` and one for each verified window at word ``at``.

    ``doc`` numbers the rows.  The words of a document are hashed in windows of
    every length that ``windows`` has and looked up in the hash set; what the
    set admits is compared word by word.
    """
    grams = cut_lineage(windows.select("h", "gram").distinct())
    lengths = sorted(r[0] for r in grams.select(F.size("gram")).distinct().collect())  # at most N numbers
    # the lambda binds the words, so that a text is split once and not for every window;
    # hash 0 stands for the document itself and finds the set's extra element
    zero = F.array(F.lit(0).cast("bigint"))
    split = F.transform(F.array(words(F.col("text"))), lambda w: F.struct(w.alias("w"), F.concat(zero, *(_windows(w, n) for n in lengths)).alias("hashes")))
    hash_words = lambda rows: rows.select("doc", F.inline(split))
    keys = grams.select("h").union(docs.sparkSession.range(1).select(F.lit(0).cast("bigint"))).distinct()
    if is_small(keys, set_rows):
        found = hash_words(docs).select("doc", "w", F.posexplode("hashes").alias("pos", "h")).join(F.broadcast(keys), "h")
    else:  # only numbers are shuffled for every window; the words join what was found
        numbered = cut_lineage(docs.select("doc", "text"))
        found = hash_words(numbered).select("doc", F.posexplode("hashes").alias("pos", "h")).join(keys, "h")
        found = found.join(hash_words(numbered).select("doc", "w"), "doc")
    at, before = F.lit(-1), F.lit(0)
    length = F.lit(0)
    for n in lengths:
        inside = (F.col("pos") > before) & (F.col("pos") <= before + F.greatest(F.size("w") - (n - 1), F.lit(0)))
        at = F.when(inside, F.col("pos") - 1 - before).otherwise(at)
        length = F.when(inside, F.lit(n)).otherwise(length)
        before = before + F.greatest(F.size("w") - (n - 1), F.lit(0))
    found = found.select("doc", F.size("w").alias("n_words"), at.alias("at"), "h", F.when(F.col("pos") > 0, F.slice("w", at + 1, F.greatest(length, F.lit(1)))).alias("gram"))
    found = cut_lineage(found)
    real = found.filter("at >= 0").join(broadcast_if_small(grams.withColumnRenamed("gram", "item_gram"), set_rows // 10), "h").filter("gram = item_gram").drop("item_gram")
    return found.filter("at < 0").unionByName(real)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, set_rows: int = SET_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    A word is hit inside any occurrence of a window of ``n`` words of a benchmark
    item (an item of fewer words is one window).  Null and empty texts have no
    words and hit nothing; items without words have no windows; rows that repeat
    a doc_id are counted alone, each with its own result.  Extra columns of
    either table are ignored, and an empty benchmark hits nothing.
    """
    rows = docs.select("doc_id", "text").withColumn("doc", F.struct(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("id")))
    windows = cut_lineage(test_windows(benchmark, n))
    found = cut_lineage(hits(rows, windows, set_rows))
    real = found.filter("at >= 0").withColumn("end", F.col("at") + F.size("gram"))
    # words of a window that no earlier window of the document reaches
    reached = F.expr("coalesce(max(end) OVER (PARTITION BY doc ORDER BY at, end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    covered = real.withColumn("new", F.greatest(F.col("end") - F.greatest("at", reached), F.lit(0))).groupBy("doc").agg(F.sum("new").alias("n_hit"))
    items = real.select("doc", "h", "gram").distinct().join(broadcast_if_small(windows, set_rows // 10), ["h", "gram"]).select("doc", "item_id").distinct()
    named = items.groupBy("doc").agg(F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("item_id"))), 256).alias("items_sha256"))
    base = found.filter("at < 0").select("doc", "n_words")
    out = base.join(covered, "doc", "left").join(named, "doc", "left")
    zero = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c)
    return out.select(
        F.col("doc.id").alias("doc_id"), F.col("n_words").cast("bigint").alias("n_words"), zero("n_hit"), zero("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
