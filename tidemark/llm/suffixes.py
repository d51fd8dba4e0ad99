"""Repeated byte strings found by sorting suffixes bucket by bucket, with long ties resolved by cover samples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, pa_schema
from tidemark.llm.repeats import BASES, _BYTE, byte_units, candidates, everywhere, hot_names, measured, repeated_samples, samples, split_copies, unpack, window_hash, within
from tidemark.session import cut_lineage

LENGTH = 50
#: Bytes of a cover sample; the others of ``LENGTH`` are how far it may lie from the start.
SAMPLE = 20
ROWS = 64
#: Suffixes that a task orders at once.
SLAB = 2_000_000

_SUFFIXES = "name bigint, doc_id bigint, c bigint, first int, count int, context binary"
_RUNS = "doc_id bigint, c bigint, start int, stop int"


def measure(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw


def suffixes(found: DataFrame, length: int, sample: int, hot: np.ndarray, of_hot: bool = False) -> DataFrame:
    """Of candidate texts the suffixes by the cover sample they stand by: rows of neighbouring starts.

    All suffixes that stand by one sample are one row: the sample's name is
    their bucket, ``context`` their bytes up to ``length``.  What a text repeats
    is given once, where it comes first.  Those of ``hot`` names alone, or the others.
    """

    def run(cols):
        numbers = {k: [np.zeros(0, np.int64)] for k in ("name", "doc_id", "c", "first", "count")}
        contexts = []
        for doc_id, c, z, names in zip(*(cols[k] for k in ("doc_id", "c", "z", "names"))):
            names = np.sort(np.array(names, np.int64))
            if of_hot and not within(names, hot).any():
                continue
            raw = unpack(z).encode()
            u = _BYTE[np.frombuffer(raw, np.uint8)]
            hashes = window_hash(u, sample)
            at = samples(u, length, sample, hashes)
            begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            name = hashes[at[begin]].view(np.int64)
            keep = within(name, names) & (within(name, hot) == of_hot)
            name, first, count = name[keep], begin[keep], np.diff(np.r_[begin, len(at)])[keep]
            found = [raw[s:e] for s, e in zip(first.tolist(), (first + count + (length - 1)).tolist())]
            places = {}
            for i, context in enumerate(found):
                places.setdefault(context, i)
            if len(places) < len(found):
                once = np.array(list(places.values()))
                name, first, count = name[once], first[once], count[once]
            contexts += places
            for column, value in zip(numbers.values(), (name, np.full(len(name), doc_id), np.full(len(name), c), first, count)):
                column.append(value)
        return {k: np.concatenate(v) for k, v in numbers.items()} | {"context": contexts}

    return map_rows(found, _SUFFIXES, run, ROWS)


def _expand(batch: pa.RecordBatch, length: int):
    """All suffixes of the rows of a batch, by row and start: two hashes of ``length`` bytes, row number, start."""
    first, count = (batch.column(n).to_numpy() for n in ("first", "count"))
    raw = np.frombuffer(b"".join(batch.column("context").to_pylist()), np.uint8)
    u = _BYTE[raw]
    rows = np.repeat(np.arange(len(first)), count)
    inside = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    spans = count + length - 1
    at = np.repeat(np.cumsum(spans) - spans, count) + inside
    return window_hash(u, length, mixed=False)[at], window_hash(u, length, BASES[1], False)[at], rows, first[rows] + inside


def _differ(*columns: np.ndarray) -> np.ndarray:
    """Which rows, after the first, are unlike the one before them."""
    return np.logical_or.reduce([x[1:] != x[:-1] for x in columns])


def _by_string(h: np.ndarray, g: np.ndarray, key: np.ndarray) -> np.ndarray:
    """An order with equal (h, g, key) next to each other: by ``h`` alone where that tells them apart."""
    order = np.argsort(h)
    mixed = ~_differ(h[order]) & _differ(g[order], key[order])
    return np.lexsort((g, h, key)) if mixed.any() else order


def _sort_buckets(length: int):
    """Over rows sorted by (name, doc_id): runs of starts whose string a smaller doc_id has in the same bucket.

    Equal strings stand by equal samples, so they meet in one bucket.  A bucket
    is put in order by the 128-bit names of its strings, equal ones next to each
    other.  Of a bucket that goes on into the next slab
    only its distinct strings with their smallest document are kept.
    """
    schema = pa_schema(_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, seen = None, {}
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                counts = np.cumsum(whole.column("count").slice(at).to_numpy())
                batch = whole.slice(at, max(1, int(np.searchsorted(counts, SLAB))))
                at += batch.num_rows
                name, doc = batch.column("name").to_numpy(), batch.column("doc_id").to_numpy()
                h, g, rows, start = _expand(batch, length)
                key = name[rows]
                order = _by_string(h, g, key)
                h, g, key, of = h[order], g[order], key[order], doc[rows[order]]
                new = np.r_[True, _differ(h, g, key)]
                least = np.minimum.reduceat(of, np.flatnonzero(new))
                group = np.cumsum(new) - 1
                if open_name is not None and name[0] == open_name:
                    for i in np.flatnonzero(new & (key == open_name)).tolist():
                        least[group[i]] = min(least[group[i]], seen.get((h[i], g[i]), least[group[i]]))
                else:
                    seen = {}
                if open_name != name[-1]:
                    seen = {}
                open_name = name[-1]
                for i in np.flatnonzero(new & (key == open_name)).tolist():
                    seen.setdefault((h[i], g[i]), least[group[i]])
                hit = np.sort(order[of > least[group]])
                rows, start = rows[hit], start[hit]
                begin = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (start[1:] != start[:-1] + 1)]) if len(rows) else np.zeros(0, np.int64)
                stop = start[np.r_[begin[1:], len(start)] - 1] if len(rows) else start
                of = rows[begin]
                yield pa.RecordBatch.from_arrays([pa.array(doc[of]), pa.array(batch.column("c").to_numpy()[of]), pa.array(start[begin].astype(np.int32)), pa.array(stop.astype(np.int32))], schema=schema)

    return run


def repeated_strings(docs: DataFrame, stats: DataFrame, length: int = LENGTH, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """Candidate texts (doc_id, c, z) and runs (doc_id, c, starts, stops) of starts whose string a smaller doc_id has."""
    hot = hot_names(docs, byte_units, measure, length, sample, ROWS)
    names = repeated_samples(docs, byte_units, measure, length, sample, ROWS, hot)
    found = candidates(docs, stats, names, measure, ROWS)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = lambda rows: rows.repartition(parts, "name").sortWithinPartitions("name", "doc_id").mapInArrow(_sort_buckets(length), _RUNS)
    runs = sort(suffixes(found, length, sample, hot))
    if len(hot):
        # In a bucket of many documents equal rows are first reduced to the least of them (combined before
        # the shuffle; adaptive execution splits what joins it): only that one has to be ordered with the others.
        common = suffixes(found, length, sample, hot, True).withColumn("h", F.xxhash64("context")).withColumn("g", F.unhex(F.md5("context")))
        same = ["name", "h", "g"]
        first = F.min_by(F.struct("doc_id", "c", "first", "count", "context"), "doc_id").alias("r")
        reps = cut_lineage(common.groupBy(*same).agg(first).select(*same, "r.*"))
        others = common.drop("context").join(reps.select(*same, F.col("doc_id").alias("least")), same).filter("doc_id > least")
        equal = others.select("doc_id", "c", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1).alias("stop"))
        ordered = reps.drop("h", "g")
        several = stats.groupBy("doc_id").agg((F.min("c") < F.max("c")).alias("several")).filter("several")
        if not several.isEmpty():  # other texts under the least doc_id are no later documents: they are ordered too
            twins = common.join(reps.select(*same, F.col("doc_id").alias("least"), F.col("c").alias("taken")), same)
            ordered = ordered.unionByName(twins.filter("doc_id = least AND c <> taken").select(*ordered.columns))
        runs = runs.unionByName(equal).unionByName(sort(ordered))
    # bounded by the bytes of one text
    return found.select("doc_id", "c", "z"), runs.groupBy("doc_id", "c").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``, and whether it is a whole copy.

    Each byte covered by a string of ``length`` bytes that also starts in a
    document with a smaller doc_id is removed; strings never cross documents.
    Null and empty texts have no bytes; copies of a text lose all bytes at once
    if it has a string of that length; rows with a null doc_id are left whole and
    take nothing from others; rows that repeat a doc_id are judged alike against
    smaller ids.  Extra columns are ignored.
    """
    stats = cut_lineage(measured(docs, measure, ROWS))
    stats = cut_lineage(split_copies(stats))
    texts, later = repeated_strings(docs, stats, length, sample)

    def cut(cols):
        removed, spans, sha = [], [], []
        for z, starts, stops in zip(cols["z"], cols["starts"], cols["stops"]):
            raw = np.frombuffer(unpack(z).encode(), np.uint8)
            starts, n = np.array(starts, np.int64), np.array(stops, np.int64) - starts + 1
            at = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
            at = np.flatnonzero(everywhere(window_hash(_BYTE[raw], length), at))
            gone = np.zeros(len(raw) + 1, np.int64)
            gone[at] += 1
            gone[at + length] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            sha.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
        return {"doc_id": cols["doc_id"], "c": cols["c"], "removed": removed, "spans": spans, "kept": sha}

    schema = "doc_id bigint, c bigint, removed bigint, spans bigint, kept string"
    changed = map_rows(texts.join(later, ["doc_id", "c"]), schema, cut, ROWS).dropDuplicates(["doc_id", "c"])
    whole = F.col("copy") & (F.col("n") >= length)
    zero = F.lit(0).cast("bigint")
    out = stats.join(changed, ["doc_id", "c"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(whole, F.col("n")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(whole, zero + 1).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"), F.col("copy").alias("is_copy"),
    )
