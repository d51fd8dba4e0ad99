"""Repeated word windows found level by level: only what repeats at one length is extended to twice that."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, words_of
from tidemark.llm.repeats import BASES, candidates, everywhere, hot_names, measured, repeated_samples, samples, split_copies, unpack, window_hash, word_units
from tidemark.session import cut_lineage

WINDOW = 13
ROWS = 256


def measure(text: str | None) -> tuple[int, bytes]:
    words = words_of(text)
    return len(words), b" ".join(words)


def levels(window: int, first: int = 8) -> list[int]:
    """Lengths from ``first``, doubled until ``window``; 13 is reached in one step from 8."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _survivors(found: DataFrame, level: int, window: int) -> DataFrame:
    """Of rows (doc_id, c, z, alive, names) those again with the names at ``level`` that repeat."""

    def name(cols):
        rows = {"name": [], "c": []}
        for c, z, alive in zip(cols["c"], cols["z"], cols["alive"]):
            u = word_units(unpack(z))
            at = np.unique(samples(u, window, level)[np.array(alive, np.int64)]) if alive else []
            if len(at):
                found = np.unique(window_hash(u, level)[at]).view(np.int64)
                rows["name"].append(found)
                rows["c"].append(np.full(len(found), c))
        return {k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in rows.items()}

    each = map_rows(found.select("c", "z", "alive"), "name bigint, c bigint", name, ROWS)
    apart = each.withColumn("low", F.expr("min(c) OVER (PARTITION BY name)")).withColumn("high", F.expr("max(c) OVER (PARTITION BY name)")).filter("low < high")
    return cut_lineage(found.drop("names").join(apart.groupBy("c").agg(F.collect_set("name").alias("names")), "c"))


def _alive(cols, level: int, window: int):
    """For each row the units and the starts of the windows whose sample at ``level`` is among the names."""
    for i, z in enumerate(cols["z"]):
        u = word_units(unpack(z))
        at = samples(u, window, level)
        ok = np.isin(window_hash(u, level)[at], np.array(cols["names"][i], np.int64).view(np.uint64))
        if cols["alive"][i] is not None:
            before = np.zeros(len(ok), bool)
            before[np.array(cols["alive"][i], np.int64)] = True
            ok &= before
        yield u, np.flatnonzero(ok)


def repeated_windows(docs: DataFrame, stats: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Candidate texts (doc_id, c, z) and the windows (doc_id, tag, starts) that a smaller doc_id has as well.

    ``tag`` is the upper half of ``c``; it travels in one number with the start.
    A window that a text repeats travels once, by its first start.

    At each level every window stands by one run of that many words in it (its
    sample); runs found in a single text end the windows that stand by them, and
    only the others are extended to twice the length, until the full length is
    named by 128 bits or no window is left.
    """
    ladder = levels(window)
    hot = hot_names(docs, word_units, measure, window, ladder[0], ROWS)
    names = repeated_samples(docs, word_units, measure, window, ladder[0], ROWS, hot)
    found = candidates(docs, stats, names, measure, ROWS).withColumn("alive", F.lit(None).cast("array<int>"))
    for before, level in zip(ladder, ladder[1:-1]):

        def extend(cols, before=before):
            return {k: cols[k] for k in ("doc_id", "c", "z", "names")} | {"alive": [a.tolist() for _, a in _alive(cols, before, window)]}

        longer = cut_lineage(map_rows(found, "doc_id bigint, c bigint, z binary, names array<bigint>, alive array<int>", extend, ROWS))
        found = _survivors(longer, level, window)
    last = ladder[-2] if len(ladder) > 1 else ladder[0]

    def full(cols, of_hot=None):
        """The windows still alive; of those that stand by a hot name in the first level only these or only the others."""
        parts = {"h": [], "g": [], "doc_id": [], "at": []}
        if of_hot and len(ladder) == 2:  # the names at hand are those of the first level
            some = [i for i, names in enumerate(cols["names"]) if np.isin(names, hot).any()]
            cols = {k: [v[i] for i in some] for k, v in cols.items()}
        for doc_id, c, (u, at) in zip(cols["doc_id"], cols["c"], _alive(cols, last, window)):
            if of_hot is not None:
                by = window_hash(u, ladder[0])[samples(u, window, ladder[0])[at]].view(np.int64)
                at = at[np.isin(by, hot) == of_hot]
            h, first = np.unique(window_hash(u, window)[at], return_index=True)
            at = at[first]
            for key, value in zip(parts, (h.view(np.int64), window_hash(u, window, BASES[1])[at].view(np.int64), np.full(len(at), doc_id), (c >> 32 << 32) + at)):
                parts[key].append(value)
        return {k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in parts.items()}

    schema = "h bigint, g bigint, doc_id bigint, at bigint"
    each = map_rows(found, schema, partial(full, of_hot=False) if len(hot) else full, ROWS)
    later = each.withColumn("least", F.expr("min(doc_id) OVER (PARTITION BY h, g)")).filter("doc_id > least").drop("least")
    if len(hot):
        # the least document is combined before the shuffle, and adaptive execution splits what joins it
        common = map_rows(found, schema, partial(full, of_hot=True), ROWS)
        least = common.groupBy("h", "g").agg(F.min("doc_id").alias("least"))
        later = later.unionByName(common.join(least, ["h", "g"]).filter("doc_id > least").drop("least"))
    # bounded by the words of one text
    starts = F.collect_set((F.col("at") - F.shiftleft(F.shiftright("at", 32), 32)).cast("int")).alias("starts")
    return found.select("doc_id", "c", "z"), later.groupBy("doc_id", F.shiftright("at", 32).alias("tag")).agg(starts)


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``, and whether it is a whole copy.

    Each word inside a window of ``window`` words that also starts in a document
    with a smaller doc_id is removed.  Null and empty texts have no words; copies
    of a text lose all their words at once if it has a window; rows with a null
    doc_id are left whole and take nothing from others; rows that repeat a doc_id
    are judged alike against smaller ids.  Extra columns are ignored.
    """
    stats = cut_lineage(measured(docs, measure, ROWS))
    stats = cut_lineage(split_copies(stats))
    texts, later = repeated_windows(docs, stats, window)

    def cut(cols):
        removed, sha = [], []
        for z, starts in zip(cols["z"], cols["starts"]):
            words = words_of(unpack(z))
            gone = np.zeros(len(words) + 1, np.int64)
            starts = np.flatnonzero(everywhere(window_hash(word_units(unpack(z)), window), starts))
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).hexdigest())
        return {"doc_id": cols["doc_id"], "c": cols["c"], "removed": removed, "kept": sha}

    tagged = texts.withColumn("tag", F.shiftright("c", 32)).join(later, ["doc_id", "tag"])
    changed = map_rows(tagged, "doc_id bigint, c bigint, removed bigint, kept string", cut, ROWS).dropDuplicates(["doc_id", "c"])
    whole = F.col("copy") & (F.col("n") >= window)
    out = stats.join(changed, ["doc_id", "c"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_words"), F.when(whole, F.col("n")).otherwise(F.coalesce("removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"), F.col("copy").alias("is_copy"),
    )
