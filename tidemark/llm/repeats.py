"""What the two substring operators share: units, window hashes, packed texts, repeated samples."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cache

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows
from tidemark.session import cut_lineage

#: Names that many contents have are looked for in every ``HOT_SAMPLE``-th document: at most
#: ``HOT_NAMES``, in ``HOT_CONTENTS`` sampled contents each.  They decide how work is dealt, not its result.
HOT_SAMPLE, HOT_NAMES, HOT_CONTENTS = 32, 1000, 100
SALTS = 64
#: Units whose window hashes are taken at once; the arrays for so many stay in a core's cache.
BLOCK = 16_384
#: Odd multipliers of the two window hashes that together name a window.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


def byte_units(text: str | None) -> np.ndarray:
    """A 64-bit number for each byte of the UTF-8 text."""
    return _BYTE[np.frombuffer((text or "").encode(), np.uint8)]


def word_units(text: str | None) -> np.ndarray:
    """A 64-bit number for each word ``[^\\x20\\x09-\\x0D]+``."""
    words = text.encode().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@cache
def _powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Modulo 2^64 the powers of an odd ``base`` from ``length`` - 1 on, and those of its inverse from 0 on."""
    falling = np.full(BLOCK + length - 1, pow(base, -1, 2**64), np.uint64)
    rising = np.full(BLOCK, base, np.uint64)
    falling[0], rising[0] = 1, pow(base, length - 1, 2**64)
    return np.cumprod(rising), np.cumprod(falling)


def window_hash(units: np.ndarray, length: int, base: int = BASES[0], mixed: bool = True) -> np.ndarray:
    """The polynomial hash modulo 2^64 of every run of ``length`` units, as differences of running sums.

    Mixed, unless only asked for equality, which mixing does not change.
    """
    out = np.empty(max(0, len(units) - length + 1), np.uint64)
    rising, falling = _powers(base, length)
    for at in range(0, len(out), BLOCK):
        part = units[at : at + BLOCK + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * falling[: len(part)], out=sums[1:])
        n = len(part) - length + 1
        np.multiply(sums[length:] - sums[:n], rising[:n], out=out[at : at + n])
    return mix(out) if mixed else out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours; by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def samples(units: np.ndarray, window: int, gram: int, hashes: np.ndarray | None = None) -> np.ndarray:
    """For every window of ``window`` units the position of its sample: its least-hashed run of ``gram`` units.

    Equal windows have their sample at the same place, so the samples are a
    cover: whatever is repeated has a sample that is repeated.  Positions never
    fall from one window to the next.  ``hashes`` are those of all runs, if at hand.
    """
    if len(units) < window:
        return np.zeros(0, np.int64)
    bits = np.uint64(int(len(units)).bit_length())
    hashes = window_hash(units, gram) if hashes is None else hashes
    ranked = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least(ranked, window - gram + 1)
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def within(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among the ``ordered`` values."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def everywhere(hashes: np.ndarray, starts: list[int]) -> np.ndarray:
    """Whether the window at each place of a text is one of those at ``starts``."""
    out = np.zeros(len(hashes), bool)
    out[np.array(starts, np.int64)] = True
    ordered = np.sort(hashes)
    # only a text that repeats a window has it elsewhere
    return within(hashes, np.unique(hashes[out])) if (ordered[1:] == ordered[:-1]).any() else out


def content_name(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content) - 2**63


def measured(docs: DataFrame, measure: Callable[[str | None], tuple[int, bytes]], rows: int = 256) -> DataFrame:
    """(doc_id, c, n, sha) of each row: content hash, size and digest."""

    def run(cols):
        contents = [measure(text) for text in cols["text"]]
        return {"doc_id": cols["doc_id"], "c": [content_name(x) for _, x in contents], "n": [n for n, _ in contents], "sha": [hashlib.sha256(x).hexdigest() for _, x in contents]}

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), "doc_id bigint, c bigint, n bigint, sha string", run, rows)


def packed(docs: DataFrame, measure: Callable[[str | None], tuple[int, bytes]], rows: int = 256) -> DataFrame:
    """(doc_id, c, z) of each row: content hash and compressed text."""

    def run(cols):
        z = zstandard.ZstdCompressor(level=1)
        return {"doc_id": cols["doc_id"], "c": [content_name(measure(t)[1]) for t in cols["text"]], "z": [z.compress((t or "").encode()) for t in cols["text"]]}

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), "doc_id bigint, c bigint, z binary", run, rows)


def unpack(z: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(z).decode() if z else ""


def hot_names(docs: DataFrame, units, measure, window: int, gram: int, rows: int) -> np.ndarray:
    """The sample names that most contents have, from every ``HOT_SAMPLE``-th document; sorted, a bounded number."""
    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    each = sample_names(part, units, measure, window, gram, rows).distinct()
    counts = each.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= HOT_CONTENTS)
    found = counts.orderBy(F.col("n").desc(), "name").limit(HOT_NAMES).collect()
    return np.sort(np.array([r["name"] for r in found], np.int64))


def sample_names(docs: DataFrame, units, measure, window: int, gram: int, rows: int, hot: np.ndarray | None = None) -> DataFrame:
    """(name, c) of the samples of each text; with ``hot`` names also ``salt``: 0, of a hot name 1 or more by content."""
    salted = hot is not None and len(hot) > 0

    def run(cols):
        name, c = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for text in cols["text"]:
            u = units(text)
            hashes = window_hash(u, gram)
            at = samples(u, window, gram, hashes)
            if len(at):
                found = np.unique(hashes[at[np.r_[True, at[1:] != at[:-1]]]])
                name.append(found)
                c.append(np.full(len(found), content_name(measure(text)[1])))
        out = {"name": np.concatenate(name).view(np.int64), "c": np.concatenate(c)}
        if salted:
            out["salt"] = np.where(within(out["name"], hot), 1 + out["c"] % SALTS, 0).astype(np.int32)
        return out

    return map_rows(docs.select(F.col("text").cast("string")), "name bigint, c bigint" + ", salt int" * salted, run, rows)


def repeated_samples(docs: DataFrame, units, measure, window: int, gram: int, rows: int, hot: np.ndarray = np.zeros(0, np.int64)) -> DataFrame:
    """(c, names): of each content the names of its samples that some other content has too.

    One shuffle of the samples by name; copies of a content count as one.  A hot
    name is known to repeat, so its rows are dealt by salt.
    """
    each = sample_names(docs, units, measure, window, gram, rows, hot)
    of = "PARTITION BY name, salt" if len(hot) else "PARTITION BY name"
    apart = each.withColumn("low", F.expr(f"min(c) OVER ({of})")).withColumn("high", F.expr(f"max(c) OVER ({of})"))
    apart = apart.filter("salt > 0 OR low < high" if len(hot) else "low < high")
    # a content has as many names as its text has samples at most
    return apart.groupBy("c").agg(F.collect_set("name").alias("names"))


def split_copies(stats: DataFrame) -> DataFrame:
    """``stats`` (doc_id, c, n, sha) with ``copy``: an equal text has a smaller doc_id."""
    least = stats.groupBy("c", "sha").agg(F.min("doc_id").alias("least"))
    return stats.join(least, ["c", "sha"]).withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).drop("least")


def candidates(docs: DataFrame, stats: DataFrame, names: DataFrame, measure, rows: int) -> DataFrame:
    """(doc_id, c, z, names) of the rows that can share a window with another content: no copies, no null ids."""
    wanted = stats.filter("NOT copy AND doc_id IS NOT NULL").select("doc_id", "c").distinct().join(names, "c")
    return cut_lineage(packed(docs, measure, rows).join(wanted, ["doc_id", "c"]))
