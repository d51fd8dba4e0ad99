"""SimHash near-duplicates found through deletion-variant signatures."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, map_rows, pa_schema
from tidemark.llm.components import components
from tidemark.session import cut_lineage

SEED = 42
#: Runs of one key shorter than this are compared pair by pair, longer ones by balls.
SHORT_RUN = 48
#: In dense runs whose links are checked afterwards a pivot takes what is within this part of the distance.
NEAR = 2 / 3
#: Pairs of one pivot that a task checks with one copy of the pivot's set.
DEALT = 4_096
#: Bits of a key below the number of its variant; no segment is wider.
KEY_BITS = 32
#: A task holds at most this many fingerprints of one key; longer runs meet block by block.
BLOCK = 16_384
#: Shingles are counted in one of so many components; those found in ``COMMON`` or more of these, the
#: most frequent ``COMMON_SHINGLES`` at most, come last in prefixes.
SAMPLED, COMMON, COMMON_SHINGLES = 32, 3, 200_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of the space-joined word shingles; fewer words than ``width``: of the whole sequence; no words: none."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    shingles = (joined[s:e] for s, e in zip(starts, ends[width - 1 :] or ends[-1:]))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, max(1, len(words) - width + 1))


def _mixed(h: np.ndarray, number: int) -> np.ndarray:
    """The hashes for the fingerprint's word ``number``: themselves, then 64-bit mixes of them."""
    if number:
        h = h + np.uint64(0x9E3779B97F4A7C15 * number % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def fingerprint(text: str | None, width: int, n_words: int = 1) -> np.ndarray:
    """The SimHash of word shingles as 64-bit words: a bit is set if over half the hashes have it; no words: zero."""
    hashes = shingle_hashes(text, width)
    out = np.zeros(n_words, np.uint64)
    for number in range(n_words if len(hashes) else 0):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 4096):
            bits = np.unpackbits(_mixed(hashes[at : at + 4096], number).view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
        out[number] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def _names(n_words: int) -> list[str]:
    return ["fp", *(f"fp{i}" for i in range(1, n_words))]


def fingerprints(docs: DataFrame, width: int, n_words: int = 1) -> DataFrame:
    """(doc_id, fp, fp1, ...) with 64 bits in each signed long."""
    names = _names(n_words)

    def run(cols):
        fps = np.array([fingerprint(t, width, n_words) for t in cols["text"]], np.uint64).reshape(-1, n_words).view(np.int64)
        return {"doc_id": cols["doc_id"]} | {name: fps[:, i] for i, name in enumerate(names)}

    schema = ", ".join(["doc_id bigint", *(f"{name} bigint" for name in names)])
    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), schema, run)


def segments(distance: int, bits: int = 64, count: int | None = None) -> list[tuple[int, int, int]]:
    """(word, shift, width) of ``count`` segments; as given by default, the fewest (two at least a word)
    of which one differs by at most one bit."""
    m = (count or max(2 * bits // 64, distance // 2 + 1)) * 64 // bits
    cuts = [64 * i // m for i in range(m + 1)]
    return [(w, a, b - a) for w in range(bits // 64) for a, b in zip(cuts, cuts[1:])]


def _part(f: np.ndarray, word: int, shift: int, width: int) -> np.ndarray:
    return (f[:, word] >> np.uint64(shift)) & np.uint64((1 << width) - 1)


def _apart(x: np.ndarray) -> np.ndarray:
    """Bits set in each row."""
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def _variants(f: np.ndarray, cuts: list[tuple[int, int, int]]) -> Iterator[np.ndarray]:
    """For every segment and bit the key of the segment with that bit left out."""
    number = 0
    for cut in cuts:
        part = _part(f, *cut)
        for bit in range(cut[2]):
            # the number of the variant above, the segment without the bit below
            yield ((part & ~np.uint64(1 << bit)) | np.uint64(number << KEY_BITS)).view(np.int64)
            number += 1


def _first_variant(x: np.ndarray, cuts: list[tuple[int, int, int]]) -> np.ndarray:
    """The number of the first variant that two fingerprints with difference ``x`` share."""
    out = np.full(len(x), -1, np.int64)
    base = 0
    for cut in cuts:
        part = _part(x, *cut)
        one = np.bitwise_count(part)
        bit = np.where(one == 0, 0, np.bitwise_count(part - (one > 0).astype(np.uint64)))
        out = np.where((out < 0) & (one <= 1), base + bit, out)
        base += cut[2]
    return out


def _ball_links(f: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) of a dense run that connect exactly what all of its pairs within ``k`` bits would.

    Pivots are chosen greedily, every member within ``k`` of one.  A member is
    linked once to each other ball it is near, and members of two balls still
    apart are compared if their pivots are within three times the distance.
    """
    label = np.arange(len(f))
    home = np.full(len(f), -1)
    left, right, pivots = [], [], []

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for p in range(len(f)):
        if home[p] >= 0:
            continue
        apart = _apart(f ^ f[p])
        home[(apart <= k) & (home < 0)] = len(pivots)
        pivots.append(p)
        near = np.flatnonzero(apart <= k)
        near = near[near != p]
        for q in near:
            a, b = find(p), find(q)
            if a != b:
                label[b] = a
                left.append(p)
                right.append(q)
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(len(pivots) + 1))
    pivots = np.array(pivots)
    for i, p in enumerate(pivots):
        for j in i + 1 + np.flatnonzero(_apart(f[pivots[i + 1 :]] ^ f[p]) <= 3 * k):
            if find(p) == find(pivots[j]):
                continue
            mine, other = order[bounds[i] : bounds[i + 1]], order[bounds[j] : bounds[j + 1]]
            for a in mine:
                hit = np.flatnonzero(_apart(f[other] ^ f[a]) <= k)
                if len(hit):
                    label[find(other[hit[0]])] = find(a)
                    left.append(a)
                    right.append(other[hit[0]])
                    break
    return np.array(left, np.int64), np.array(right, np.int64)


def _star_links(f: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate links (positions) of a dense run whose links are checked afterwards: they grow with its members alone.

    Pivots are chosen greedily; every member within ``NEAR`` of ``k`` is paired with its
    pivot and with the centre of the pivot's ball, the member nearest to the
    bits that most have (where all are changed copies of one text, that text).
    """
    left, right = [], []
    free = np.ones(len(f), bool)
    for p in range(len(f)):
        if not free[p]:
            continue
        own = np.flatnonzero(free & (_apart(f ^ f[p]) <= NEAR * k))
        free[own] = False
        centres = {p}
        if len(own) > 2:
            bits = np.unpackbits(f[own].view(np.uint8), axis=1)
            most = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(own)).view(np.uint64)
            centres.add(int(own[_apart(f[own] ^ most).argmin()]))
        for c in sorted(centres):
            others = own[own != c]
            left.append(np.full(len(others), c))
            right.append(others)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _run_links(key: np.ndarray, f: np.ndarray, k: int, checked: bool, cuts, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) within runs of equal ``key``; with ``once`` a short-run pair only at its first shared variant.

    If links are ``checked`` afterwards, dense runs give stars, at their first shared variant as well.
    """
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[start, len(key)])
    left, right = [], []
    short = np.repeat(length < SHORT_RUN, length)
    for d in range(1, min(SHORT_RUN, int(length.max(initial=1)))):
        at = np.flatnonzero((key[d:] == key[:-d]) & short[d:])
        if not len(at):
            break
        x = f[at] ^ f[at + d]
        at, x = at[ok := _apart(x) <= k], x[ok]
        if once:
            at = at[_first_variant(x, cuts) == key[at] >> KEY_BITS]
        left.append(at)
        right.append(at + d)
    for s, n in zip(start[length >= SHORT_RUN], length[length >= SHORT_RUN]):
        # in the order of the fingerprints, so that one is a pivot in all of its keys or in few
        order = np.lexsort(f[s : s + n].T)
        a, b = (_star_links if checked else _ball_links)(f[s + order], k)
        a, b = s + order[a], s + order[b]
        if checked and once:
            first = _first_variant(f[a] ^ f[b], cuts) == key[a] >> KEY_BITS
            a, b = a[first], b[first]
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _link_schema(names: list[str]) -> str:
    return "block int, a bigint, b bigint, " + ", ".join(f"{n} bigint" for n in names)


def _link_sorted(names: list[str], k: int, checked: bool, cuts, block: int, once: bool = True):
    """Over rows (key, node, fp...) sorted by key: links (block -1) and, of keys longer than ``block``, the members (block, key, node, fp...)."""
    schema = pa_schema(_link_schema(names))

    def out(block, a, b, f):
        arrays = [pa.array(np.full(len(a), block, np.int32)), pa.array(a), pa.array(b), *(pa.array(f[:, i].view(np.int64)) for i in range(len(names)))]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def done(key, node, f):
        a, b = _run_links(key, f, k, checked, cuts, once)
        yield out(-1, node[a], node[b], np.zeros((len(a), len(names)), np.uint64))

    def give(key, node, f, part):
        yield out(part, key, node, f)
        yield from done(key, node, f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, node, f = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(names)), np.uint64)
        part = 0  # blocks already given out for the key in hand
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            key, node = np.concatenate([key, cols[0]]), np.concatenate([node, cols[1]])
            f = np.concatenate([f, np.stack(cols[2:], axis=1).view(np.uint64)])
            if part and len(key) and (over := int((key == key[0]).sum())) < len(key):
                yield from give(key[:over], node[:over], f[:over], part)
                key, node, f, part = key[over:], node[over:], f[over:], 0
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if len(key) and key[0] != key[-1] else 0
            if last:
                yield from done(key[:last], node[:last], f[:last])
                key, node, f = key[last:], node[last:], f[last:]
            while len(key) > block:
                yield from give(key[:block], node[:block], f[:block], part)
                key, node, f, part = key[block:], node[block:], f[block:], part + 1
        if len(key):
            yield from give(key, node, f, part) if part else done(key, node, f)

    return run


def fingerprint_links(fps: DataFrame, distance: int, checked: bool = False, count: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between nodes of distinct fingerprints (node, fp, ...) within ``distance`` bits.

    Every fingerprint is indexed under each segment with each of its bits left
    out.  With the default number of segments, fingerprints within the distance
    share a key, as some segment differs by at most one bit.  Rows of a key meet
    by the equality of the key and are verified on all bits.  Dense keys yield
    links that stand for all pairs (``_ball_links``) or, if links are ``checked``
    by other means afterwards, candidates (``_star_links``).  Keys with more than
    ``block`` fingerprints are dealt in pairs of blocks, so that no task holds
    more than two blocks.
    """
    names = [c for c in fps.columns if c != "node"]
    cuts = segments(distance, 64 * len(names), count)
    n_keys = 64 * len(names)
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                cols = [c.slice(at, 1024).to_numpy(zero_copy_only=False) for c in batch.columns]
                f = np.stack(cols[1:], axis=1).view(np.uint64)
                keys = np.concatenate(list(_variants(f, cuts)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.tile(c, n_keys)) for c in cols)], names=["key", "node", *names])

    keyed = fps.filter("node IS NOT NULL").select("node", *names).mapInArrow(index, "key bigint, node bigint, " + ", ".join(f"{n} bigint" for n in names))
    link = lambda rows, size, once: rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_link_sorted(names, distance, checked, cuts, size, once), _link_schema(names))
    found = cut_lineage(link(keyed, block, True))
    links = found.filter("block < 0").select("a", "b")
    members = found.filter("block >= 0").select(F.col("a").alias("key"), "block", F.col("b").alias("node"), *names)
    if not members.isEmpty():
        blocks = members.groupBy("key").agg((F.max("block") + 1).alias("n"))
        cells = members.join(blocks, "key").withColumn("other", F.explode(F.expr("sequence(0, n - 1)"))).filter("other <> block")
        cells = cells.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "node", *names)
        links = links.union(link(cells, 4 * block, False).filter("block < 0").select("a", "b"))
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _set_name(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits, as two signed longs, that name a set of shingle hashes."""
    low, high = np.frombuffer(xxhash.xxh128_digest(hashes.tobytes()), np.int64)
    return int(low), int(high)


def shingle_sets(docs: DataFrame, width: int, short: bool = False) -> DataFrame:
    """(s1, s2, s) of every row: the 128-bit name of its shingle set and its sorted 64-bit hashes, or their first 16 bits."""
    cut = (lambda x: (x >> np.uint64(48)).astype(np.uint16)) if short else lambda x: x

    def run(cols):
        sets = [np.unique(shingle_hashes(t, width)) for t in cols["text"]]
        names = [_set_name(x) for x in sets]
        return {"s1": [a for a, _ in names], "s2": [b for _, b in names], "s": [cut(x).tobytes() for x in sets]}

    return map_rows(docs.select(F.col("text").cast("string")), "s1 bigint, s2 bigint, s binary", run)


def _sets_of(docs: DataFrame, nodes: DataFrame, width: int, short: bool = False) -> DataFrame:
    """(node, s) of ``nodes`` (node, rep, s1, s2); only documents named by ``rep`` are read again."""
    # written and counted, so that texts are not shuffled where few are wanted
    nodes = cut_lineage(nodes.select("node", "rep", "s1", "s2"))
    reps = broadcast_if_small(nodes.select(F.col("rep").alias("doc_id")))
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = d.join(reps, d["doc_id"].eqNullSafe(reps["doc_id"]), "left_semi")
    return shingle_sets(wanted, width, short).groupBy("s1", "s2").agg(F.first("s").alias("s")).join(nodes.select("node", "s1", "s2"), ["s1", "s2"]).select("node", "s")


def _told_apart(x: np.ndarray) -> np.ndarray:
    """Sorted values as distinct ones: each with the number of equal values before it."""
    first = np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)
    at = np.arange(len(x))
    return x.astype(np.uint64) << np.uint64(32) | (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)


def _checked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, jaccard: float, short: bool) -> DataFrame:
    """Those ``pairs`` (a, b) whose sets, or ``short`` forms of them, have at least this Jaccard similarity.

    Pairs are dealt by ``a``, in parts of about ``DEALT``: the set of ``a``
    travels once a part, and a task holds one such set while those of ``b`` pass.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / DEALT).cast("int").alias("parts"))
    dealt = cut_lineage(pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")))
    named = dealt.select(F.col("a").alias("node")).union(dealt.select(F.col("b").alias("node"))).distinct()
    sets = cut_lineage(_sets_of(docs, classes.join(named, "node", "left_semi"), width, short))
    wanted = dealt.select("a", "part").distinct().select("a", "part", F.lit(None).cast("bigint").alias("b"), F.col("a").alias("node"))
    wanted = wanted.union(dealt.select("a", "part", "b", F.col("b").alias("node"))).join(sets, "node")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = (lambda s: _told_apart(np.frombuffer(s.as_buffer(), np.uint16))) if short else lambda s: np.frombuffer(s.as_buffer(), np.uint64).copy()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, x = None, None
        for batch in batches:
            keep_a, keep_b = [], []
            for a, b, s in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("s")):
                y = read(s)
                if b is None:
                    here, x = a, y
                    continue
                assert here == a
                common = len(x) + len(y) - len(np.union1d(x, y))
                if common >= jaccard * (len(x) + len(y) - common):
                    keep_a.append(a)
                    keep_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], names=["a", "b"])

    rows = wanted.repartition(parts, "a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.select("a", "b", "s").mapInArrow(check, "a bigint, b bigint")


def similar(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, jaccard: float) -> DataFrame:
    """Those ``pairs`` (a, b) of nodes of ``classes`` whose sets of word shingles have at least this Jaccard similarity.

    First by 16 bits of each hash, which can only make sets more similar, then
    what is left by whole hashes.  The result is written; where no pairs are
    left, no query is run on them.
    """
    for short in (True, False):
        if pairs.isEmpty():
            break
        pairs = cut_lineage(_checked(docs, pairs, classes, width, jaccard, short))
    return pairs


def _common_shingles(docs: DataFrame, classes: DataFrame, width: int) -> np.ndarray:
    """Shingles that many components have, rarest first, counted in every ``SAMPLED``-th; they only order prefixes."""
    some = classes.filter(f"node = label AND pmod(xxhash64(node), {SAMPLED}) = 0")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column("s").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, np.int64))], names=["h"])

    seen = _sets_of(docs, some, width).select("s").mapInArrow(each, "h bigint").groupBy("h").agg(F.count("*").alias("n")).filter(f"n >= {COMMON}")
    rows = seen.orderBy(F.desc("n"), "h").limit(COMMON_SHINGLES).collect()
    return np.array([r.h for r in reversed(rows)], np.int64).view(np.uint64)


def prefix_pairs(docs: DataFrame, classes: DataFrame, width: int, jaccard: float) -> DataFrame:
    """Pairs (a, b, label ``to`` of b, shared keys c) of nodes of different labels: every pair of at least this Jaccard similarity is among them.

    In any one order of all shingles, sets that similar share one among the
    first n - ceil(jaccard n) + 1 of each.  The order is that of the hashes, with
    the shingles of many components last, so that keys are rare.  Sizes, the number
    of shared keys and the places of the last bound the overlap; what cannot be
    similar by the place of a shared key alone never leaves the join.
    """
    common = _common_shingles(docs, classes, width)
    place = np.argsort(common)
    ordered = common[place]

    def keys(cols):
        out = {"s1": [], "s2": [], "n": [], "keys": []}
        for text in cols["text"]:
            h = np.unique(shingle_hashes(text, width))
            n = len(h)
            rank = np.zeros(n, np.int64)
            if len(ordered):
                at = np.minimum(np.searchsorted(ordered, h), len(ordered) - 1)
                rank = np.where(ordered[at] == h, place[at] + 1, 0)
            first = h[np.lexsort((h, rank))][: n - math.ceil(jaccard * n - 1e-9) + 1]
            for column, value in zip(out.values(), (*_set_name(h), n, first.view(np.int64))):
                column.append(value)
        return out

    lists = map_rows(docs.select(F.col("text").cast("string")), "s1 bigint, s2 bigint, n int, keys array<bigint>", keys)
    lists = lists.groupBy("s1", "s2").agg(F.first(F.struct("n", "keys")).alias("l")).join(classes.select("node", "label", "s1", "s2"), ["s1", "s2"])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prefix = lists.select("node", "label", F.expr("shiftleft(CAST(l.n AS BIGINT), 32)").alias("n"), F.posexplode("l.keys").alias("at", "key"))
    prefix = prefix.select("key", "node", "label", (F.col("n") + F.col("at")).alias("place")).repartition(parts, "key")
    # of a key all of one component nothing is left; of the others the members of its largest one meet no two of their own
    apart = prefix.withColumn("low", F.expr("min(label) OVER (PARTITION BY key)")).withColumn("high", F.expr("max(label) OVER (PARTITION BY key)")).filter("low < high")
    apart = cut_lineage(apart.select("key", "node", "label", F.shiftright("place", 32).cast("int").alias("n"), F.expr("CAST(place & 4294967295 AS INT)").alias("at")))
    most = apart.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("most"))
    live = apart.join(most, "key")
    x = live.filter("label <> most").alias("x")
    need = F.lit(jaccard / (1 + jaccard)) * (F.col("x.n") + F.col("y.n")) - 1e-6
    same = F.expr(f"x.key = y.key AND x.label <> y.label AND (y.label = y.most OR x.node < y.node) AND least(x.n, y.n) >= {jaccard}D * greatest(x.n, y.n) - 1e-6D")
    # after a shared place no more than the shorter rest can be shared: the first one of a similar pair leaves enough,
    # and all that come before one that does are seen here
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    met = x.join(live.alias("y"), same & (rest >= need))
    names = [F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"), F.col("y.label").alias("to")]
    pairs = met.select(*names, F.col("x.at").alias("i"), F.col("y.at").alias("j")).groupBy("a", "b", "n", "m", "to").agg(F.count("*").alias("c"), F.max("i").alias("i"), F.max("j").alias("j"))
    after = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1
    return pairs.filter(F.col("c") + after >= jaccard / (1 + jaccard) * (F.col("n") + F.col("m")) - 1e-6).select("a", "b", "to", "c")


def _between(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the labels of both, a_label and b_label."""
    of = lambda n: labelled.select(F.col("node").alias(n), F.col("label").alias(f"{n}_label"))
    return pairs.join(of("a"), "a").join(of("b"), "b")


def _joined(labelled: DataFrame, links: DataFrame) -> DataFrame:
    """``labelled`` after ``links`` (a, b) joined some of its components, which alone are the nodes that are linked."""
    if links.isEmpty():
        return labelled
    joined = components(_between(links, labelled).select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
    named = labelled.join(joined.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left")
    return cut_lineage(named.withColumn("label", F.coalesce("least", "label")).select(labelled.columns))


def similar_documents(docs: DataFrame, width: int, distance: int, n_words: int, count: int | None, jaccard: float, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, ..., component_id) of every row, linked exactly where shingle sets have this Jaccard similarity.

    Near fingerprints are candidates that join most of each group at little cost.
    What they leave apart meets by prefixes of the sets (``prefix_pairs``), which
    miss no pair, so the components are those of all similar pairs.
    """
    names = _names(n_words)

    def run(cols):
        fps = np.array([fingerprint(t, width, n_words) for t in cols["text"]], np.uint64).reshape(-1, n_words).view(np.int64)
        sets = [_set_name(np.unique(shingle_hashes(t, width))) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "s1": [a for a, _ in sets], "s2": [b for _, b in sets]} | {name: fps[:, i] for i, name in enumerate(names)}

    schema = ", ".join(["doc_id bigint", "s1 bigint", "s2 bigint", *(f"{name} bigint" for name in names)])
    prints = cut_lineage(map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), schema, run))
    classes = prints.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.min(F.struct(*names)).alias("f")).select("s1", "s2", "rep", "f.*")
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    near = cut_lineage(fingerprint_links(classes.select("node", *names), distance, True, count, block))
    links = similar(docs, near, classes, width, jaccard)
    nodes = classes.select("node", "rep", "s1", "s2")
    labelled = cut_lineage(nodes.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node")))
    rest = cut_lineage(prefix_pairs(docs, labelled, width, jaccard))
    # of each node and component first the pair that shares most: where it is similar, the others need no check
    best = cut_lineage(rest.groupBy("a", "to").agg(F.max_by("b", F.struct("c", "b")).alias("b")).select("a", "b"))
    labelled = _joined(labelled, similar(docs, best, classes, width, jaccard))
    apart = cut_lineage(_between(rest, labelled).filter("a_label <> b_label").select("a", "b").join(best, ["a", "b"], "left_anti"))
    labelled = _joined(labelled, similar(docs, apart, classes, width, jaccard))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    return prints.join(labelled.join(least, "label").select("s1", "s2", "component_id"), ["s1", "s2"]).select("doc_id", *names, "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, n_words: int = 1, count: int | None = None, jaccard: float | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; fp1, ... with more words.

    Fingerprints of word shingles are linked when at most ``distance`` bits
    differ; the component is named by its smallest doc_id.  With ``jaccard``,
    texts are linked exactly where their shingle sets are that similar
    (``similar_documents``).
    Null and empty texts have fingerprint zero, linked like any other.  Equal
    texts share one fingerprint and are compared once.  Repeated rows come back
    as often as they are given.  Rows with a null doc_id name no component and
    belong to one only by an equal fingerprint.  Other columns are ignored.
    """
    if jaccard is not None:
        return similar_documents(docs, width, distance, n_words, count, jaccard, block)
    names = _names(n_words)
    prints = cut_lineage(fingerprints(docs, width, n_words))
    classes = cut_lineage(prints.groupBy(*names).agg(F.min("doc_id").alias("node")))
    links = fingerprint_links(classes, distance, False, count, block)
    labels = components(links)
    named = classes.join(labels, "node", "left").select(*names, F.coalesce("label", "node").alias("component_id"))
    return prints.join(named, names).select("doc_id", *names, "component_id")


#: For sets of five-word shingles with a Jaccard similarity of 0.8 or more: 128 bits in eight
#: segments.  Of pairs at 0.8 exactly 93 % share a key, at 0.9 over 99 %; the prefixes of the
#: sets find the others.
SIMILAR = {"width": 5, "n_words": 2, "count": 8, "distance": 36, "jaccard": 0.8}


def hex_print() -> F.Column:
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))
