"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pa_schema
from tidemark.session import cut_lineage

#: Letters a word must have, and occurrences.
LETTERS, OCCURRENCES = 6, 5
#: A form has at least so many times the word's occurrences.
RATIO = 5
#: Counts of distinct words that a task holds before it passes them on.
HELD = 200_000
#: Words of a cell that the upper tree aims at; larger cells are dealt in blocks of ``BLOCK``.
CELL, BLOCK = 8_192, 16_384
#: Words from which the planes of the upper tree are drawn; they decide how work is dealt, not its result.
SAMPLE = 65_536
#: Words of a leaf of a cell's tree, and queries that go down it together.
LEAF, TOGETHER = 24, 4_096
#: Counts of a vector: one for each of a to z, the other letters share the rest.
DIMENSIONS = 32

_RUNS = re.compile("[a-zÀ-ÿ]{%d,}" % LETTERS)
#: The vector's place of each character.
_PLACE = np.array([c - 97 if 97 <= c < 123 else 26 + c % (DIMENSIONS - 26) for c in range(256)])


def word_counts(docs: DataFrame, gap: int = 199) -> DataFrame:
    """(word, n) over all texts, with the stated deletions; runs too short to count are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def give():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    if not text:
                        continue
                    start = zlib.crc32(f"{doc_id or ''}:".encode())
                    for word, n in Counter(_RUNS.findall(text.encode().lower().decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % gap == 0:
                            cut = h % len(word)
                            word = word[:cut] + word[cut + 1 :]
                            if len(word) < LETTERS:
                                continue
                        held[word] += n
                if len(held) >= HELD:
                    yield give()
        if held:
            yield give()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str], width: int) -> np.ndarray:
    """The characters of words of at most ``width`` letters, one byte each, zeros behind."""
    return np.array([w.encode("latin-1") for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)


def vectors(chars: np.ndarray) -> np.ndarray:
    """Letter counts of each row of characters."""
    n, width = chars.shape
    rows = np.repeat(np.arange(n), width)
    flat = chars.reshape(-1)
    at = (rows * DIMENSIONS + _PLACE[flat])[flat > 0]
    counts = np.bincount(at, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    return counts.astype(np.int8 if width < 64 else np.int32)


def grow(sample: np.ndarray, size: float, cell: int = CELL) -> list[tuple]:
    """An upper tree over vectors that stand for ``size`` words: nodes (letter, bound, left, right), leaves (-1, number, 0, 0).

    A node parts its words as evenly as one letter's count can; a leaf is
    expected to hold ``cell`` words or cannot be parted.
    """
    nodes: list[tuple] = []
    leaves = 0

    def node(v, size):
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        best, plane = 0.1, None
        if size > cell and len(v) > 8:
            middle = np.median(v, axis=0).astype(np.int64)
            for bound in (middle, middle - 1):
                share = (v <= bound).mean(axis=0)
                even = np.minimum(share, 1 - share)
                d = int(even.argmax())
                if even[d] > best:
                    best, plane = even[d], (d, int(bound[d]))
        if plane is None:
            nodes[at] = (-1, leaves, 0, 0)
            leaves += 1
            return at
        below = v[:, plane[0]] <= plane[1]
        share = below.mean()
        left = node(v[below], size * share)
        nodes[at] = (*plane, left, node(v[~below], size * (1 - share)))
        return at

    node(sample, size)
    return nodes


def reach(nodes: list[tuple], v: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``v``) for every leaf that a vector meets after at most ``more`` letters added and ``less`` removed."""
    stack = [(0, np.arange(len(v)), v, np.full(len(v), more), np.full(len(v), less))]
    while stack:
        at, rows, v, up, down = stack.pop()
        d, bound, left, right = nodes[at]
        if d < 0:
            yield bound, rows
            continue
        value = v[:, d].astype(np.int64)
        for child, need, budget in ((left, value - bound, down), (right, bound + 1 - value, up)):
            need = np.maximum(need, 0)
            ok = need <= budget
            if not ok.any():
                continue
            moved, spent = v[ok], need[ok]
            if spent.any():
                # the nearest vector on that side, so that a letter is not paid for twice
                moved = moved.copy()
                moved[:, d] = np.minimum(moved[:, d], bound) if child == left else np.maximum(moved[:, d], bound + 1)
            rest_up, rest_down = (up[ok], down[ok] - spent) if child == left else (up[ok] - spent, down[ok])
            stack.append((child, rows[ok], moved, rest_up, rest_down))


class Tree:
    """A k-d tree over the letter counts of one block of words."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.nodes: list[tuple] = []  # (low, high, rows or None, left, right)
        self._node(np.arange(len(v)))

    def _node(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        v = self.v[rows]
        low, high = v.min(axis=0), v.max(axis=0)
        d = int((high - low).argmax())
        if len(rows) <= LEAF or high[d] == low[d]:
            self.nodes[at] = (low, high, rows, 0, 0)
            return at
        # the letter whose middle count parts the words most evenly
        middle = np.median(v, axis=0).astype(v.dtype)
        middle = np.where(middle >= high, middle - 1, middle)
        share = (v <= middle).mean(axis=0)
        d = int(np.minimum(share, 1 - share).argmax())
        below = v[:, d] <= middle[d]
        left = self._node(rows[below])
        self.nodes[at] = (low, high, None, left, self._node(rows[~below]))
        return at

    def near(self, q: np.ndarray, more: int, less: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (rows of ``q``, rows of the block): at most ``more`` letters added and ``less`` removed."""
        stack = [(0, np.arange(len(q)))]
        while stack:
            at, rows = stack.pop()
            low, high, members, left, right = self.nodes[at]
            x = q[rows]
            up = np.maximum(low - x, 0).sum(axis=1, dtype=np.int32)
            down = np.maximum(x - high, 0).sum(axis=1, dtype=np.int32)
            rows = rows[(up <= more) & (down <= less)]
            if not len(rows):
                continue
            if members is None:
                stack += [(left, rows), (right, rows)]
                continue
            for a in range(0, len(members), 4 * LEAF):
                some = members[a : a + 4 * LEAF]
                apart = self.v[some][None, :, :] - q[rows][:, None, :]
                ok = (np.maximum(apart, 0).sum(axis=2, dtype=np.int32) <= more) & (np.maximum(-apart, 0).sum(axis=2, dtype=np.int32) <= less)
                i, j = np.nonzero(ok)
                yield rows[i], some[j]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row by row the characters ``a`` become ``b`` by one replacement or, where ``b`` is one longer, one insertion."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


class Block:
    """The words of one block, most frequent first, and their tree."""

    def __init__(self, words: list[str], n: list[int]):
        order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        self.words = [words[i] for i in order]
        self.n = [n[i] for i in order]
        self.width = len(self.words[0])
        self.chars = letters(self.words, self.width)
        self.tree = Tree(vectors(self.chars))

    def search(self, words: list[str]) -> Iterator[tuple[str, int, int, str]]:
        """(word, near words here, n of the most frequent, that word) of each of ``words``, all of one length, with any."""
        width = len(words[0])
        chars = letters(words, width)
        v = vectors(chars).astype(self.tree.v.dtype, copy=False)
        more, less = {0: (1, 1), 1: (1, 0), -1: (0, 1)}[self.width - width]
        count = np.zeros(len(words), np.int64)
        best = np.full(len(words), len(self.words))
        for i, j in self.tree.near(v, more, less):
            ok = one_edit(chars[i], self.chars[j]) if self.width >= width else one_edit(self.chars[j], chars[i])
            np.add.at(count, i[ok], 1)
            np.minimum.at(best, i[ok], j[ok])
        for i in np.flatnonzero(count).tolist():
            yield words[i], int(count[i]), self.n[best[i]], self.words[best[i]]


_ROWS = "cell bigint, part int, kind int, word string, n bigint"
_FOUND = "word string, near bigint, top_n bigint, top string"


def upper_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, list[tuple]]:
    """For each length with more than ``cell`` words the upper tree, drawn from a sample of at most ``sample`` words."""
    sizes = {r.size: r.n for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n")).filter(F.col("n") > cell).collect()}
    if not sizes:
        return {}
    every = max(1, -(-2 * sum(sizes.values()) // sample))
    some = words.filter(F.length("word").isin(list(sizes)) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0)).select("word").limit(sample).collect()
    by_size: dict[int, list[str]] = {size: [] for size in sizes}
    for r in some:
        by_size[len(r.word)].append(r.word)
    return {size: grow(vectors(letters(found, size)), sizes[size], cell) for size, found in by_size.items() if found}


#: Leaves of one length's tree fit below this number in a cell's name.
_LEAVES = 1 << 32


def _deal(trees: dict[int, list[tuple]], parts: dict[int, int], of_data: bool):
    """Rows (word, n) to the cells they live in, or to those they search: their own length, one more and one less."""
    schema = pa_schema(_ROWS)
    alone = [(-1, 0, 0, 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                piece = batch.slice(low, TOGETHER)
                words, n = piece.column("word").to_pylist(), piece.column("n").to_numpy()
                width = np.array([len(w) for w in words])
                cell, row, part = [], [], []
                for size in np.unique(width).tolist():
                    at = np.flatnonzero(width == size)
                    v = vectors(letters([words[i] for i in at], size))
                    for target, more, less in [(size, 0, 0)] if of_data else [(size, 1, 1), (size + 1, 1, 0), (size - 1, 0, 1)]:
                        for leaf, found in reach(trees.get(target, alone), v, more, less):
                            name = target * _LEAVES + leaf
                            blocks = parts.get(name, 1)
                            found = at[found]
                            if of_data:
                                dealt = [np.array([zlib.crc32(words[i].encode()) % blocks for i in found])]
                            else:
                                dealt = [np.full(len(found), b) for b in range(blocks)]
                            for b in dealt:
                                cell.append(np.full(len(found), name))
                                row.append(found)
                                part.append(b)
                if not cell:
                    continue
                row = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cell)), pa.array(np.concatenate(part).astype(np.int32)), pa.array(np.full(len(row), int(not of_data), np.int32)), piece.column("word").take(pa.array(row)), pa.array(n[row])],
                    schema=schema,
                )

    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (cell, part, kind): holds the words of one block, then lets its queries pass."""
    schema = pa_schema(_FOUND)
    here, words, counts, block = None, [], [], None
    for batch in batches:
        cell, part, kind = (batch.column(n).to_numpy() for n in ("cell", "part", "kind"))
        new = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(cell)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if here != (cell[a], part[a]):
                here, words, counts, block = (cell[a], part[a]), [], [], None
            if kind[a] == 0:
                words += batch.column("word").slice(a, b - a).to_pylist()
                counts += batch.column("n").slice(a, b - a).to_pylist()
                continue
            if block is None and words:
                block = Block(words, counts)
            if block is None:
                continue
            asked = batch.column("word").slice(a, b - a).to_pylist()
            by_width: dict[int, list[str]] = {}
            for w in asked:
                by_width.setdefault(len(w), []).append(w)
            for group in by_width.values():
                for low in range(0, len(group), TOGETHER):
                    rows = list(block.search(group[low : low + TOGETHER]))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def near_words(words: DataFrame, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, top_n, top): how many of ``words`` (word, n) are one edit away, and the most frequent of them.

    Words one edit apart have letter counts that differ by one letter added,
    one removed or both, so an upper tree for each length sends a word only to
    the cells that such a change can reach: of its own length, the next and the
    one before.  In a cell a second tree prunes by bounding boxes, and the
    letters' order decides.  Counts and the most frequent word are combined;
    pairs are never written.  A cell that counts cannot part is dealt in blocks.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = upper_trees(words, cell, sample)
    data = words.select("word", "n").mapInArrow(_deal(trees, {}, True), _ROWS)
    large = data.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > block).collect()
    blocks = {r.cell: -(-r.n // block) for r in large}
    if blocks:
        data = words.select("word", "n").mapInArrow(_deal(trees, blocks, True), _ROWS)
    asked = words.select("word", "n").mapInArrow(_deal(trees, blocks, False), _ROWS)
    rows = data.unionByName(asked).repartition(parts, "cell", "part").sortWithinPartitions("cell", "part", "kind")
    found = rows.mapInArrow(_search, _FOUND)
    best = F.min(F.struct((-F.col("top_n")).alias("order"), F.col("top").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("best.order")).alias("top_n"), F.col("best.word").alias("top"))


def roots(links: DataFrame, longest: int) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of at most ``longest`` forms, by doubling steps."""
    links = links.select("word", F.col("form").alias("root"))
    reached = 1
    while reached < longest:
        links = cut_lineage(links)
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        reached *= 2
    return links


def spelling_variants(docs: DataFrame, occurrences: int = OCCURRENCES, ratio: int = RATIO, gap: int = 199, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word of ``docs``.

    Words are runs of letters in lower case (A-Z only), with one letter left
    out where the checksum of document and run says so; those of at least
    ``LETTERS`` letters and ``occurrences`` occurrences count.  A word's form
    is its most frequent word one edit away (of equal ones the first in
    code-point order) if that has ``ratio`` times its occurrences; forms lead
    to the root.  Null and empty texts have no words; a null doc_id is written as the empty
    string in the checksum; repeated rows count again; an empty table gives no
    rows; other columns are ignored.
    """
    words = cut_lineage(word_counts(docs, gap).filter(F.col("n") >= occurrences))
    near = near_words(words, cell, block)
    joined = words.join(near, "word", "left")
    formed = F.col("top_n") >= ratio * F.col("n")
    joined = cut_lineage(joined.select("word", F.when(formed, F.col("top")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(formed, F.col("top_n")).alias("form_n")))
    most = joined.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    longest = 1  # every form has ``ratio`` times the occurrences of the one before
    while occurrences * ratio ** (longest + 1) <= most:
        longest += 1
    ends = roots(joined.filter("form IS NOT NULL"), longest)
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
