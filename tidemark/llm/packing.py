"""Packing of token pieces: best fit, then a swap-based local search over classes of equal bins."""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, pa_schema
from tidemark.session import cut_lineage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: Encoded words that a worker process keeps; it starts anew when full.
CACHE = 400_000
#: Pieces of one length are ranked in so many independent parts at least, of about ``PART_ROWS`` pieces.
RANK_PARTS, PART_ROWS = 256, 100_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary's own splitting never joins two words, so texts of plain
    Latin letters, digits, punctuation and blanks are split here and the ids of
    each word are remembered; the words that are new in a text are encoded
    together.  All other texts go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        # of one case pair both are in the range, so that lower case leaves a text plain
        latin = [chr(c) for c in range(0xA1, 0x180) if chr(c) != "\xad" and all(0xA0 < ord(x) < 0x180 for x in chr(c).lower())]
        plain = "\t\n\r" + "".join(map(chr, range(0x20, 0x7F))) + "".join(latin)
        of = lambda kind: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind)
        letters, numbers = of("L"), of("N")
        self.plain = re.compile("[" + re.escape(plain) + "]*")
        # Fixed value: the vocabulary's published pattern, with its classes spelled out for these characters.
        self.pattern = re.compile(rf"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^\s{letters}{numbers}]+")
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[str]) -> None:
        ids = np.array(self.library.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
        raw = ids.tobytes()
        self.known.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends], ends))))

    def __call__(self, text: str) -> bytes:
        if "<|" in text or not self.plain.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = self.pattern.findall(text.lower())
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            new = list({w for w in words if w not in known})
            if len(known) + len(new) > CACHE:
                known.clear()
                new = list(set(words))
            self._learn(new)
            return b"".join(map(known.__getitem__, words))


_encoders: dict[str, Encoder] = {}


def encode(text: str | None, name: str = TOKENIZER) -> bytes:
    if name not in _encoders:
        _encoders[name] = Encoder(tokenizer_path(name))
    return _encoders[name](text or "")


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and a closing 0, cut only beyond ``capacity``."""

    def run(cols):
        out = []
        for doc_id, text in zip(cols["doc_id"], cols["text"]):
            ids = encode(text, tokenizer) + b"\0\0\0\0"
            for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), list(zip(*out)) or [()] * 5))

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), PIECES, run)


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing over a histogram of lengths: how many bins of each pattern (lengths, descending).

    Equal bins are one class, and all copies of a length go through the classes
    at once, so the work depends on the number of lengths, not of pieces.
    """
    room: dict[int, Counter] = defaultdict(Counter)
    residuals: list[int] = []

    def put(pattern, residual, bins):
        if bins:
            if not room[residual]:
                residuals.insert(bisect_left(residuals, residual), residual)
            room[residual][pattern] += bins

    for length in sorted(counts, reverse=True):
        left = counts[length]
        filled = []
        while left:
            at = bisect_left(residuals, length)
            if at == len(residuals):
                each = capacity // length
                filled.append(((length,) * each, capacity - each * length, left // each))
                filled.append(((length,) * (left % each), capacity - left % each * length, int(left % each > 0)))
                break
            residual = residuals[at]
            pattern, bins = next(iter(room[residual].items()))
            each = residual // length
            used = min(bins, left // each)
            last = left % each if used < bins and used == left // each else 0
            room[residual][pattern] -= used + (last > 0)
            if not room[residual][pattern]:
                del room[residual][pattern]
            if not room[residual]:
                residuals.pop(at)
            filled.append((pattern + (length,) * each, residual - each * length, used))
            filled.append((pattern + (length,) * last, residual - last * length, int(last > 0)))
            left -= used * each + last
        for entry in filled:  # after the length, as they have no room for another of it
            put(*entry)
    out: Counter = Counter()
    for patterns in room.values():
        out.update(patterns)
    return out


def _without(pattern: tuple, *items: int) -> tuple:
    rest = list(pattern)
    for x in items:
        rest.remove(x)
    return tuple(rest)


def _gives(pattern: tuple) -> list[tuple[int, tuple]]:
    """What a bin can give in an exchange: nothing (a move), one piece or two."""
    one = dict.fromkeys(pattern)
    two = {}
    for i, a in enumerate(pattern):
        for b in pattern[i + 1 :]:
            two.setdefault(a + b, (a, b))
    return [(0, ()), *((a, (a,)) for a in one), *two.items()]


class _Offers:
    """What every open class can give in an exchange, as growing arrays."""

    def __init__(self, capacity: int):
        self.capacity, self.number = capacity, {}
        self.patterns: list[tuple] = []
        self.gifts: list[tuple] = []
        self.bins = np.zeros(64, np.int64)  # of each class
        self.size = 0
        self.value, self.residual, self.owner = (np.zeros(1024, np.int64) for _ in range(3))

    def put(self, pattern: tuple, n: int) -> None:
        """``n`` more (or fewer) bins of a class."""
        at = self.number.get(pattern)
        if at is None:
            at = self.number[pattern] = len(self.patterns)
            self.patterns.append(pattern)
            gives = _gives(pattern)
            if at == len(self.bins):
                self.bins = np.r_[self.bins, np.zeros(at, np.int64)]
            while self.size + len(gives) > len(self.value):
                self.value, self.residual, self.owner = (np.r_[x, np.zeros(len(x), np.int64)] for x in (self.value, self.residual, self.owner))
            span = slice(self.size, self.size + len(gives))
            self.value[span] = [v for v, _ in gives]
            self.residual[span] = self.capacity - sum(pattern)
            self.owner[span] = at
            self.gifts += [items for _, items in gives]
            self.size += len(gives)
        self.bins[at] += n

    def best(self, donor: tuple) -> tuple[int, int, int] | None:
        """(item, other class, number of its gift) of the exchange that moves most into another bin, if squares grow."""
        n, fill = self.size, sum(donor)
        value, residual, owner = self.value[:n], self.residual[:n], self.owner[:n]
        others = (self.bins[owner] > 0) & (owner != self.number[donor])
        best, found = 0, None
        for item in dict.fromkeys(donor):
            gain = item - value
            gain[(gain > residual) | (self.capacity - residual - fill + gain <= 0) | ~others] = 0
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = int(gain[at]), (item, int(owner[at]), at)
        return found


def local_search(bins: Counter, capacity: int) -> Counter:
    """Exchange pieces between underfull bins so that the sum of squared fills grows until bins empty.

    The emptiest class gives: one of its pieces moves into another bin, or is
    exchanged for one or two smaller ones there, if the other bin has the room
    and the squares grow; as many bins as both classes have change at once.  A
    class that can give no more is left until others have changed.  Ends when no
    exchange helps or the lower bound of bins is reached; every exchange makes
    the sum of squares larger, so it does end.
    """
    full = Counter({p: n for p, n in bins.items() if sum(p) == capacity})
    offers = _Offers(capacity)
    donors = []
    for pattern, n in bins.items():
        if sum(pattern) < capacity:
            offers.put(pattern, n)
            donors.append((sum(pattern), pattern))
    heapify(donors)
    total = sum(bins.values())
    least = -(-sum(sum(p) * n for p, n in bins.items()) // capacity)
    changed = False
    while True:
        while donors and not offers.bins[offers.number[donors[0][1]]]:
            heappop(donors)
        if not donors and changed:  # what was stuck may give again
            donors = [(sum(p), p) for p, i in offers.number.items() if offers.bins[i]]
            heapify(donors)
            changed = False
        if total <= least or not donors:
            break
        donor = donors[0][1]
        found = offers.best(donor)
        if found is None:
            heappop(donors)
            continue
        changed = True
        item, at, gift = found
        other, given = offers.patterns[at], offers.gifts[gift]
        n = int(min(offers.bins[offers.number[donor]], offers.bins[at]))
        offers.put(donor, -n)
        offers.put(other, -n)
        for p in (_without(donor, item) + given, _without(other, *given) + (item,)):
            p = tuple(sorted(p, reverse=True))
            if not p:
                total -= n
            elif sum(p) == capacity:
                full[p] += n
            else:
                offers.put(p, n)
                heappush(donors, (sum(p), p))
    left = {p: int(offers.bins[i]) for p, i in offers.number.items() if offers.bins[i]}
    return full + Counter(left)


def slots(bins: Counter) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: ranks at which a row of slots begins, the sequence of its first, and the offset.

    The piece of rank r within its length takes slot r - rank of the row.
    """
    rows = defaultdict(list)
    taken: Counter = Counter()
    sequence = 0
    for pattern, n in sorted(bins.items(), reverse=True):
        offset = 0
        for length in pattern:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(c, np.int64) for c in zip(*r)) for length, r in rows.items()}


def ranked(rows: DataFrame, parts: int = RANK_PARTS) -> DataFrame:
    """``rank`` of each row of a written table within its length, counted from 0; no task orders all rows of a length."""
    # a row's place in its file tells equal rows apart, in the same way whenever it is read
    rows = rows.select("*", F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(parts)).alias("part"), F.col("_metadata.row_index").alias("place"))
    before = rows.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn("before", F.expr("sum(n) OVER (PARTITION BY length ORDER BY part) - n"))
    inside = rows.withColumn("rank", F.expr("row_number() OVER (PARTITION BY length, part ORDER BY place, doc_id, piece, ids_crc32) - 1")).drop("place")
    return inside.join(before.drop("n"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of ``docs``.

    Only the histogram of lengths, at most ``capacity`` counts, reaches the
    driver; there the bins are planned as classes of equal bins and refined.
    Pieces are ranked within their length and take the planned slots by rank.
    Null and empty texts are the closing 0 alone; repeated rows and null
    doc_ids are packed like any other; extra columns are ignored.
    """
    cut = cut_lineage(pieces(docs, capacity, tokenizer))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(local_search(best_fit(counts, capacity), capacity))
    schema = PIECES + ", sequence_id bigint, offset bigint"
    names = [f.name for f in pa_schema(PIECES)]

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                first, start, place = plan[n]
                row = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], offset[at] = start[row] + rank[at] - first[row], place[row]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], schema=pa_schema(schema))

    return ranked(cut, max(RANK_PARTS, max(counts.values(), default=0) // PART_ROWS)).mapInArrow(place, schema)
