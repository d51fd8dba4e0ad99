"""Token ids in binary shards, found by document key through a minimal perfect hash index.

A store is a folder:

* ``shards/PPPPPPPP-NNNN.tok``: the ids of documents one after the other, in
  ascending key order over all shards (unsigned little-endian, two bytes an id where the
  vocabulary allows it, else four); then the position of each document's first id
  and of the end (8 bytes each); then the number of documents (8 bytes).
* ``index/BBBBBBBB.mph``: for the keys of one hash bucket a minimal perfect hash
  function, then one slot a key: fingerprint, shard, place and start.
* ``more``: a small Parquet table of keys whose documents go on in a later shard.
* ``store.json``: width of an id, number of buckets.

Shards and buckets are written by tasks under a name of the attempt and then
moved to their own name, so a task may run twice.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import pa_schema
from tidemark.llm.perfect_hash import PerfectHash, fingerprints
from tidemark.session import cut_lineage, scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: The id that ends a document.
END = 2
#: A shard is closed when its ids pass this size.
SHARD_BYTES = 128 << 20
#: Keys of a bucket of the index, on average.
BUCKET_KEYS = 500_000
#: Encoded pieces that a worker process keeps: half of them in use, half from before.
CACHE = 1_000_000
#: Texts encoded together.
TOGETHER = 256
#: Ids read from a shard at once.
SPAN_BYTES = 8 << 20
#: Shards that one task may close; their number is a shard's low bits.
ROLLS = 1 << 12

SLOT = np.dtype([("fingerprint", "<u4"), ("run", "<u4"), ("shard", "<i8"), ("entry", "<i8"), ("at", "<i8"), ("n", "<i8"), ("start", "<i8")])
PLACE = "shard bigint, entry bigint, at bigint, n bigint, start bigint, run bigint"
_PLACE = ("shard", "entry", "at", "n", "start", "run")


class ByteEncoder:
    """Token ids of whole texts by the tokenizers library.

    The vocabulary splits a text before it merges bytes.  Texts of plain Latin
    characters are split here by the same pattern and the ids of each piece are
    remembered, so the library sees a piece once; all other texts and those
    with a special token go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        letters = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
        numbers = "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.plain = re.compile("[\t-\r -~\xa1-\xac\xae-ſ]*")
        # Fixed value: the vocabulary's published pattern, with its classes spelled out for these characters.
        self.pattern = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+")
        # the vocabulary writes printable bytes as themselves and the others as the characters from 256 on, in order
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(printable)]
        self.spelling = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, new: set[str]) -> None:
        """The merges of each piece, as the library does them on the vocabulary's own spelling of bytes."""
        if len(self.known) + len(new) > CACHE // 2:
            self.before, self.known = self.known, {}
        tokenize, known, before = self.library.model.tokenize, self.known, self.before
        for piece in new:
            ids = before.get(piece)
            if ids is None:
                spelled = piece.encode().decode("latin-1").translate(self.spelling)
                ids = np.array([t.id for t in tokenize(spelled)], self.kind).tobytes()
            known[piece] = ids

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; what is new in any of them is learnt together."""
        split = [self.pattern.findall(t) if t and self.plain.fullmatch(t) and not any(s in t for s in self.special) else None for t in texts]
        get = self.known.get
        found = [list(map(get, pieces)) if pieces else None for pieces in split]
        open_ = [i for i, ids in enumerate(found) if ids and None in ids]
        if open_:
            self._learn({p for i in open_ for p, ids in zip(split[i], found[i]) if ids is None})
            get, before = self.known.get, self.before
            for i in open_:
                found[i] = [ids or get(p) or before[p] for p, ids in zip(split[i], found[i])]
        return [b"".join(ids) if ids else self.whole(t) if t else b"" for t, ids in zip(texts, found)]


_encoders: dict[str, ByteEncoder] = {}


def encoder(name: str = TOKENIZER) -> ByteEncoder:
    if name not in _encoders:
        import public_tokenizers

        _encoders[name] = ByteEncoder(public_tokenizers.path(name))
    return _encoders[name]


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's name in it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else path)


def _write(files: pafs.FileSystem, name: str, parts: Iterator[bytes]) -> None:
    """Write under a name of this attempt, then move; what another attempt wrote is the same."""
    part = f"{name}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as out:
        for raw in parts:
            out.write(raw)
    files.move(part, name)


def shard_name(shard: int) -> str:
    return f"shards/{shard // ROLLS:08d}-{shard % ROLLS:04d}.tok"


def hashes(column: str) -> list[F.Column]:
    """The 128 bits by which a key is known to the index, as two longs."""
    return [F.xxhash64(F.col(column)).alias("h"), F.xxhash64(F.lit(1), F.col(column)).alias("g")]


def key_hashes(key: int | str | None) -> tuple[int, int]:
    """The same of a single key, as unsigned numbers."""
    one = xxhash.xxh64_intdigest(struct.pack("<i", 1), 42)
    if key is None:
        return 42, one
    raw = key.encode() if isinstance(key, str) else struct.pack("<q", key)
    return xxhash.xxh64_intdigest(raw, 42), xxhash.xxh64_intdigest(raw, one)


def placed(docs: DataFrame, key: str) -> DataFrame:
    """(key, text, file, place) of every row; what does not come from files is written first.

    File and place tell equal rows apart in the same way whenever a task runs.
    """
    kind = "string" if dict(docs.select(key).dtypes)[key] == "string" else "bigint"
    rows = [F.col(key).cast(kind).alias("key"), F.col("text").cast("string").alias("text")]
    try:
        return docs.select(*rows, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:
        written = cut_lineage(docs.select(*rows))
        return written.select("key", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))


def _shard_writer(path: str, kind: str, tokenizer: str, end: int, shard_bytes: int):
    """Over sorted rows (key, text): encodes, writes shards and gives (key, shard, entry, at, n) of every document."""
    schema = pa_schema(f"key {kind}, shard bigint, entry bigint, at bigint, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width, last = encode.kind.itemsize, np.array([end], encode.kind).tobytes()
        files, root = _files(path)
        shard = TaskContext.get().partitionId() * ROLLS
        out = part = None
        at, starts = 0, []

        def close():
            tail = np.array([*starts, at, len(starts)], "<i8")
            out.write(tail.tobytes())
            out.close()
            files.move(part, f"{root}/{shard_name(shard)}")

        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(low, TOGETHER)
                found = {"key": batch.column("key"), "shard": [], "entry": [], "at": [], "n": []}
                for raw in encode(batch.column("text").to_pylist()):
                    raw += last
                    if out is not None and at * width >= shard_bytes and shard % ROLLS < ROLLS - 1:
                        close()
                        out, shard = None, shard + 1
                    if out is None:
                        part = f"{root}/{shard_name(shard)}.{uuid.uuid4().hex}.part"
                        out = files.open_output_stream(part)
                        at, starts = 0, []
                    out.write(raw)
                    for name, value in zip(("shard", "entry", "at", "n"), (shard, len(starts), at, len(raw) // width)):
                        found[name].append(value)
                    starts.append(at)
                    at += len(raw) // width
                yield pa.RecordBatch.from_arrays([found["key"], *(pa.array(found[f.name], f.type) for f in list(schema)[1:])], schema=schema)
        if out is not None:
            close()

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole buckets from batches sorted by ``bucket``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column("bucket")[0].as_py() != bucket[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _index_writer(path: str):
    """Over rows (bucket, h, g, place) sorted by bucket: writes the index of each bucket and gives its number of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(path)
        for table in _by_bucket(batches):
            bucket = table.column("bucket")[0].as_py()
            h, g = (table.column(n).to_numpy().view(np.uint64) for n in ("h", "g"))
            perfect = PerfectHash.build(h, g)
            slots = np.zeros(len(h), SLOT)
            at = perfect(h, g)
            slots["fingerprint"][at] = fingerprints(h, g)
            for name in _PLACE:
                slots[name][at] = table.column(name).to_numpy()
            _write(files, f"{root}/index/{bucket:08d}.mph", iter([perfect.dump(), slots.tobytes()]))
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(h)], pa.int64())], names=["bucket", "keys"])

    return run


def write_store(docs: DataFrame, path: str, key: str = "doc_id", tokenizer: str = TOKENIZER, end: int = END, shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS) -> None:
    """Encode all rows of ``docs`` and write them as a store (see the module) in the folder ``path``.

    Rows are in ascending order of ``key``, null keys last; rows that repeat a
    key follow each other in any order and are found together.  Null and empty texts are
    the ending id alone.  Extra columns are ignored; an empty table gives a
    store without shards.  Texts are dealt by ranges of key and place in the
    input, so a key that many rows repeat is split as well, and encoded where
    their shard is written; no task holds more than the texts it is encoding, or
    one bucket of the index.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = placed(docs, key)
    kind, width = rows.schema["key"].dataType.simpleString(), encoder(tokenizer).kind.itemsize
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files, root = _files(path)
    for folder in ("shards", "index"):
        files.create_dir(f"{root}/{folder}", recursive=True)
    order = [F.asc_nulls_last("key"), F.asc("file"), F.asc("place")]
    dealt = rows.repartitionByRange(max(parts, -(-total // shard_bytes)), *order).sortWithinPartitions(*order)
    writer = _shard_writer(path, kind, tokenizer, end, shard_bytes)
    entries = cut_lineage(dealt.select("key", "text").mapInArrow(writer, f"key {kind}, shard bigint, entry bigint, at bigint, n bigint"))
    # one row a shard
    bases = entries.groupBy("shard").agg(F.sum("n").alias("ids")).selectExpr("shard", "sum(ids) OVER (ORDER BY shard) - ids AS base")
    first = F.min_by(F.struct("entry", "at", "n"), "entry").alias("p")
    runs = entries.groupBy("key", "shard").agg(first, F.count("*").alias("run")).join(bases, "shard")
    runs = runs.select("key", "shard", "p.*", (F.col("base") + F.col("p.at")).alias("start"), "run")
    runs = cut_lineage(runs.withColumn("least", F.min("shard").over(_window("key"))))
    runs.filter("shard > least").select("key", *_PLACE).write.parquet(f"{path}/more")
    keys = runs.filter("shard = least").select("key", *_PLACE)
    buckets = max(1, -(-keys.count() // bucket_keys))
    hashed = keys.select(*hashes("key"), *_PLACE).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    built = hashed.repartition(max(parts, buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(_index_writer(path), "bucket int, keys bigint")
    cut_lineage(built)
    _write(files, f"{root}/store.json", iter([json.dumps({"width": width, "buckets": buckets, "key": kind}).encode()]))


def _window(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key)


def _about(path: str) -> dict:
    files, root = _files(path)
    with files.open_input_file(f"{root}/store.json") as f:
        return json.loads(f.read())


def _load_bucket(files: pafs.FileSystem, root: str, bucket: int) -> tuple[PerfectHash, np.ndarray] | None:
    name = f"{root}/index/{bucket:08d}.mph"
    if files.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    with files.open_input_file(name) as f:
        raw = f.read()
    perfect, at = PerfectHash.load(raw)
    return perfect, np.frombuffer(raw, SLOT, offset=at)


def _look_up(perfect: PerfectHash, slots: np.ndarray, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the bucket, and the slots of these."""
    at = perfect(h, g)
    known = at >= 0
    known[known] = slots["fingerprint"][at[known]] == fingerprints(h[known], g[known])
    return known, slots[at[known]]


def locate(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, shard, entry, at, n, start, run) of the first document of each of ``keys`` in each shard that has the key.

    Looked up in the index, bucket by bucket; keys whose fingerprint is not
    there are left out.
    """
    about = _about(path)
    kind, buckets = about["key"], about["buckets"]
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = keys.select(F.col(key).cast(kind).alias("key")).distinct().select("key", *hashes("key"))
    wanted = wanted.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(path)
        loaded, held = None, None
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            for b in np.unique(bucket).tolist():
                if b != loaded:
                    loaded, held = b, _load_bucket(files, root, b)
                if held is None:
                    continue
                part = batch.filter(pa.array(bucket == b))
                h, g = (part.column(n).to_numpy().view(np.uint64) for n in ("h", "g"))
                known, slots = _look_up(*held, h, g)
                yield pa.RecordBatch.from_arrays([part.column("key").filter(pa.array(known)), *(pa.array(slots[n].astype(np.int64)) for n in _PLACE)], names=["key", *_PLACE])

    # a bucket may be asked for by many tasks; each loads it once
    salted = wanted.repartition(max(parts, buckets), "bucket", F.pmod("g", F.lit(max(1, parts // buckets)))).sortWithinPartitions("bucket")
    first = salted.mapInArrow(run, f"key {kind}, {PLACE}")
    more = spark.read.schema(f"key {kind}, {PLACE}").parquet(f"{path}/more")
    asked = wanted.select("key")
    return first.unionByName(more.join(asked, more["key"].eqNullSafe(asked["key"]), "left_semi"))


class Shard:
    """Documents of one shard by their place; reads only the bytes asked for."""

    def __init__(self, files: pafs.FileSystem, name: str, width: int):
        self.file, self.width = files.open_input_file(name), width
        self.size = self.file.size()
        self.kind = np.dtype(f"<u{width}")

    def starts(self, entry: int, n: int) -> np.ndarray:
        """First ids of ``n`` documents from ``entry`` on, and the end of the last."""
        docs = int(np.frombuffer(self.file.read_at(8, self.size - 8), "<i8")[0])
        return np.frombuffer(self.file.read_at(8 * (n + 1), self.size - 8 * (docs + 2 - entry)), "<i8")

    def ids(self, at: int, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * self.width, at * self.width), self.kind)

    def documents(self, places: Iterator[tuple]) -> Iterator[tuple]:
        """(key, start, ids) of all documents at ``places`` (key, entry, at, n, start, run), neighbours read together."""
        span: list[tuple] = []

        def read():
            if span:
                low, high = span[0][2], span[-1][2] + span[-1][3]
                ids = self.ids(low, high - low)
                for key, start, at, n in span:
                    yield key, start, ids[at - low : at - low + n]
                span.clear()

        for key, entry, at, n, start, run in places:
            docs = [(key, start, at, n)]
            if run > 1:
                bounds = self.starts(entry, run)
                docs = ((key, start + int(a) - at, int(a), int(b - a)) for a, b in zip(bounds[:-1], bounds[1:]))
            for doc in docs:
                if span and (doc[2] != span[-1][2] + span[-1][3] or (doc[2] + doc[3] - span[0][2]) * self.width > SPAN_BYTES):
                    yield from read()
                span.append(doc)
        yield from read()


def read_documents(keys: DataFrame, path: str, schema: str, function: Callable[[np.ndarray], object], key: str = "doc_id") -> DataFrame:
    """(``key``, start, value) of every document under ``keys``: found by the index, read from the shards.

    ``function`` makes the value, of type ``schema``, from a document's ids.
    Places are dealt by shard, so that a shard is opened by one task and its
    neighbouring documents are read together.
    """
    about = _about(path)
    kind, width = about["key"], about["width"]
    out = pa_schema(f"{key} {kind}, start bigint, value {schema}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(path)
        opened, shard = None, None
        for batch in batches:
            number = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if opened != number[a]:
                    opened, shard = number[a], Shard(files, f"{root}/{shard_name(int(number[a]))}", width)
                part = batch.slice(a, b - a).to_pydict()
                places = zip(part["key"], part["entry"], part["at"], part["n"], part["start"], part["run"])
                rows = []
                for name, start, ids in shard.documents(places):
                    rows.append((name, start, function(ids)))
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = locate(keys, path, key).repartition(parts, "shard").sortWithinPartitions("shard", "entry")
    return places.mapInArrow(run, f"{key} {kind}, start bigint, value {schema}")


class TokenStore:
    """Single documents by key: one look into the index, one read of the ids."""

    def __init__(self, path: str):
        self.about = _about(path)
        self.files, self.root = _files(path)
        self.buckets: dict[int, tuple | None] = {}

    def get(self, key: int | str | None) -> np.ndarray | None:
        """The ids of the key's (first) document, None if the store has none."""
        h, g = key_hashes(key)
        signed = h - 2**64 if h >= 2**63 else h
        bucket = signed % self.about["buckets"]
        if bucket not in self.buckets:
            self.buckets[bucket] = _load_bucket(self.files, self.root, bucket)
        if self.buckets[bucket] is None:
            return None
        known, slots = _look_up(*self.buckets[bucket], np.array([h], np.uint64), np.array([g], np.uint64))
        if not known[0]:
            return None
        slot = slots[0]
        return Shard(self.files, f"{self.root}/{shard_name(int(slot['shard']))}", self.about["width"]).ids(int(slot["at"]), int(slot["n"]))


def _digest(ids: np.ndarray) -> int:
    return len(ids) << 32 | zlib.crc32(ids.astype("<u4").tobytes())


def store_digest(docs: DataFrame, path: str | None = None, key: str = "doc_id", tokenizer: str = TOKENIZER, **options) -> DataFrame:
    """``key``, start, n_tokens and ids_crc32 of every document, read back by key from a store written of ``docs``.

    ``start`` counts the ids of all documents before it.  Nulls, repeated keys, empty tables and extra columns
    as ``write_store`` says.
    """
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_store(docs, path, key, tokenizer, **options)
    found = read_documents(docs, path, "bigint", _digest, key)
    return found.select(key, "start", F.shiftrightunsigned("value", 32).alias("n_tokens"), F.col("value").bitwiseAND(F.lit(0xFFFFFFFF)).alias("ids_crc32"))
