import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import token_store as T
from tidemark.llm.perfect_hash import PerfectHash, fingerprints
from tidemark.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sltre <|>.,!0é²ªßİΣſ́\xa0\x1c\x85\t\n\r"), st.characters(max_codepoint=0x2FF)), max_size=40))
def test_ids_equal_the_library(library, text):
    assert T.encoder()([text]) == [np.array(library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()]


def test_ids_of_known_cases(library, monkeypatch):
    texts = ["It's we'LL <|endoftext|> ok", "a  b\n\n c \n", None, "''s 's", "日本 text", "x" * 300 + " " * 40, "", "½ 12²a", "a b a b"]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    monkeypatch.setattr(T, "CACHE", 8)
    assert T.encoder()(texts) == want
    assert [T.encoder()([t])[0] for t in texts * 2] == want * 2


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_survives_its_bytes(n):
    rng = np.random.default_rng(n)
    h, g = rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 2**64, n, dtype=np.uint64)
    perfect, size = PerfectHash.load(PerfectHash.build(h, g).dump() + b"behind")
    assert sorted(perfect(h, g).tolist()) == list(range(n))
    assert size == len(PerfectHash.build(h, g).dump())
    if n > 1:
        assert len(perfect.words) * 64 < 6 * n + 64 * 20  # bits
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64), np.array([7, 7], np.uint64))
    assert len(set(fingerprints(h, g).tolist())) >= 0.99 * n


def expected(library, rows):
    at, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_every_document_is_read_back(library, corpus, prose, spark):
    ids = list(range(0, 7 * len(prose), 7))
    random.Random(3).shuffle(ids)
    rows = list(zip(ids, prose))
    # shards of a few documents, buckets of a few keys
    got = T.store_digest(corpus(dict(rows)), shard_bytes=2000, bucket_keys=5)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(library, rows)
    assert T.store_digest(corpus([])).count() == 0


def test_single_keys_and_keys_that_are_not_there(library, corpus, prose, spark):
    path = scratch_path(spark, "tokens")
    T.write_store(corpus(prose), path, shard_bytes=3000, bucket_keys=9)
    store = T.TokenStore(path)
    for i in (0, 5, 60, len(prose) - 1):
        assert store.get(i).tolist() == [*library.encode(prose[i] or "", add_special_tokens=False).ids, 2]
    assert store.get(10**12) is None and store.get(None) is None
    asked = spark.createDataFrame([(3,), (3,), (-1,), (None,), (8,)], "doc_id bigint")
    assert {r.doc_id for r in T.read_documents(asked, path, "array<int>", lambda ids: ids.tolist()).collect()} == {3, 8}
    # the hashes of single keys are those of Spark
    keys = spark.createDataFrame([(1,), (-5,), (None,)], "k bigint").select("k", *T.hashes("k")).collect()
    assert all(((r.h % 2**64), (r.g % 2**64)) == T.key_hashes(r.k) for r in keys)
    words = spark.createDataFrame([("é",), ("",), ("x" * 99,)], "k string").select("k", *T.hashes("k")).collect()
    assert all(((r.h % 2**64), (r.g % 2**64)) == T.key_hashes(r.k) for r in words)


def test_a_key_of_many_rows_goes_over_several_shards(library, spark):
    rows = [(5, f"w{i} text") for i in range(300)] + [(None, "n"), (None, "n"), (4, "before"), (6, "after " * 500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = T.store_digest(df, shard_bytes=64).collect()
    want = expected(library, rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), n, c) for i, _, n, c in want)
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert [r.start for r in got if r.doc_id == 6] == [s for i, s, _, _ in want if i == 6]


def test_string_keys(library, spark):
    df = spark.createDataFrame([("b", "x y"), ("a", None), ("é", "z")], "name string, text string").withColumn("ids", F.lit("clash"))
    got = {r.name: (r.start, r.n_tokens) for r in T.store_digest(df, key="name").collect()}
    assert got == {"a": (0, 1), "b": (1, 3), "é": (4, 2)}
