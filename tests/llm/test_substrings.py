import hashlib
import re

import numpy as np
import pytest

from tidemark.llm import repeats, substrings, suffixes


def expected(texts, units, window, join):
    """What is left of each text, by checking every window of every smaller document."""
    seen, out = set(), {}
    for i in sorted(k for k in texts if k is not None):
        u = units(texts[i])
        gone = np.zeros(len(u), bool)
        mine = {tuple(u[j : j + window]) for j in range(len(u) - window + 1)}
        for j in range(len(u) - window + 1):
            if tuple(u[j : j + window]) in seen:
                gone[j : j + window] = True
        seen |= mine
        out[i] = (len(u), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(join([x for x, g in zip(u, gone) if not g])).hexdigest())
    return out


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@pytest.mark.parametrize("window", [13, 30, 5])
def test_word_windows_equal_brute_force(corpus, prose, window):
    texts = dict(enumerate(prose))
    want = expected(texts, words, window, b" ".join)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_dedup(corpus(texts), window).collect()}
    assert got == {k: (n, gone, sha) for k, (n, gone, _, sha) in want.items()}


def test_byte_strings_equal_brute_force(corpus, prose, monkeypatch):
    monkeypatch.setattr(suffixes, "SLAB", 500)
    texts = dict(enumerate(prose))
    want = expected(texts, lambda t: list((t or "").encode()), 50, bytes)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.suffix_dedup(corpus(texts)).collect()}
    assert got == want


@pytest.mark.parametrize("operator, units, window", [(substrings.substring_dedup, words, 13), (suffixes.suffix_dedup, lambda t: list((t or "").encode()), 50)])
def test_hot_names_change_nothing(corpus, prose, monkeypatch, operator, units, window):
    monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
    monkeypatch.setattr(repeats, "HOT_CONTENTS", 4)
    texts = dict(enumerate(prose))
    docs = corpus(texts)
    unit = repeats.word_units if window == 13 else repeats.byte_units
    assert len(repeats.hot_names(docs, unit, operator.__globals__["measure"], window, 8 if window == 13 else 20, 64))
    want = expected(texts, units, window, b" ".join if window == 13 else bytes)
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in operator(docs).collect()}
    assert got == {k: (gone, sha) for k, (_, gone, _, sha) in want.items()}


def test_sorted_buckets_go_on_over_slabs():
    import pyarrow as pa

    n, length = 40, 50
    context = bytes(range(60))
    batch = pa.RecordBatch.from_pydict(
        {"name": [7] * n, "doc_id": list(range(n)), "c": list(range(n)), "first": [0] * n, "count": [11] * n, "context": [context] * n},
        schema=suffixes.pa_schema(suffixes._SUFFIXES),
    )
    old, suffixes.SLAB = suffixes.SLAB, 30
    try:
        runs = [r for b in suffixes._sort_buckets(length)(iter([batch])) for r in b.to_pylist()]
    finally:
        suffixes.SLAB = old
    assert sorted(r["doc_id"] for r in runs) == list(range(1, n)) and all((r["start"], r["stop"]) == (0, 10) for r in runs)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("operator", [substrings.substring_dedup, suffixes.suffix_dedup])
def test_repeated_rows_null_ids_and_empty_tables(corpus, spark, operator, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
        monkeypatch.setattr(repeats, "HOT_CONTENTS", 1)
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, long + " end"), (2, "other " + long), (None, long), (3, None), (4, "")]
    got = operator(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 7
    removed = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_removed > 0) for r in got)
    assert removed == [(-1, False), (1, False), (1, False), (2, True), (2, True), (3, False), (4, False)]
    assert operator(corpus([])).count() == 0


def test_window_hash_by_doubling_and_samples_cover():
    rng = np.random.default_rng(3)
    u = rng.integers(0, 2**64, 400, dtype=np.uint64)
    for length in (1, 2, 7, 13, 50):
        want = [int(sum(int(x) * pow(repeats.BASES[0], length - 1 - j, 2**64) for j, x in enumerate(u[i : i + length])) % 2**64) for i in range(len(u) - length + 1)]
        assert (repeats.window_hash(u, length) == repeats.mix(np.array(want, np.uint64))).all()
    at = repeats.samples(u, 50, 20)
    assert ((at >= np.arange(len(at))) & (at <= np.arange(len(at)) + 30)).all() and (np.diff(at) >= 0).all()
    assert (repeats.samples(u[100:], 50, 20) + 100 == at[100:]).all()


def test_levels_double():
    assert substrings.levels(13) == [8, 13] and substrings.levels(50) == [8, 16, 32, 50] and substrings.levels(5) == [5]


def test_window_hashes_go_on_over_blocks_and_need_no_mixing(monkeypatch):
    u = np.random.default_rng(5).integers(0, 2**64, 500, dtype=np.uint64)
    whole = repeats.window_hash(u, 20)
    assert (repeats.mix(repeats.window_hash(u, 20, mixed=False)) == whole).all() and not len(repeats.window_hash(u[:19], 20))
    monkeypatch.setattr(repeats, "BLOCK", 64)
    repeats._powers.cache_clear()
    assert (repeats.window_hash(u, 20) == whole).all()
    repeats._powers.cache_clear()


def test_strings_with_one_hash_alike_are_told_apart():
    h, g, key = (np.array(x, np.uint64) for x in ([5, 5, 5, 1], [1, 2, 1, 1], [7, 7, 7, 7]))
    order = suffixes._by_string(h, g, key)
    assert sorted(order.tolist()) == [0, 1, 2, 3]
    at = {i: n for n, i in enumerate(order.tolist())}
    assert abs(at[0] - at[2]) == 1
