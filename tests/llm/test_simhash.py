import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from tidemark.llm import components as C
from tidemark.llm import simhash as S
from tidemark.llm.components import components


def classes(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components_equal_brute_force(corpus, prose):
    prints = [brute_print(t) for t in prose]
    n = len(prints)
    want = classes(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    got = {r.doc_id: (r.h, r.component_id) for r in S.near_duplicates(corpus(prose)).withColumn("h", S.hex_print()).collect()}
    assert got == {i: (f"{p:016x}", w) for i, (p, w) in enumerate(zip(prints, want))}


@pytest.fixture(scope="module")
def dense():
    """Random fingerprints, and around some of them many that differ by a few bits."""
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**64, 120, dtype=np.uint64)]
    near = []
    for b in base[:25]:
        for _ in range(60):
            for bit in rng.choice(64, rng.integers(0, 4), replace=False):
                b ^= 1 << int(bit)
            near.append(b)
    return np.unique(np.array(base + near, np.uint64))


@pytest.mark.parametrize("distance, block", [(4, S.BLOCK), (4, 20), (2, S.BLOCK), (5, 33)])
def test_links_connect_exactly_what_all_pairs_connect(spark, dense, distance, block):
    apart = np.bitwise_count(dense[:, None] ^ dense[None, :])
    want = classes(len(dense), np.argwhere(apart <= distance).tolist())
    df = spark.createDataFrame(pd.DataFrame({"node": np.arange(len(dense)), "fp": dense.view(np.int64)}))
    links = [(r.a, r.b) for r in S.fingerprint_links(df, distance, block=block).collect()]
    assert all(apart[a, b] <= distance for a, b in links)
    assert classes(len(dense), links) == want
    assert len(links) < 64 * len(dense)


def test_similar_documents_by_shingles(corpus):
    rng = np.random.default_rng(8)
    make = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts, truth = [], []
    for g in range(60):
        own = make(300)
        texts.append(" ".join(own))
        for _ in range(2):
            other = list(own)
            for at in rng.choice(300, rng.integers(1, 5), replace=False):
                other[at] = "changed"
            texts.append(" ".join(other))
    shingles = [{tuple(t.split()[i : i + 5]) for i in range(296)} for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    truth = classes(len(texts), pairs)
    got = {r.doc_id: r.component_id for r in S.near_duplicates(corpus(texts), **S.SIMILAR).collect()}
    assert np.mean([got[i] == t for i, t in enumerate(truth)]) > 0.97
    assert all(truth[i] == truth[got[i]] for i in range(len(texts)))


def jaccard_truth(texts, width=5):
    shingles = [{tuple(t.split()[i : i + width]) for i in range(max(1, len(t.split()) - width + 1))} for t in texts]
    return classes(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])])


def test_every_pair_at_the_least_similarity_is_linked(corpus):
    """Pairs at just 0.8, whose fingerprints often share no key, and sets that agree while their repeats differ."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(150):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 94)]
        texts += [" ".join(own), " ".join(own[10:] + [f"v{x}" for x in rng.integers(0, 10**6, 10)])]  # 80 of 100 shingles
    for _ in range(20):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        loop = [f"u{x}" for x in rng.integers(0, 10**6, 5)]
        texts += [" ".join(own + loop * 2), " ".join(own + loop * 60)]
    truth = jaccard_truth(texts)
    assert len(set(truth)) == 170
    got = {r.doc_id: r.component_id for r in S.near_duplicates(corpus(texts), **S.SIMILAR).collect()}
    assert [got[i] for i in range(len(texts))] == truth


def test_null_ids_repeated_rows_and_empty_tables(spark, corpus):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, "quite another text than that"), (7, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in S.near_duplicates(df).collect())
    assert got == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 7), (9, 7)]
    assert S.near_duplicates(corpus([])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40, 70)] + [(100, i) for i in range(101, 160)] + [(3, 3), (8, 2), (2, 8)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.label for r in components(df).collect()}
    assert got == {i: 40 for i in range(40, 71)} | {i: 100 for i in range(100, 160)} | {2: 2, 8: 2}


def test_edges_that_are_stars_take_no_steps(spark, monkeypatch):
    written = []
    monkeypatch.setattr(C, "cut_lineage", lambda df, f=C.cut_lineage: written.append(1) or f(df))
    edges = [(1, i) for i in range(2, 60)] + [(70, i) for i in range(71, 90)] + [(5, 1), (4, 4)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 60)} | {i: 70 for i in range(70, 90)}
    assert len(written) == 1
    # two stars that share a leaf, a leaf that is a centre, and a ring
    odd = [(1, 9), (2, 9), (2, 8), (20, 21), (21, 22), (30, 31), (31, 32), (32, 33), (33, 30)]
    got = {r.node: r.label for r in components(spark.createDataFrame(odd, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 8: 1, 9: 1} | {i: 20 for i in (20, 21, 22)} | {i: 30 for i in range(30, 34)}


def test_no_queries_are_run_on_no_pairs(corpus, monkeypatch):
    checked = []
    monkeypatch.setattr(S, "_checked", lambda *args, f=S._checked: checked.append(1) or f(*args))
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    got = {r.doc_id: r.component_id for r in S.near_duplicates(corpus([*texts, texts[3]]), **S.SIMILAR).collect()}
    assert got == {i: i for i in range(12)} | {12: 3}
    assert not checked


def test_later_links_join_components_by_their_labels(spark):
    labelled = spark.createDataFrame([(i, i, 0, i, label) for i, label in enumerate([0, 0, 2, 2, 4, 5, 5, 7])], "node bigint, rep bigint, s1 bigint, s2 bigint, label bigint")
    links = spark.createDataFrame([(3, 6), (1, 7), (2, 3)], "a bigint, b bigint")
    out = S._joined(labelled, links)
    assert out.columns == labelled.columns
    assert [r.label for r in out.orderBy("node").collect()] == [0, 0, 2, 2, 4, 2, 2, 0]
    assert [r.label for r in S._joined(labelled, links.limit(0)).orderBy("node").collect()] == [0, 0, 2, 2, 4, 5, 5, 7]
