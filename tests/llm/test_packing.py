import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing as P

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'slt <|>.,!0é²ªßİΣſ́\xa0\x1c\t\n"), st.characters(max_codepoint=0x2FF)), max_size=40))
def test_ids_equal_the_library(library, text):
    assert P.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_of_known_cases(library, monkeypatch):
    monkeypatch.setattr(P, "CACHE", 5)
    for text in ["It's we'LL <|endoftext|> ok", "don''t 'S 'Re 'd''", "a!!'s b", "é́", "日本 text", "x" * 300, ""]:
        assert P.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def plan_is_right(counts, bins, capacity):
    held = Counter()
    for pattern, n in bins.items():
        assert n > 0 and 0 < sum(pattern) <= capacity
        for x in pattern:
            held[x] += n
    assert held == Counter({k: v for k, v in counts.items() if v})


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(0, 60), max_size=25))
def test_plans_hold_every_piece_once(counts):
    bins = P.best_fit(counts, 100)
    plan_is_right(counts, bins, 100)
    better = P.local_search(bins, 100)
    plan_is_right(counts, better, 100)
    assert -(-sum(k * v for k, v in counts.items()) // 100) <= sum(better.values()) <= sum(bins.values())


def test_best_fit_equals_the_plain_algorithm():
    rng = random.Random(6)
    for _ in range(20):
        items = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
        rooms = []
        for x in items:
            fits = [r for r in rooms if r >= x]
            room = min(fits) if fits else 100
            if fits:
                rooms.remove(room)
            rooms.append(room - x)
        assert sum(P.best_fit(Counter(items), 100).values()) == len(rooms)


def test_local_search_empties_bins():
    # 60+30 and 50+40 twice fit three bins of 100 only after exchanges
    bins = Counter({(50, 40): 2, (60, 30): 2, (20, 20): 1, (10, 10): 1})
    after = P.local_search(bins, 100)
    assert sum(after.values()) < sum(bins.values())
    plan_is_right(Counter({50: 2, 40: 2, 60: 2, 30: 2, 20: 2, 10: 2}), after, 100)
    # each kind of exchange on its own: move, one for one, two for one
    assert sum(P.local_search(Counter({(60,): 1, (40,): 1}), 100).values()) == 1
    assert max(map(sum, P.local_search(Counter({(70, 20): 1, (30,): 1, (80,): 1}), 100))) == 100
    assert P.local_search(Counter({(41, 30, 20): 1, (55,): 1, (51,): 1}), 100) == Counter({(55, 41): 1, (51, 30): 1, (20,): 1})


def test_packed_sequences_are_gapless(corpus, library, prose, spark):
    texts = prose + ["word " * 3000, "a b c"] * 2
    rows = P.pack(corpus(texts)).collect()
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            part = ids[n * 2048 : (n + 1) * 2048]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (n, n * 2048, len(part), zlib.crc32(part.tobytes()))
        assert sum(r.length for r in pieces[i]) == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 2048) + 3
    assert P.pack(corpus([])).count() == 0
    same = spark.createDataFrame([(None, "x"), (None, "x"), (1, "x"), (1, "x")], "doc_id bigint, text string")
    assert len({(r.sequence_id, r.offset) for r in P.pack(same).collect()}) == 4


def test_vocabulary_is_not_in_the_repository():
    assert not os.path.commonpath([P.tokenizer_path(), __file__]).endswith("repo")


def test_equal_rows_without_ids_are_ranked_in_many_parts(spark):
    rows = spark.createDataFrame([(None, "x")] * 3000, "doc_id bigint, text string").repartition(3)
    cut = P.cut_lineage(P.pieces(rows))
    ranked = P.ranked(cut).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(3000))
    plan = P.ranked(cut)
    assert sorted(plan.columns) == sorted([*cut.columns, "rank"])


def test_local_search_ends_by_itself_with_thousands_of_classes():
    rng = random.Random(2)
    counts = Counter(rng.randint(200, 1900) for _ in range(6000))
    bins = P.best_fit(counts, 2048)
    after = P.local_search(bins, 2048)
    plan_is_right(counts, after, 2048)
    assert sum(after.values()) <= sum(bins.values())
