import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import spelling as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, gap):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % gap == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(4)
    letters = "abcdeé÷Ü"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(25)]
    words = []
    for base in bases:
        words += [base] * rng.randint(5, 400)
        for _ in range(6):
            w = list(base)
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], [rng.choice(letters)], [w[at], rng.choice(letters)], [w[at], w[at]]])
            words += ["".join(w)] * rng.randint(3, 60)
    words += ["a" * n for n in (6, 7, 8, 20_000, 20_001) for _ in range(6)]
    words += ["".join(w) for w in (rng.choices("ab", k=9) for _ in range(3000))]
    rng.shuffle(words)
    texts = [rng.choice([" ", ", ", "1"]).join(words[i : i + 50]) for i in range(0, len(words), 50)]
    return [(i, t.title() if i % 9 == 0 else t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("cell, block", [(S.CELL, S.BLOCK), (12, 20), (3, 4)])
def test_equals_brute_force(corpus, misspelt, cell, block):
    got = S.spelling_variants(corpus(dict(misspelt)), gap=7, cell=cell, block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = list(map(tuple, got.collect()))
    want = brute(misspelt, 7)
    assert len(rows) == len(want) and set(rows) == want
    assert any(r[2] != (r[1] or r[0]) for r in want)  # some root lies beyond the form


def test_nulls_repeated_rows_and_empty_tables(spark, corpus):
    rows = [(None, "banana banana"), (None, "banana"), (3, None), (4, ""), (5, "banana bananas"), (5, "banana bananas"), (6, "bananas " * 3), (7, "short " * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert set(map(tuple, S.spelling_variants(df).collect())) == brute(rows, 199)
    assert S.spelling_variants(corpus([])).count() == 0


def test_chains_of_forms(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")]
    got = {r.word: r.root for r in S.roots(spark.createDataFrame(links, "word string, form string"), 11).collect()}
    assert got == {w: "w11" for w, _ in links}


def test_trees_prune():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrst", k=10)) for _ in range(4000)})
    v = S.vectors(S.letters(words, 10))
    tree = S.Tree(v)
    opened = []
    own = tree.near
    leaves = sum(n[2] is not None for n in tree.nodes)
    for i in (0, 100, 2000):
        seen = 0
        for low, high, members, _, _ in tree.nodes:
            if members is not None:
                up, down = np.maximum(low - v[i], 0).sum(), np.maximum(v[i] - high, 0).sum()
                seen += up <= 1 and down <= 1
        opened.append(seen / leaves)
        assert any(i in j for _, j in own(v[i : i + 1], 1, 1))
    assert max(opened) < 0.5
    nodes = S.grow(v, 4000, 200)
    cells = [len({leaf for leaf, _ in S.reach(nodes, v[i : i + 1], 1, 1)}) for i in range(0, 4000, 400)]
    number = sum(n[0] < 0 for n in nodes)
    assert number > 10 and np.mean(cells) < 0.8 * number
    homes = np.concatenate([rows for _, rows in S.reach(nodes, v, 0, 0)])
    assert sorted(homes.tolist()) == list(range(len(words)))
