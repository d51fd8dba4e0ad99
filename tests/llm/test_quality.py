import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import quality as Q


def brute(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(repeated)


def test_counts_equal_brute_force(prose):
    odd = ["a a a a", "a b c a b c", "x\nx\n\n \nx", "# *\n#", "a b a b a b a", "\x1ca\x1c b"]
    for text in prose + odd:
        assert Q.counts(text)[:5] == brute(text)


def clean(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        rows.append((i, clean(rng, rng.randint(60, 400)), "en" if i % 3 else "de", ["hot", "hot", "a"][i % 3], 1))
    for i in range(900, 930):
        rows.append((i, " ".join(w + "$%&" for w in clean(rng, 120).split()), "en", "hot", 1))
    rows += [(930, None, "en", "hot", 1), (931, "", None, None, 1), (932, clean(rng, 80), None, "rare", 1), (933, "a b c " * 100, "en", "hot", 1), (None, clean(rng, 80), "en", "hot", 1)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, scope int")
    return Q.quality(df).toPandas()


def test_outliers_go_and_clean_documents_stay(judged):
    by_id = judged.drop_duplicates("doc_id").set_index("doc_id")
    assert len(judged) == 937
    assert by_id.loc[list(range(900)), "kept"].mean() > 0.995
    assert not by_id.loc[list(range(900, 930)), "kept"].any()
    assert by_id.loc[[930, 931, 933], "base_failed"].all() and not by_id.loc[[930, 931, 933], "kept"].any()
    assert by_id.loc[932, "kept"] and not by_id.loc[932, "base_failed"]


def test_small_and_empty_tables_are_judged_by_the_same_rule(spark):
    schema = "doc_id bigint, text string, lang string, source string"
    assert Q.quality(spark.createDataFrame([], schema)).count() == 0
    one = Q.quality(spark.createDataFrame([(1, clean(random.Random(1), 60), "en", "s")], schema)).first()
    assert one.kept and one.distance < 1
    # a group of fifty is judged by its own shape and its language's, without a switch
    rng = random.Random(3)
    rows = [(i, clean(rng, 100), "en", "a" if i < 50 else "b") for i in range(600)] + [(700, " ".join(w + "$%&" for w in clean(rng, 120).split()), "en", "a")]
    got = {r.doc_id: r.kept for r in Q.quality(spark.createDataFrame(rows, schema)).collect()}
    assert not got.pop(700) and all(got.values())


def test_estimate_resists_a_third_of_outliers(spark):
    rng = random.Random(4)
    rows = [("g", *[rng.gauss(j, 2.0) for j in range(Q.P)]) for _ in range(2000)] + [("g", *[rng.gauss(50, 1.0) for _ in range(Q.P)]) for _ in range(400)]
    df = spark.createDataFrame(rows, "scope string, " + ", ".join(f"x{i} double" for i in range(Q.P)))
    center = Q.minimum_covariance(df).first().center
    assert all(abs(c - j) < 0.3 for j, c in enumerate(center))


def test_kept_equals_a_plain_estimate(spark):
    """The pulled estimates, from the MCD estimates of the three levels, as plain matrices."""
    rng = random.Random(8)
    rows = [(i, clean(rng, rng.randint(55, 200)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r.distance for r in Q.quality(df).collect()}
    stats = Q.base_statistics(df).select("doc_id", "lang", "source", *(x.alias(f"x{i}") for i, x in enumerate(Q.transformed()))).toPandas()
    frames = [stats.assign(scope=s) for s in ("all", "lang " + stats["lang"], "group " + stats["lang"] + stats["source"])]
    found = Q.minimum_covariance(spark.createDataFrame(pd.concat(frames))).collect()
    of = {r.scope: r for r in found}
    for r in stats.itertuples():
        center, cov = None, np.diag(np.square(Q.PRIOR))
        for scope in ("all", f"lang {r.lang}", f"group {r.lang}{r.source}"):
            e = of[scope]
            own = np.zeros((Q.P, Q.P))
            for v, (i, j) in zip(e.precision, Q._PAIRS):
                own[i, j] = own[j, i] = v
            mine = np.array(e.center)
            center = mine if center is None else (e.n * mine + Q.PULL * center) / (e.n + Q.PULL)
            cov = (e.n * np.linalg.inv(own) + Q.PULL * cov) / (e.n + Q.PULL)
        x = np.array([getattr(r, f"x{i}") for i in range(Q.P)])
        assert got[r.doc_id] == pytest.approx((x - center) @ np.linalg.inv(cov) @ (x - center))
