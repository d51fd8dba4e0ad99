import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, sha int, c double"


@pytest.fixture(scope="session")
def corpus(spark):
    """A frame of documents from texts, with columns whose names clash with the operators' own."""

    def build(texts, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or ""), "x", 1, 0.5) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of words from a small vocabulary, with shared passages, copies, odd blanks and accents."""
    rng = random.Random(11)
    words = ["Lorem", "ipsum", "dolor", "été", "naïve", "sit", "amet.", "x1", "ÄRA", "the", "of", "über,", "word"] + [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90)))]
        if i % 3 == 0:
            at = rng.randint(0, 200)
            parts.insert(rng.randint(0, 1), passage[at : at + rng.randint(40, 300)])
        texts.append(rng.choice([" ", "\n", "\t \x0b", "\xa0"]).join(parts))
    texts += [texts[3], texts[3], texts[3] + " tail", "", None, " \n\t", "one", texts[9].replace("the", "THE", 1)]
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    return texts
