"""Language identification in two steps: the family, then one-versus-one linear SVMs within it."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, map_rows

# The usual families of ISO 639-1 codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "indic": "hi ur bn pa mr gu ne si",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
#: Hashed n-grams of one to three bytes.
DIMENSIONS = 4096
#: Labelled documents used of each language: a bounded sample, spread by a hash of doc_id.
PER_LANGUAGE = 300
#: Short passages of so many words that are learned beside each whole text.
PASSAGES = (2, 4, 8, 16)
ROWS = 128

_LETTER = re.compile(r"[^\W\d_]")
# every ASCII byte that is no letter counts as a blank
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)


def features(text: str) -> np.ndarray:
    """Square roots of the hashed n-gram counts of the whole lower-cased text, of length one."""
    b = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    b = b[np.r_[True, (b[1:] != 32) | (b[:-1] != 32)]]
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:]
    codes = np.concatenate([b, two | 1 << 24, three | 2 << 24]) * np.uint32(2654435761)
    counts = np.sqrt(np.bincount(codes >> np.uint32(20), minlength=DIMENSIONS)).astype(np.float32)
    return counts / max(np.linalg.norm(counts), 1e-9)


def svm(x: np.ndarray, y: np.ndarray, weight: float = 1e-4, steps: int = 200) -> np.ndarray:
    """A linear SVM (squared hinge, L2) for labels +1 and -1, by accelerated gradient; the last number is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest curvature
        v = x.T @ (share * (x @ v))
        v /= np.linalg.norm(v)
    step = 1 / (2 * float(v @ (x.T @ (share * (x @ v)))) + weight)
    w = ahead = np.zeros(x.shape[1], np.float32)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (weight * ahead - 2 * (x.T @ (share * y * slack)))
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w.astype(np.float32)


class Pairwise:
    """One-versus-one SVMs over classes; one class alone needs none."""

    def __init__(self, classes: list[str]):
        self.classes = sorted(classes)
        self.pairs: list[tuple[int, int]] = list(combinations(range(len(self.classes)), 2))
        self.weights = np.zeros((len(self.pairs), DIMENSIONS + 1), np.float32)

    def fit(self, x: np.ndarray, labels: np.ndarray) -> "Pairwise":
        for n, (i, j) in enumerate(self.pairs):
            at = np.isin(labels, [self.classes[i], self.classes[j]])
            self.weights[n] = svm(x[at], np.where(labels[at] == self.classes[i], 1, -1).astype(np.float32))
        return self

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most votes (ties: the larger sum of margins) and the least confidence in its duels."""
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes = np.zeros((len(x), len(self.classes)))
        least = np.full((len(x), len(self.classes)), np.inf)
        for n, (i, j) in enumerate(self.pairs):
            for k, sign in ((i, 1), (j, -1)):
                m = sign * margins[:, n]
                votes[:, k] += (m > 0) + 0.001 * np.tanh(m)
                least[:, k] = np.minimum(least[:, k], m)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-3 * least[np.arange(len(x)), best]))


class Model:
    """The family's SVMs, and for each family those of its languages."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        of = np.array([FAMILY_OF.get(lang, lang) for lang in langs], object)
        self.families = Pairwise(list(set(of))).fit(x, of)
        self.within = [Pairwise(list(set(langs[of == f]))).fit(x[of == f], langs[of == f]) for f in self.families.classes]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.families.predict(x)
        out = np.empty(len(x), object)
        for f in np.unique(family):
            at = np.flatnonzero(family == f)
            lang, sure = self.within[f].predict(x[at])
            out[at] = np.array(self.within[f].classes, object)[lang]
            score[at] = score[at] * sure
        return out.tolist(), score


def held_out() -> F.Column:
    """Whether a row is never learned from: crc32 of its doc_id mod 3 is 1, or it has no doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))


def _training(docs: DataFrame, per_language: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and languages of the bounded sample: of each language the ``per_language`` least hashes."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("h"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # about twice the sample passes the threshold, so that cutting it to size leaves no gap
    share = F.pmod("h", F.lit(1 << 40)) < F.lit(float(1 << 41)) * per_language / F.col("n")
    # rows of one doc_id give one text, so that what is collected is bounded however often an id is repeated
    near = rows.join(broadcast_if_small(counts), "lang").filter(share).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    near = near.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("lang", "h", "text")

    def vectors(cols):
        out = []
        for text, h in zip(cols["text"], cols["h"]):
            words = text.split()
            parts = [text] if _LETTER.search(text) else []
            for k in PASSAGES:
                at = (h ^ k * 7919) % max(1, len(words) - k)
                part = " ".join(words[at : at + k])
                if len(words) > k and _LETTER.search(part):
                    parts.append(part)
            out.append(np.array([features(p) for p in parts], np.float16).tobytes())
        return {"lang": cols["lang"], "h": cols["h"], "x": out}

    found = map_rows(near, "lang string, h bigint, x binary", vectors, ROWS).toPandas().sort_values(["lang", "h"])
    x = [np.frombuffer(v, np.float16).reshape(-1, DIMENSIONS).astype(np.float32) for v in found["x"]]
    langs = np.repeat(found["lang"].to_numpy(object), [len(v) for v in x])
    return np.concatenate([np.zeros((0, DIMENSIONS), np.float32), *x]), langs


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    The model learns from at most ``per_language`` labelled documents of each
    language that are not held out.  Predictions see the whole text and nothing
    else.  A null text or one without a letter is ``und`` with score 0, as is
    every text if nothing can be learned.  Null labels and null doc_ids are not
    learned from; repeated rows are predicted alike; extra columns are ignored.
    """
    x, langs = _training(docs, per_language)
    model = Model(x, langs) if len(x) else None

    def run(cols):
        lang, score = ["und"] * len(cols["text"]), np.zeros(len(cols["text"]))
        at = [i for i, t in enumerate(cols["text"]) if t and _LETTER.search(t)]
        if at and model:
            found, sure = model.predict(np.array([features(cols["text"][i]) for i in at]))
            score[at] = sure
            for i, name in zip(at, found):
                lang[i] = name
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": lang, "score": score}

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out().alias("held_out"))
    return map_rows(rows, "doc_id bigint, held_out boolean, lang_pred string, score double", run, ROWS)
