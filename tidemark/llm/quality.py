"""Quality rules: base counts and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, map_rows, words_of
from tidemark.session import cut_lineage

STATS = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_capitals bigint"
#: Of each transformed statistic, in the order of ``transformed``, the least standard
#: deviation: a statistic that hardly varies in a group must not reject for trifles.
FLOORS = (0.10, 0.03, 0.15, 0.15, 0.12, 0.75)
#: The spreads that all documents are pulled towards; they matter where there are hardly any documents.
PRIOR = tuple(3 * f for f in FLOORS)
P = len(FLOORS)
#: Share of a group that the determinant is minimised over.
H = 0.75
#: A group's estimate is pulled towards its language's as by so many documents of it, a
#: language's towards that of all documents, and this towards ``PRIOR``.
PULL = 100
#: A document is rejected beyond this quantile of its squared distance.
QUANTILE = 0.9995
STEPS = 5
#: Distances are counted in bins of this many to a doubling.
BINS = 64


def counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals of a whole text."""
    words = words_of(text)
    if not words:
        return (0, 0, sum(map(text.count, "#*$%&|<>")) if text else 0, 0, 0, 0, 0)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        until = 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    raw = np.frombuffer(b"".join(words), np.uint8)
    capitals = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    return len(words), chars, sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), repeated, len(lines), capitals


def base_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts per row of ``docs``; a null text has no words."""

    def run(cols):
        rows = list(zip(*map(counts, cols["text"]))) or [()] * 7
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
        return {"doc_id": cols["doc_id"], "lang": cols["lang"], "source": cols["source"]} | dict(zip(names, rows))

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), "text", F.col("lang").cast("string"), F.col("source").cast("string")), STATS, run)


def transformed() -> list[F.Column]:
    """The statistic vector: word length, shares of symbols, equal lines, repeats and capitals, length."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log(F.greatest(F.col("word_chars") / F.greatest("n_words", F.lit(1)), F.lit(1.0))), share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_capitals", "word_chars"), F.log(F.greatest("n_words", F.lit(1))),
    ]


def _chi2_cdf(x: float, p: int) -> float:
    """P(chi-squared with an even number ``p`` of degrees <= x)."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, p) < q else (low, mid)
    return high


def _consistency(share: float) -> float:
    """What the covariance of the innermost ``share`` of a normal sample is to be multiplied by."""
    return share / _chi2_cdf(_chi2_quantile(share, P), P + 2)


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _distance(center: str = "center", precision: str = "precision") -> F.Column:
    """Squared Mahalanobis distance of x0.. from the joined estimate."""
    total = F.lit(0.0)
    for n, (i, j) in enumerate(_PAIRS):
        term = F.expr(f"{precision}[{n}] * (x{i} - {center}[{i}]) * (x{j} - {center}[{j}])")
        total = total + (term if i == j else 2 * term)
    return total


_ESTIMATE = "scope string, start int, n bigint, center array<double>, precision array<double>, logdet double"


def _estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Centre and inverse covariance of each (scope, start) from its sums; one row each, in blocks."""

    def run(frames):
        floor = np.diag(np.square(FLOORS))
        for pdf in frames:
            n = pdf["n"].to_numpy(float)
            first = np.array(pdf["s"].tolist(), float).reshape(len(pdf), P)
            second = np.array(pdf["ss"].tolist(), float).reshape(len(pdf), len(_PAIRS))
            center = first / n[:, None]
            cov = np.zeros((len(pdf), P, P))
            for k, (i, j) in enumerate(_PAIRS):
                cov[:, i, j] = cov[:, j, i] = second[:, k] / n - center[:, i] * center[:, j]
            cov = cov * factor + floor
            inverse = np.linalg.inv(cov)
            yield pd.DataFrame({"scope": pdf["scope"], "start": pdf["start"], "n": pdf["n"], "center": list(center), "precision": [[m[i, j] for i, j in _PAIRS] for m in inverse], "logdet": np.linalg.slogdet(cov)[1]})

    return sums.mapInPandas(run, _ESTIMATE)


def _sums() -> list[F.Column]:
    return [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in _PAIRS)]


_SUMS = [f"s{i}" for i in range(P)] + [f"q{i}_{j}" for i, j in _PAIRS]
_AS_ARRAYS = ["scope", "start", "n", f"array({', '.join(_SUMS[:P])}) AS s", f"array({', '.join(_SUMS[P:])}) AS ss"]


def _medians(rows: DataFrame) -> DataFrame:
    """A first estimate: medians and quartile spreads, counted in bins of 1/512."""
    long = rows.select("scope", F.posexplode(F.array(*(F.floor(F.col(f"x{i}") * 512) for i in range(P)))).alias("j", "bin"))
    hist = long.groupBy("scope", "j", "bin").agg(F.count("*").alias("c"))
    running = hist.withColumn("cum", F.expr("sum(c) OVER (PARTITION BY scope, j ORDER BY bin)")).withColumn("n", F.expr("sum(c) OVER (PARTITION BY scope, j)"))
    at = lambda q: F.min(F.expr(f"CASE WHEN cum >= {q} * n THEN (bin + 0.5D) / 512 END"))
    marks = running.groupBy("scope", "j").agg(at(0.25).alias("low"), at(0.5).alias("mid"), at(0.75).alias("high"), F.first("n").alias("n"))
    floors = F.expr("element_at(array(" + ", ".join(f"{f}D" for f in FLOORS) + "), j + 1)")
    marks = marks.withColumn("weight", 1 / (F.pow((F.col("high") - F.col("low")) / 1.349, 2) + F.pow(floors, 2)))
    wide = marks.groupBy("scope").agg(F.first("n").alias("n"), F.expr("transform(sort_array(collect_list(struct(j, mid))), v -> v.mid)").alias("center"), F.expr("transform(sort_array(collect_list(struct(j, weight))), v -> v.weight)").alias("w"))
    diagonal = F.array(*(F.expr(f"w[{i}]") if i == j else F.lit(0.0) for i, j in _PAIRS))
    return wide.select("scope", F.lit(0).alias("start"), "n", "center", diagonal.alias("precision"), F.lit(0.0).alias("logdet"))


def _concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One C-step: estimates from the ``H`` nearest of each scope, whole distance bins at a time."""
    near = rows.join(broadcast_if_small(estimate.select("scope", "start", "center", "precision")), "scope")
    near = near.withColumn("bin", F.floor(F.log2(_distance() + F.lit(1e-9)) * BINS))
    binned = near.groupBy("scope", "start", "bin").agg(*_sums())
    of = "PARTITION BY scope, start"
    inner = binned.withColumn("below", F.expr(f"sum(n) OVER ({of} ORDER BY bin) - n")).withColumn("all", F.expr(f"sum(n) OVER ({of})")).filter(F.col("below") < H * F.col("all"))
    sums = inner.groupBy("scope", "start").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in _SUMS))
    return cut_lineage(_estimates(sums.selectExpr(*_AS_ARRAYS), _consistency(H)))


def minimum_covariance(rows: DataFrame) -> DataFrame:
    """Reweighted minimum-covariance-determinant estimate of each ``scope`` of ``rows`` (scope, x0..x5).

    Two starts, the medians with quartile spreads and the plain mean and
    covariance, are concentrated by C-steps over all rows; of each scope the one
    with the smaller determinant is reweighted by the 0.975 quantile.
    """
    rows = rows.select("scope", *(f"x{i}" for i in range(P)))
    plain = _estimates(rows.groupBy("scope").agg(*_sums()).withColumn("start", F.lit(1)).selectExpr(*_AS_ARRAYS), 1.0)
    estimate = cut_lineage(_medians(rows).unionByName(plain))
    for _ in range(STEPS):
        estimate = _concentrate(rows, estimate)
    best = estimate.groupBy("scope").agg(F.expr("min_by(struct(center, precision, start), struct(logdet, start))").alias("b")).select("scope", "b.*")
    near = rows.join(broadcast_if_small(best), "scope").filter(_distance() <= _chi2_quantile(0.975, P))
    return cut_lineage(_estimates(near.groupBy("scope", "start").agg(*_sums()).selectExpr(*_AS_ARRAYS), _consistency(0.975)))


_PULLED = "lang string, source string, center array<double>, precision array<double>"


def _pulled(groups: DataFrame, pull: float) -> DataFrame:
    """(lang, source, center, precision) of each group from the estimates e0 of all documents, e1 of its language, e2 of itself.

    Estimates are weighted by the documents behind them, so the group's own
    shape prevails as it grows; there is no size at which the rule changes.
    """

    def run(frames):
        for pdf in frames:
            center = np.zeros((len(pdf), P))
            cov = np.tile(np.diag(np.square(PRIOR)), (len(pdf), 1, 1))
            for level in range(3):
                own = np.zeros((len(pdf), P, P))
                flat = np.array(pdf[f"p{level}"].tolist(), float).reshape(len(pdf), len(_PAIRS))
                for k, (i, j) in enumerate(_PAIRS):
                    own[:, i, j] = own[:, j, i] = flat[:, k]
                n = pdf[f"n{level}"].to_numpy(float)[:, None]
                mine = np.array(pdf[f"c{level}"].tolist(), float).reshape(len(pdf), P)
                center = mine if level == 0 else (n * mine + pull * center) / (n + pull)
                cov = (n[:, :, None] * np.linalg.inv(own) + pull * cov) / (n[:, :, None] + pull)
            inverse = np.linalg.inv(cov)
            yield pd.DataFrame({"lang": pdf["lang"].astype(object), "source": pdf["source"].astype(object), "center": list(center), "precision": [[m[i, j] for i, j in _PAIRS] for m in inverse]})

    return groups.mapInPandas(run, _PULLED)


def quality(docs: DataFrame, quantile: float = QUANTILE, pull: float = PULL) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance of every row of ``docs``.

    Base rules fail documents of fewer than 50 words or with more than half of
    the words in repeated three-word windows.  The others are judged by the
    squared Mahalanobis distance of their transformed statistics from the robust
    estimate of their language and source, which small groups share with their
    language and all documents (``PULL``).
    Null lang or source is a group of its own; null and empty texts have no words
    and fail; repeated rows are judged alike and count as often as given; extra
    columns are ignored.
    """
    stats = cut_lineage(base_statistics(docs))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # a length before the value keeps ("a", "bc") apart from ("ab", "c") and null apart from any text
    key = lambda *cols: F.concat(*(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in cols))
    stats = stats.withColumn("base_failed", failed).select("*", *(x.alias(f"x{i}") for i, x in enumerate(transformed())))
    passed = stats.filter(~F.col("base_failed"))
    levels = [F.lit("all"), F.concat(F.lit("lang "), key("lang")), F.concat(F.lit("group "), key("lang", "source"))]
    estimate = minimum_covariance(passed.withColumn("scope", F.explode(F.array(*levels)))).select("scope", "n", "center", "precision")
    groups = passed.select("lang", "source").distinct().select("*", *(x.alias(f"s{i}") for i, x in enumerate(levels)))
    for i in range(3):
        groups = groups.join(estimate.select(F.col("scope").alias(f"s{i}"), F.col("n").cast("double").alias(f"n{i}"), F.col("center").alias(f"c{i}"), F.col("precision").alias(f"p{i}")), f"s{i}")
    own = cut_lineage(_pulled(groups, pull)).select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "center", "precision")
    same = F.expr("lang <=> g_lang AND source <=> g_source")
    judged = stats.join(broadcast_if_small(own), same, "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= _chi2_quantile(quantile, P))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
