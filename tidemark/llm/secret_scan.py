"""Secret scans through a trigram inverted index over segments of documents."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from re import _constants as C
from re import _parser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows


class Rule(NamedTuple):
    """A kind of secret: matches of ``pattern``, leftmost and not overlapping, for which ``keep`` holds."""

    kind: str
    pattern: str
    keep: Callable[[re.Match], bool] = lambda m: True


# The published shapes of keys and tokens, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: m.end(2) - m.start(2) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # runs of [0-9a-f]+ with 16 or more are the same matches
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_api", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)
BASE = ("assign", "access", "hex")
#: Documents of one index segment.
SEGMENT = 512


class Query(NamedTuple):
    """A Boolean query: ``all`` of its parts or ``any`` of them; a leaf has a trigram."""

    op: str
    parts: tuple = ()


ANY = Query("true")


def _conjunction(parts) -> Query:
    parts = tuple(dict.fromkeys(p for p in parts if p != ANY))
    return ANY if not parts else parts[0] if len(parts) == 1 else Query("all", parts)


def _of_literal(text: str) -> Query:
    folded = text.lower().encode()
    return _conjunction(Query("gram", (folded[i : i + 3],)) for i in range(len(folded) - 2))


#: Alternatives are joined with what stands around them up to so many strings.
EXPANSION = 64


def trigram_query(pattern: str) -> Query:
    """What trigrams (lower case) every match of ``pattern`` has: a necessary Boolean condition.

    Literal runs give conjunctions, alternatives disjunctions; short sets and
    optional parts are multiplied out while at most ``EXPANSION`` strings
    result.  Anything else ends a run.  ``ANY`` if no trigram is mandatory.
    """

    def single(op, arg) -> list[str] | None:
        """The strings of an element if they are few and ASCII."""
        if op is C.LITERAL:
            return [chr(arg)] if arg < 128 else None
        if op is C.IN and all(k is C.LITERAL and v < 128 for k, v in arg) and len(arg) <= 8:
            return [chr(v) for _, v in arg]
        if op is C.SUBPATTERN:
            return strings(arg[3])
        if op is C.BRANCH:
            options = [strings(x) for x in arg[1]]
            return None if any(x is None for x in options) else [y for x in options for y in x]
        if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] == 1 and arg[0] in (0, 1):
            inner = strings(arg[2])
            return None if inner is None else inner + [""] * (arg[0] == 0)
        return None

    def strings(items) -> list[str] | None:
        out = [""]
        for op, arg in items:
            more = single(op, arg)
            if more is None or len(out) * len(more) > EXPANSION:
                return None
            out = [a + b for a in out for b in more]
        return list(dict.fromkeys(x.lower() for x in out))

    def either(run: list[str]) -> Query:
        options = list(dict.fromkeys(_of_literal(x) for x in run))
        if ANY in options:
            return ANY
        least = [q for q in options if not any(grams(o) < grams(q) for o in options)]
        return least[0] if len(least) == 1 else Query("any", tuple(least))

    def query(items) -> Query:
        parts, run = [], [""]
        for op, arg in items:
            more = single(op, arg)
            if more is not None and len(run) * len(more) <= EXPANSION:
                run = list(dict.fromkeys((a + b).lower() for a in run for b in more))
                continue
            parts.append(either(run))
            run = [""] if more is None else more
            if more is None:
                if op is C.SUBPATTERN:
                    parts.append(query(arg[3]))
                elif op is C.BRANCH:
                    options = [query(x) for x in arg[1]]
                    parts.append(ANY if ANY in options else Query("any", tuple(options)))
                elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
                    parts.append(query(arg[2]))
        return _conjunction([*parts, either(run)])

    return query(list(_parser.parse(pattern, re.ASCII)))


def grams(query: Query) -> set[bytes]:
    return set(query.parts) if query.op == "gram" else set().union(*map(grams, query.parts))


def postings(texts: list[bytes], wanted: set[bytes]) -> dict[bytes, np.ndarray]:
    """The inverted index of a segment: for each wanted trigram the documents that hold it, ascending."""
    # a byte that no trigram has stands between documents
    joined = b"\xff".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    limits = ends.tolist()
    out = {}
    for gram in wanted:
        found, at = [], joined.find(gram)
        while at >= 0:
            doc = int(np.searchsorted(ends, at, "right"))
            found.append(doc)
            at = joined.find(gram, limits[doc])
        out[gram] = np.array(found, np.int64)
    return out


def candidates(query: Query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """The documents that a query admits, from intersected and united postings."""
    if query == ANY:
        return np.arange(n)
    if query.op == "gram":
        return index[query.parts[0]]
    lists = sorted((candidates(p, index, n) for p in query.parts), key=len)
    if query.op == "any":
        return np.unique(np.concatenate(lists))
    out = lists[0]
    for other in lists[1:]:
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def segment_spans(texts: list[str | None], rules=RULES) -> list[list[tuple[int, int, int]]]:
    """Of each document the (start, rule number, end) found by the rules, by start and then rule."""
    texts = [t or "" for t in texts]
    queries = [trigram_query(r.pattern) for r in rules]
    index = postings([t.encode().lower() for t in texts], set().union(*map(grams, queries)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, query) in enumerate(zip(rules, queries)):
        compiled = re.compile(rule.pattern, re.ASCII)
        for doc in candidates(query, index, len(texts)).tolist():
            out[doc].extend((m.start(), number, m.end()) for m in compiled.finditer(texts[doc]) if rule.keep(m))
    return [sorted(x) for x in out]


def secrets(docs: DataFrame, rules=RULES, segment: int = SEGMENT) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans, of every row of ``docs``.

    Documents are indexed in segments of at most ``segment`` rows: only trigrams
    that some rule's query names have postings.  A rule's query decides from
    them which documents of the segment its pattern is run on; rules without a
    mandatory trigram run on all.  No row leaves its task, so hot sources and
    copies cost no more than others.  Null and empty texts have no spans; repeated
    rows come back as given; a null doc_id is kept; extra columns are ignored.
    """

    def run(cols):
        found = segment_spans(cols["text"], rules)
        name = [r.kind for r in rules]
        spell = lambda spans: ",".join(f"{name[k]}:{s}:{e}" for s, k, e in spans)
        count = lambda kind: [sum(name[k] == kind for _, k, _ in spans) for spans in found]
        return {
            "doc_id": cols["doc_id"], "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
            "base_sha256": [hashlib.sha256(spell([s for s in spans if name[s[1]] in BASE]).encode()).hexdigest() for spans in found], "spans": [spell(spans) for spans in found],
        }

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), schema, run, segment)


def redact(text: str, spans: list[tuple[int, int, int]], rules=RULES) -> str:
    """``text`` with overlapping spans merged and each replaced by the kind that begins it."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{rules[kind].kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, rules=RULES, segment: int = SEGMENT) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by their kind in brackets; all other columns as they are.

    ``n_chars``, where there is one, follows the text.  Rows without a secret come back unchanged.
    """
    import pyarrow as pa

    schema = docs.schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, segment):
                part = batch.slice(at, segment)
                texts = part.column("text").to_pylist()
                found = segment_spans(texts, rules)
                if any(found):
                    texts = [redact(t, s, rules) if s else t for t, s in zip(texts, found)]
                    new = {"text": texts}
                    if "n_chars" in part.schema.names:
                        new["n_chars"] = [len(t) if s else n for t, s, n in zip(texts, found, part.column("n_chars").to_pylist())]
                    part = pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else part.column(f.name) for f in part.schema], schema=part.schema)
                yield part

    return docs.mapInArrow(run, schema)
