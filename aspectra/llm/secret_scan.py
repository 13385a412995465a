"""Secret scans through a trigram inverted index.

Every rule's regex is parsed once and turned into a Boolean query over trigrams that each
match must contain (AND along a sequence, OR over alternatives).  Tasks index the documents
they read in segments of bounded size: a posting list per trigram that some query mentions.
Intersecting and uniting postings gives the candidates of each rule, and only those are
verified with the rule's regex.  A rule without a mandatory trigram (a bare run of hex
digits) has every document as a candidate and scans fully.  The index is built and searched
where the texts are read, so no text is shuffled; queries only rule documents out, so the
spans are exactly those of running every regex over every text.

Index and queries fold ASCII case.  Spans count code points, end exclusive; within a kind
they are leftmost and do not overlap.

Defined cases: null counts as empty; an empty text has no spans; repeated rows get a row
each; spans of equal start are ordered as the kinds are listed; an empty table gives no
rows; ``scan`` drops other columns and ``redact`` carries them, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, texts_of

SEGMENT_CHARS = 2_000_000   # characters indexed together
MAX_STRINGS = 64            # exact strings followed through a sequence
MAX_CLASS = 8               # larger character classes end an exact string


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` with the least length of a group (0: the whole match); shorter ones fail."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


BASE = ("assign", "access", "hex")
RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # the runs [0-9a-f]+ of at least 24 characters: a shorter run fails wherever it starts
    SecretRule("hex", r"[0-9a-f]{24,}"),
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


# ---------------------------------------------------------------------------------------
# regex -> Boolean trigram query: True (no constraint), a trigram, ("and", ...), ("or", ...)
# ---------------------------------------------------------------------------------------
def _both(a, b):
    if a is True or b is True:
        return b if a is True else a
    return ("and", a, b)


def _either(queries):
    queries = list(queries)
    if not queries or any(q is True for q in queries):
        return True
    return queries[0] if len(queries) == 1 else ("or", *queries)


def _strings_query(strings: set[str]):
    """What a text must contain if it contains one of the strings."""
    def one(s):
        tri = sorted({s[i:i + 3] for i in range(len(s) - 2)})
        return True if not tri else tri[0] if len(tri) == 1 else ("and", *tri)
    return _either(one(s) for s in sorted(strings))


def _fold(code: int) -> str | None:
    return chr(code).lower() if code < 128 else None


def _class(items) -> set[str] | None:
    """Folded characters of a small class, None if it is large or negated."""
    out = set()
    for op, arg in items:
        if op is sre.LITERAL:
            codes = [arg]
        elif op is sre.RANGE and arg[1] - arg[0] < 2 * MAX_CLASS:
            codes = range(arg[0], arg[1] + 1)
        else:
            return None
        out |= {_fold(c) for c in codes}
    return out if None not in out and len(out) <= MAX_CLASS else None


def _exact(node):
    """(exact strings or None, query) of one parsed item."""
    op, arg = node
    if op is sre.LITERAL:
        c = _fold(arg)
        return ({c}, True) if c else (None, True)
    if op is sre.IN:
        return _class(arg), True
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(e is not None for e, _ in parts):
            union = set().union(*[e for e, _ in parts])
            if len(union) <= MAX_STRINGS:
                return union, True
        return None, _either(q if e is None else _strings_query(e) for e, q in parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, sub = arg
        e, q = _sequence(sub)
        if (least, most) == (0, 1) and e is not None:
            return e | {""}, True
        if least == most == 1:
            return e, q
        return None, True if least == 0 else q if e is None else _strings_query(e)
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return {""}, True
    return None, True


def _sequence(nodes):
    current, whole, query = {""}, True, True
    for node in nodes:
        e, q = _exact(node)
        joined = {a + b for a in current for b in e} if e is not None else None
        if joined is not None and len(joined) <= MAX_STRINGS:
            current = joined
            continue
        whole = False
        query = _both(_both(query, _strings_query(current)), q)
        current = {""}
        if e is not None:
            current = e
    if whole:
        return current, True
    return None, _both(query, _strings_query(current))


def trigram_query(pattern: str):
    """The Boolean trigram query every match of ``pattern`` satisfies."""
    e, q = _sequence(sre_parser.parse(pattern, re.ASCII))
    return q if e is None else _strings_query(e)


def _trigrams(query) -> set[str]:
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*[_trigrams(q) for q in query[1:]])


# ---------------------------------------------------------------------------------------
# index and search
# ---------------------------------------------------------------------------------------
class Scanner:
    def __init__(self, rules: tuple[SecretRule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        tri = sorted(set().union(*[_trigrams(q) for _, _, q in self.rules]))
        self.number = {t: i for i, t in enumerate(tri)}
        chars = sorted(set("".join(tri)))
        self.codes = np.zeros(256, dtype=np.int32)          # 0: occurs in no query
        for i, c in enumerate(chars):
            self.codes[[ord(c), ord(c.upper())]] = i + 1
        self.base = len(chars) + 1
        self.table = np.full(self.base ** 3, -1, dtype=np.int32)
        for t, i in self.number.items():
            a, b, c = (self.codes[ord(x)] for x in t)
            self.table[(a * self.base + b) * self.base + c] = i

    def postings(self, texts: list[str]) -> list[np.ndarray]:
        """Per trigram the sorted numbers of the texts that contain it."""
        seen = np.zeros((len(self.number), len(texts)), dtype=bool)
        # characters beyond Latin-1 become '?', which can only add candidates
        raw = "\n\n".join(texts).encode("latin-1", "replace")
        starts = np.cumsum([0] + [len(t) + 2 for t in texts])[:-1]
        for at in range(0, len(raw), SEGMENT_CHARS):
            c = self.codes[np.frombuffer(raw[at:at + SEGMENT_CHARS + 2], dtype=np.uint8)]
            if len(c) < 3:
                continue
            hit = self.table[(c[:-2] * self.base + c[1:-1]) * self.base + c[2:]]
            where = np.flatnonzero(hit >= 0)
            seen[hit[where], np.searchsorted(starts, where + at, side="right") - 1] = True
        return [np.flatnonzero(row) for row in seen]

    def search(self, query, postings, n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if isinstance(query, str):
            return postings[self.number[query]]
        parts = [self.search(q, postings, n) for q in query[1:]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, True) if query[0] == "and" else np.union1d(out, p)
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text its (start, rule number, end), sorted."""
        found: list[list] = [[] for _ in texts]
        for lo, hi in _segments(texts):
            part = texts[lo:hi]
            post = self.postings(part)
            for k, (rule, regex, query) in enumerate(self.rules):
                for d in self.search(query, post, len(part)).tolist():
                    found[lo + d] += [(m.start(), k, m.end()) for m in regex.finditer(part[d])
                                      if m.end(rule.group) - m.start(rule.group) >= rule.least]
        for f in found:
            f.sort()
        return found


def _segments(texts):
    """Runs of texts of at most SEGMENT_CHARS characters (a longer text is its own run)."""
    lo = chars = 0
    for i, t in enumerate(texts):
        if i > lo and chars + len(t) > SEGMENT_CHARS:
            yield lo, i
            lo, chars = i, 0
        chars += len(t)
    if lo < len(texts):
        yield lo, len(texts)


@lru_cache(maxsize=4)
def scanner(rules: tuple[SecretRule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """id and ``spans`` of every document, by start and then kind."""
    ready(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            found = scanner(rules).spans(list(texts_of(b.column(1))))
            rows = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in f] for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["i", "s"])

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, f"`{id_col}` {id_type}, spans {SPANS}")


def mask(text: str, spans, rules) -> str:
    """``text`` with every span (overlapping ones as one) replaced by ``[kind]``."""
    out, at, open_end = [], 0, -1
    for start, k, end in spans:
        if start >= open_end:
            out += [text[at:start], f"[{rules[k].kind}]"]
        open_end = at = max(open_end, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
           rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """All rows and columns; secrets in the text are replaced by ``[kind]`` and, where the
    text changed, ``chars_col`` (if there) is its new length.  Null texts stay null."""
    ready(docs.sparkSession)
    pos = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(pos).to_pylist()
            found = scanner(rules).spans([t or "" for t in texts])
            cols = list(b.columns)
            cols[pos] = pa.array([mask(t, f, rules) if f else t for t, f in zip(texts, found)], pa.string())
            cols.append(pa.array([bool(f) for f in found]))
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])

    # columns are numbered on the way, so no name of theirs meets one of ours
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    out = numbered.mapInArrow(run, schema + ", changed boolean")
    cols = [F.col(f"c{i}") for i in range(len(docs.columns))]
    if chars_col in docs.columns:
        at = docs.columns.index(chars_col)
        cols[at] = F.when(F.col("changed"), F.length(cols[pos]).cast(docs.schema[chars_col].dataType)).otherwise(cols[at])
    return out.select(*[c.alias(name) for c, name in zip(cols, docs.columns)])
