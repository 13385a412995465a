"""Periodic runs against a definition-by-definition search."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aspectra.llm import periodic_runs as P
from aspectra.llm import queries


def brute(words, least=12):
    """Every period: the maximal stretches in which words one period apart are equal."""
    numbers: dict = {}
    w, found = np.array([numbers.setdefault(x, len(numbers)) for x in words], dtype=np.int64), {}
    for q in range(1, len(w) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.r_[False, w[:-q] == w[q:], False]))
        for i, e in edge.reshape(-1, 2).tolist():
            if e - i >= q:                                  # [i, e + q) has period q
                found.setdefault((i, e + q - i), q)         # smaller periods come first
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def planted(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5),
       st.lists(st.integers(1, 9), min_size=5, max_size=5))
def test_runs_of_small_alphabets(texts, repeat):
    texts = [(t * r)[:80] for t, r in zip(texts, repeat)]
    assert P.runs_of_texts(texts) == [brute(t) for t in texts]


def test_fibonacci_and_single_word_and_long_periods():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    rnd = random.Random(7)
    block = [str(rnd.randrange(300)).encode() for _ in range(150)]
    texts = [b, [b"x"] * 500, block * 3 + block[:20], [b"p", b"q"] * 200 + [b"q"] + [b"p", b"q"] * 90]
    assert P.runs_of_texts(texts) == [brute(t) for t in texts]


def test_long_periodic_text_is_fast():
    runs = P.runs_of_texts([[b"w"] * 60_000, [b"u", b"v", b"w"] * 20_000])
    assert runs == [[(0, 60_000, 1)], [(0, 60_000, 3)]]


def test_groups_of_texts_do_not_mix(monkeypatch):
    monkeypatch.setattr(P, "GROUP_WORDS", 30)
    monkeypatch.setattr(P, "PROBES", 7)
    texts = [[b"a", b"b"] * 8, [], [b"a", b"b"] * 8, [b"b"] * 5, [b"b"] * 14]
    assert P.runs_of_texts(texts) == [brute(t) for t in texts]


def test_operator_cases(spark):
    long_text = " ".join(["one", "two", "three"] * 30_000)
    rows = [(1, None, 5), (2, "", 5), (None, "a " * 12, 5), (3, "a\tb\x0b" * 6 + "é x", 6), (3, "a\tb\x0b" * 6 + "é x", 6),
            (4, long_text, 1), (5, "x y z", None)]
    df = spark.createDataFrame(rows, "`a.id` long, `my text` string, runs int").withColumns({"id": F.lit("z"), "collapsed": F.lit(1)})
    got = {(r["a.id"], r["n_words"]): r for r in P.find_runs(df, "a.id", "my text").collect()}
    assert got[1, 0].runs == [] and got[1, 0].collapsed == "" and got[2, 0].collapsed == ""
    assert [tuple(x) for x in got[None, 12].runs] == [(0, 12, 1)] and got[None, 12].collapsed == "a"
    assert [tuple(x) for x in got[3, 13].runs] == [(0, 12, 2)] and got[3, 13].collapsed == "a b é x"
    assert [tuple(x) for x in got[4, 90_000].runs] == [(0, 90_000, 3)] and got[4, 90_000].collapsed == "one two three"
    assert P.find_runs(df, "a.id", "my text").count() == 7
    assert P.find_runs(df.limit(0), "a.id", "my text").count() == 0


@pytest.fixture(scope="module")
def expected(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    out = {}
    for doc_id, text in rows:
        words = planted((text or "").encode().split(), doc_id)
        runs = brute(words)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        out[doc_id] = (runs, b" ".join(w for i, w in enumerate(words) if i not in drop))
    return out


def test_query_against_brute_force(spark, expected):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert sum(bool(r) for r, _ in expected.values()) > 50
    for doc_id, (runs, left) in expected.items():
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left).hexdigest()
