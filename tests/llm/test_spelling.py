"""Spelling variants against all pairs and a plain edit distance."""

import random
import zlib
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aspectra.llm import queries
from aspectra.llm import spelling as S


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1] == 1


def brute(counts):
    rows = {}
    for w, n in counts.items():
        near = [v for v in counts if distance_is_one(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        ok = best is not None and counts[best] >= 2 * n
        rows[w] = [best if ok else None, n, len(near), counts[best] if ok else None]
    out = set()
    for w, (form, n, k, m) in rows.items():
        root = w
        while rows[root][0] is not None:
            root = rows[root][0]
        out.add((w, form, root, n, k, m))
    return out


def got(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def some_words(count, seed, letters="abeé", most=7):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, most))) for _ in range(count)}
    return {w: rnd.choice([1, 2, 3, 5, 9, 20, 100, 100]) for w in sorted(words)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abexÿ", min_size=1, max_size=5), min_size=1, max_size=40, unique=True), st.integers(1, S.DEEPEST))
def test_every_near_pair_is_found_once(words, depth):
    homes: dict = {}
    for w in words:
        length, v = S.vectors([w])
        homes.setdefault(S.reachable(int(length[0]), v[0].tolist(), depth)[0], []).append(w)
    tries = {k: S.Trie(h, [1] * len(h), depth) for k, h in homes.items()}
    found = []
    for w in words:
        length, v = S.vectors([w])
        keys = S.reachable(int(length[0]), v[0].tolist(), depth)
        assert len(set(keys)) == len(keys)
        for k in keys:
            if k in tries:
                found += [(w, tries[k].words[j]) for _, j in tries[k].near([w])]
    assert sorted(tuple(sorted(p)) for p in found) == sorted(
        (a, b) for a in words for b in words if a < b and distance_is_one(a, b))


def test_against_brute_force_whole_and_in_blocks(spark, monkeypatch):
    for limit, deepest, leaf, visitors in ((50_000, 6, 16, 20_000), (40, 6, 2, 50), (5, 2, 3, 7)):
        for name, value in (("SUBTREE", limit), ("DEEPEST", deepest), ("LEAF", leaf), ("VISITORS", visitors)):
            monkeypatch.setattr(S, name, value)
        counts = some_words(400, limit)
        df = spark.createDataFrame(list(counts.items()), "word string, n long")
        assert got(S.group_variants(df)) == brute(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "ccccc": 3, "cccccd": 6, "ccccce": 6, "zzzzz": 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(S.group_variants(df))
    assert rows == brute(counts)
    assert {(w, r) for w, _, r, *_ in rows} >= {("aaaaa", "bbbbb"), ("ccccc", "cccccd"), ("zzzzz", "zzzzz")}


def test_defined_cases(spark):
    long_word = "ab" * 3000
    rows = [("hello", 3, 1), ("hello", 4, 2), (None, 5, 1), ("hallo", 14, 1), ("nulls", None, 1), (long_word, 1, 1), (long_word + "b", 2, 1)]
    df = spark.createDataFrame(rows, "`my word` string, `n.n` long, form int").withColumns({"root": F.lit(1), "key": F.lit("x")})
    assert got(S.group_variants(df, "my word", "n.n")) == {
        ("hello", "hallo", "hallo", 7, 1, 14), ("hallo", None, "hallo", 14, 1, None),
        (long_word, long_word + "b", long_word + "b", 1, 1, 2), (long_word + "b", None, long_word + "b", 2, 1, None)}
    assert S.group_variants(df.limit(0), "my word", "n.n").count() == 0


def test_query_words_of_contract(spark, tmp_path):
    rnd = random.Random(4)
    pool = ["Straße", "strase", "strasse", "stra÷e", "HELLO", "hallo", "hellÖ", "hellö", "abcd", "Abcde", "ab×cde"]
    rows = [(i if i % 37 else None, " ".join(rnd.choice(pool) for _ in range(60)) + "-x9") for i in range(300)] + [(1, None), (2, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    assert got(queries.op12_spelling_variants(spark, str(tmp_path))) == brute({w: n for w, n in counts.items() if n >= 3})
