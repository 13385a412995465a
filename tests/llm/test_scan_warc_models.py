"""Secret scans and WARC against brute force; classifiers on held-out rows."""
import hashlib
import random
import re
from base64 import b32encode

import pytest
from pyspark.sql import functions as F

from aspectra.llm import langid, secret_scan, toxicity, warc
from aspectra.llm.common import run_folder

CI = "".join  # spelled-out classes below are independent of the scanner's flags


def any_case(word):
    return CI(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api")
                    + "_?" + any_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def secret_texts():
    r = random.Random(8)
    bits = ["password", "PASSWD", "Secret", "toKen", "api_key", "APIKEY", "apikey", "ſecret", "toKen", '"', "'", " ", "=", ":", "==",
            "abcdef", "abc", "x9/+_.=-", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef0123456789abcdef", "\n", "é", "日", "🙂"]
    fixed = [None, "", "password=short1", "password=token=abcdef", "secret : 'abcdefgh'", "AKIAAKIA" + "A" * 16, "f" * 23, "f" * 24, "F" * 24,
             "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "pass word = abcdefg", "é" * 5 + "token=abcdefé"]
    return fixed + ["".join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(500)]


def test_spans_equal_running_every_regex(spark):
    ts = secret_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ts)], "doc_id long, text string, spans string").repartition(3)
    kinds = [r.kind for r in secret_scan.RULES]
    rest = secret_scan.RULES[3:]
    for r in secret_scan.scan(df).collect():
        t = ts[r.doc_id] or ""
        got = [(s.start, kinds.index(s.kind), s.end) for s in r.spans]
        assert [g for g in got if g[1] < 3] == brute_base(t), repr(t)
        want = [(m.start(), 3 + k, m.end()) for k, x in enumerate(rest) for m in x.compiled().finditer(t)]
        assert [g for g in got if g[1] >= 3] == sorted(want)
        assert got == sorted(got)


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q("abcd") == ("and", "abc", "bcd") and q("AbC") == "abc"
    assert q("[0-9a-f]{24,}") is True and q("ab.cd") is True
    assert q("(?:abc|xyz)+") == ("or", "abc", "xyz")
    assert q("ab?cd") == ("or", ("and", "abc", "bcd"), "acd")
    assert q("abc.*def") == ("and", "abc", "def") and q("(?:abc|.)d") is True
    assert q("x[0-9]*abc{2,}") is True or "abc" not in str(q("x[0-9]*ab"))


def test_query_never_rules_out_a_match():
    """Random patterns: every text with a match satisfies the pattern's trigram query."""
    r = random.Random(3)

    def pattern(depth):
        kind = r.randrange(6 if depth else 2)
        if kind < 2:
            return "".join(r.choice("abc") for _ in range(r.randrange(1, 5)))
        a, b = pattern(depth - 1), pattern(depth - 1)
        return (f"(?:{a}|{b})", f"{a}{b}", f"(?:{a})?{b}", f"{a}(?:{b}){{1,3}}")[kind - 2]

    def holds(q, t):
        if q is True:
            return True
        if isinstance(q, str):
            return q in t
        return (all if q[0] == "and" else any)(holds(x, t) for x in q[1:])

    for _ in range(400):
        p = pattern(3)
        q, regex = secret_scan.trigram_query(p), re.compile(p)
        for _ in range(40):
            t = "".join(r.choice("abc") for _ in range(r.randrange(0, 14)))
            assert not regex.search(t) or holds(q, t), (p, q, t)


def test_segments_and_long_texts(monkeypatch):
    monkeypatch.setattr(secret_scan, "SEGMENT_CHARS", 50)
    s = secret_scan.Scanner(secret_scan.RULES)
    ts = ["x" * 47 + "password=abcdef" + "y" * 100, "", "token=" + "z" * 9, "é" * 120 + "api_key: q1w2e3"] * 3
    assert [[f for f in x if f[1] < 3] for x in s.spans(ts)] == [brute_base(t) for t in ts]


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a password=abcdefg b", 20), (2, None, 7), (3, "clean", 5), (3, "clean", 5)],
                               "doc_id long, text string, n_chars int")
    got = sorted((r.doc_id, r.text, r.n_chars) for r in secret_scan.redact(df).collect() if r.text)
    assert got == [(1, "a [assign] b", 12), (3, "clean", 5), (3, "clean", 5)]
    two = ((0, 0, 5), (3, 2, 9), (12, 2, 14))
    assert secret_scan.mask("0123456789abcdef", two, secret_scan.RULES) == "[assign]9ab[hex]ef"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


PAGES = ([(i, f"http://h/{i}?q=é\r\nX: y%20", f"<p>{i % 5}</p>", "z") for i in range(40)]
         + [(50, None, None, None), (51, "u", "", None), (52, "http://a b", "日本 🙂\r\n\r\nWARC/1.0", "z"), (60, "u", "same row", None), (60, "u", "same row", None)])


@pytest.mark.parametrize("least", [0, 9])
def test_warc_round_trip(spark, least):
    df = pages(spark, PAGES).repartition(3)
    index = warc.write_archives(df, run_folder(spark, "warc-test"), min_bytes=least)
    assert index.count() == len(PAGES)
    got = warc.read_records(index).collect()
    first = {}
    for p, _, h, _ in PAGES:
        first[h or ""] = min(p, first.get(h or "", p))
    want = []
    for p, u, h, _ in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= least and first[h or ""] != p
        want.append((str(p), u, len(raw), b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response",
                     str(first[h or ""]) if again else None, None if again else raw))
    key = lambda x: (int(x[0]), str(x[1]))
    assert sorted([(r.record_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)
    some = warc.read_records(index.filter(F.col("page_id").isin(3, 17, 52)))
    assert {r.record_id for r in some.collect()} == {"3", "17", "52"}


def test_warc_ranges_and_checks(spark):
    assert list(warc.coalesce_ranges([(0, 10), (10, 5), (100, 5), (104, 9)], gap=20, most=100)) == [(0, 2, 0, 15), (2, 4, 100, 113)]
    assert list(warc.coalesce_ranges([(0, 60), (60, 60)], gap=20, most=100)) == [(0, 1, 0, 60), (1, 2, 60, 120)]
    raw = warc.record_bytes(1, "u", "response", None, b"body", 4, b32encode(hashlib.sha1(b"body").digest()).decode())
    assert warc.parse_record(raw)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"body", b"bodz"))
    assert warc.write_archives(pages(spark, []), run_folder(spark, "warc-empty")).count() == 0
    row = spark.sql("SELECT 'The quick' AS t").select(warc.base32_sha1(F.col("t").cast("binary"))).first()[0]
    assert row == b32encode(hashlib.sha1(b"The quick").digest()).decode()


def talk(r, lang, toxic=False):
    words = {"xx": ["thon", "ering", "nded", "was"], "yy": ["çeau", "queli", "ére", "les"]}[lang]
    w = [r.choice(words) + r.choice(words) for _ in range(r.randrange(5, 60))]
    if toxic:
        w.insert(r.randrange(len(w)), r.choice(["stupid", "moron", "Trash!"]))
    return " ".join(w)


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(6)
    rows = [(i, talk(r, r.choice(["xx", "yy"]), i % 6 == 0), int(i % 6 == 0)) for i in range(1200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "moron"), (7, rows[7][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (0, 0), (None, 1)], "doc_id long, toxic int")
    train = toxicity.training_rows(docs, labels)
    assert not train.filter("crc32(cast(doc_id as string)) % 3 = 1").count()
    model = toxicity.train(train)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 1204 and all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: x.score for x in got}
    assert by[5000] == by[5001] < 0.5 and by[None] > 0.7
    import zlib
    held = [(by[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(y) for s, y in held) / len(held) > 0.97
    one = toxicity.train(train.filter("label = 0"))
    assert all(x.score < 0.01 for x in toxicity.score(docs, one).collect())
    empty = docs.filter("doc_id < -1")
    assert toxicity.score(empty, model).count() == 0
    base = toxicity.train(train.filter("doc_id < -1"))
    assert {x.score for x in toxicity.score(docs, base).collect()} == {0.5}


def test_language_on_held_out_rows(spark):
    r = random.Random(7)
    rows = [(i, talk(r, l), l) for i in range(600) for l in [r.choice(["xx", "yy"])]]
    extra = [(900, None, "xx"), (901, "12 34 !", "xx"), (902, "", None), (903, talk(r, "yy"), None), (None, "thon", "xx"), (904, "日本", None)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    model = langid.train(langid.training_rows(docs))
    assert model.languages == ["xx", "yy"]
    got = {x.doc_id: x for x in langid.predict(docs, model).collect()}
    assert len(got) == 606 and all(0 <= x.score <= 1 for x in got.values())
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred == "yy" and got[904].lang_pred in ("xx", "yy")
    assert sum(got[i].lang_pred == l for i, _, l in rows) / 600 > 0.99
    none = langid.train(docs.filter("lang IS NULL"))
    assert {x.lang_pred for x in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.filter("doc_id < -1"), model).count() == 0


def test_reading_back_is_shared_out_by_archive_bytes(spark, tmp_path, monkeypatch):
    import os

    from aspectra.llm import warc
    pages = spark.createDataFrame([(i, f"u{i}", os.urandom(3000).hex()) for i in range(60)], "page_id long, url string, html string")
    index = warc.write_archives(pages, f"file://{tmp_path}/w")
    total = sum(r.length for r in index.collect())
    monkeypatch.setattr(warc, "TASK_BYTES", total // 5)
    assert warc.read_tasks(index) in (5, 6)
    back = warc.read_records(index)
    assert back.rdd.getNumPartitions() == warc.read_tasks(index) and back.count() == 60
    assert warc.read_tasks(index.limit(0)) == 1
