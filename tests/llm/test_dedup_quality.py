"""Exact dedup and quality ledger against plain Python, with hostile rows."""
import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from aspectra.llm import exact_dedup, quality

SCHEMA = "doc_id long, text string, keep_id string, n_words int, __x long"


def rows_of(pairs):
    return [(i, t, "clash", 1, 2) for i, t in pairs]


def test_groups_equal_brute_force(spark):
    r = random.Random(1)
    pairs = [(i, r.choice(["hot"] * 6 + [f"t{r.randrange(60)}", None, "", "Hot", "hot "])) for i in range(600)]
    pairs += [(None, "hot"), (None, "only null"), (None, "only null"), (700, "twice"), (700, "twice")]
    df = spark.createDataFrame(rows_of(pairs), SCHEMA).repartition(5)
    by = {}
    for i, t in pairs:
        by.setdefault(t or "", []).append(i)
    want = Counter()
    for i, t in pairs:
        g = by[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want[(i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    got = Counter(map(tuple, exact_dedup.duplicate_groups(df).collect()))
    assert got == want
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    have = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(t for _, t in have) == sorted(by)
    assert all(i == max((x for x in by[t] if x is not None), default=None) for i, t in have)


def test_light_and_heavy_routes_agree(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i % 40}" if i % 3 else "hot", "", 0, 0) for i in range(500)], SCHEMA)
    want = sorted(map(tuple, exact_dedup.duplicate_groups(df).collect()))
    monkeypatch.setattr(exact_dedup, "HEAVY_SHARE", 0.2)       # only "hot" is heavy
    assert sorted(map(tuple, exact_dedup.duplicate_groups(df).collect())) == want
    monkeypatch.setattr(exact_dedup, "HEAVY_SHARE", 0.9)       # nothing is
    assert sorted(map(tuple, exact_dedup.duplicate_groups(df).collect())) == want


def test_summary_finds_the_heavy_hitter(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("h")).otherwise(F.col("id").cast("string")).alias("t"))
    d = df.select(F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("__dd_sha"))
    top = exact_dedup.frequent_candidates(d).orderBy(F.desc("__dd_est")).first()
    key = spark.sql("SELECT xxhash64(unhex(sha2('h', 256)))").first()[0]
    assert top["__dd_key"] == key and top["__dd_est"] >= 6667


def brute_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(hit))


def texts(n):
    r = random.Random(4)
    out = [None, "", " \t\n", "a", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 30, "é\x0b日本 🙂\x0cz", "l\nl\n\nl", "# * <b>", "\x1c\x85 \xa0"]
    for _ in range(n):
        words = [r.choice("abcdefgh") + r.choice(["", "x", "#"]) for _ in range(r.randrange(0, 60))]
        if r.random() < 0.5 and len(words) > 12:
            words += words[3:3 + r.randrange(6, 12)]
        out.append("".join(w + r.choice(["  ", " ", "\n", "\r\n"]) for w in words))
    return out


def test_measures_equal_brute_force(spark):
    ts = texts(250)
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in enumerate(ts)], SCHEMA).repartition(3)
    led = quality.ledger(df)
    for r in led.collect():
        got = tuple(r[m] for m in quality.MEASURES)
        assert got == brute_measures(ts[r.doc_id]), repr(ts[r.doc_id])
        assert bool(r.fail_mask & 1) == (got[0] < 20)
        assert bool(r.fail_mask & 2) == (100 * got[5] > 30 * got[0])


def test_policies_and_ablation_come_from_masks(spark):
    df = spark.createDataFrame(rows_of(enumerate(texts(150))), SCHEMA)
    led = quality.ledger(df).cache()
    masks = [r.fail_mask for r in led.collect()]
    pm = quality.policy_mask("web", 2)
    base = quality.policy_mask("base", 1)
    app = quality.apply_policies(led, [("base", 1), ("web", 2)])
    assert app.filter("kept_base_v1").count() == sum(not m & base for m in masks)
    assert app.filter("kept_web_v2").count() == sum(not m & pm for m in masks)
    got = {r.rule: (r.n_failed, r.n_only_this) for r in quality.ablation(led, "web", 2).collect()}
    for rule in quality.RULES:
        assert got.get(rule.name, (0, 0)) == (sum(bool(m & rule.mask) for m in masks), sum(m & pm == rule.mask for m in masks))
    out = quality.filter_documents(df)
    assert out.columns == df.columns and out.count() == sum(not m & pm for m in masks)


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame(rows_of([(1, "a"), (2, "a")]), SCHEMA)
    for q in (exact_dedup.duplicate_groups(df), exact_dedup.drop_duplicates(df), quality.ledger(df), quality.filter_documents(df)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicate_groups(e).count() == 0 and exact_dedup.drop_duplicates(e).count() == 0
    assert quality.ledger(e).count() == 0 and quality.filter_documents(e).count() == 0


def test_filter_documents_keeps_the_ledger_plan(spark):
    """The policy's predicate must not inline the measuring steps."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    led, kept = size(quality.ledger(docs)), size(quality.filter_documents(docs))
    assert kept.count("xxhash64") == led.count("xxhash64") and len(kept) < 2 * len(led)


def test_rows_with_any_column_names_survive_every_stage(spark):
    from aspectra.llm import order_minhash, secret_scan
    odd = ["a.b", "__dd_n", "__dd_keep", "__dd_sha", "__dd_row", "__dd_id", "__s_changed", "changed", "c0", "node", "id", "row",
           "__nd_id", "__nd_node", "__q_row", "fail_mask", "kept", "size", "label"]
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words, *odd), (2, words, *odd), (3, words.upper() + " password = abcdefgh1", *odd)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in ["doc_id", "text", *odd]))
    for stage, ids in ((exact_dedup.drop_duplicates, {2, 3}), (order_minhash.drop_near_duplicates, {1}),
                       (secret_scan.redact, {1, 2, 3}), (quality.filter_documents, {1, 2, 3})):
        out = stage(df)
        assert out.columns == df.columns
        got = out.collect()
        assert {r["doc_id"] for r in got} == ids and all(tuple(r)[2:] == tuple(odd) for r in got)
