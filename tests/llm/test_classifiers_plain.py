"""The two classifiers against plain Python: one n-gram, one document at a time."""
import math
import random
import zlib
from collections import Counter

import pytest

from aspectra.llm import langid, toxicity

ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]
LONG = 60_000


def plain_buckets(text, sizes, bits):
    t = " " + " ".join((text or "").lower().split()) + " "
    out = []
    for n in sizes:
        for i in range(len(t) - n + 1):
            h = ord(t[i]) * ODD[0] % 2**64
            for k in range(1, n):
                h = ((h ^ h >> 29) + ord(t[i + k]) * ODD[k]) % 2**64
            out.append(((h ^ h >> 32) * ODD[1] + n) % 2**64 >> (64 - bits))
    return out


def talk(r, words, n):
    return " ".join(r.choice(words) + r.choice(words) for _ in range(n))


def learnt(i):
    return zlib.crc32(str(i).encode()) % 3 != 1


def test_language_equals_plain_naive_bayes(spark):
    r = random.Random(21)
    words = {"aa": ["thon", "ering", "was"], "bb": ["çeau", "queli", "thon"], "cc": ["ość", "prze", "was"]}
    rows = [(i, talk(r, words[l], r.randrange(1, 20)), l) for i in range(90) for l in [r.choice(sorted(words))]]
    rows += [(200, "日本 x", None), (201, talk(r, words["bb"], LONG // 10), None), (202, rows[0][1], None)]
    docs = spark.createDataFrame([(i, t, l, "s", "k", 1) for i, t, l in rows],
                                 "doc_id long, text string, lang string, lang_pred string, l string, `a.b` int")
    got = {x.doc_id: x for x in langid.predict(docs, langid.train(langid.training_rows(docs))).collect()}
    counts, sizes = {l: Counter() for l in words}, Counter()
    for i, t, l in rows:
        if l and learnt(i):
            counts[l].update(plain_buckets(t, langid.SIZES, langid.BITS))
            sizes[l] += 1
    total = {l: sum(c.values()) + langid.SMOOTHING * 2**langid.BITS for l, c in counts.items()}
    for i, t, _ in rows:
        x = plain_buckets(t, langid.SIZES, langid.BITS)
        ll = {l: math.log(sizes[l] / sum(sizes.values()))
              + sum(math.log((counts[l][b] + langid.SMOOTHING) / total[l]) for b in x) for l in sorted(words)}
        best = max(ll, key=ll.get)
        score = 1 / sum(math.exp((v - ll[best]) / math.sqrt(len(x))) for v in ll.values())
        assert got[i].lang_pred == best and got[i].score == pytest.approx(score, abs=1e-4), i


def test_equal_languages_tie_to_the_first(spark):
    docs = spark.createDataFrame([(i, "same words here", l) for i, l in enumerate(["zz", "mm", "zz", "mm"])],
                                 "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.train(docs)).collect()
    assert {(x.lang_pred, round(x.score, 6)) for x in got} == {("mm", 0.5)}


def test_toxicity_equals_plain_ratios_and_scores(spark):
    r = random.Random(22)
    words = ["thon", "ering", "was", "les", "queli"]
    rows = []
    for i in range(150):
        bad = i % 5 == 0
        t = talk(r, words, r.randrange(2, 12))
        rows.append((i, t + " stupid" * bad + (" moron" if bad and i % 2 else ""), int(bad)))
    extra = [(500, None, 0), (501, "", 0), (502, talk(r, words, LONG // 10) + " stupid", 1)]
    docs = spark.createDataFrame([(i, t, "s", 0.5, 9) for i, t, _ in rows + extra],
                                 "doc_id long, text string, t string, score double, `a.b` int")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, text string")
    model = toxicity.train(toxicity.training_rows(docs, labels))

    seen = [Counter(), Counter()]
    train = [(set(plain_buckets(t, toxicity.SIZES, toxicity.BITS)), y) for i, t, y in rows if learnt(i)]
    for x, y in train:
        seen[y].update(x)
    n = [sum(y == k for _, y in train) for k in (0, 1)]
    share = [k / sum(n) for k in n]

    def ratio(b):
        rate = [(seen[k][b] + 4 * share[k]) / (n[k] + 4 * share[k]) for k in (0, 1)]
        return math.log(rate[1] / rate[0])

    weight = dict(zip(model.bucket.tolist(), model.weight.tolist()))
    assert weight and set(weight) <= set(seen[0]) | set(seen[1])
    # the weights are a minimum of the penalised loss over the scaled features
    w = {b: v / ratio(b) for b, v in weight.items()}

    def slope(w, bias):
        g = {b: toxicity.L2 * v for b, v in w.items()}
        for x, y in train:
            use = [b for b in x if b in w]
            e = 1 / (1 + math.exp(-bias - sum(w[b] * ratio(b) for b in use))) - y
            for b in use:
                g[b] += e * ratio(b)
        return math.sqrt(sum(v * v for v in g.values()))

    assert slope(w, model.bias) < 0.02 * slope(dict.fromkeys(w, 0.0), model.bias)
    got = {x.doc_id: x.score for x in toxicity.score(docs, model).collect()}
    for i, t, _ in rows + extra:
        z = model.bias + sum(weight.get(b, 0.0) for b in set(plain_buckets(t, toxicity.SIZES, toxicity.BITS)))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9), i
    assert got[502] > 0.5
