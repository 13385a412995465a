"""Plain-Python models of T18 (BIO fold), W1 (window bounds) and W4 (BIO decode),
compared with the Spark expressions on seeded random inputs (one job per operator)."""
import random

from pyspark.sql import functions as F

from aspectra.operators import bio as B
from aspectra.operators import spans as SP

VOCAB = ["a", "b", "c", "d", "N", "NULL", "x"]


def py_bio(words, aspects, compat=False):
    if not aspects:
        return ["O"] * len(words), "ok"
    toks = [a.split(" ") for a in aspects]
    nulls = [(t[0] in "NULL") if compat else (t[0] == "NULL") for t in toks]
    if any(nulls):
        return (["O"] * len(words), "ok") if len(toks) == 1 else (None, "implicit_aspect")
    labels = ["O"] * len(words)
    for t in toks:
        if len(t) == 1:
            if t[0] not in words:
                return None, "corrupted"
            labels[words.index(t[0])] = "B"
            continue
        idxs = []
        for w in t:
            if w not in words:
                return None, "corrupted"
            idxs.append(words.index(w))
        if idxs != list(range(min(idxs), max(idxs) + 1)):
            return None, "aspect_multi_occurrence"
        for k in idxs:
            labels[k] = "I" if labels[k - 1 if k >= 1 else 0] in ("B", "I") else "B"
    return labels, "ok"


def py_window(s, pos, n_tok, n):
    cnt, p = len(s), s.index(pos)
    if cnt == 1:
        return 0, n_tok
    right = n_tok if p == cnt - 1 else (min(pos + n, n_tok) if min(pos + n, n_tok) < s[p + 1] else s[p + 1] - 1)
    left = 0 if p == 0 else (max(pos - n, 0) if max(pos - n, 0) > s[p - 1] else s[p - 1] + 1)
    if right < 0:
        right += n_tok
    return left, min(n_tok, max(left, right))


def py_decode(tags, words):
    out, first, last = [], [], None
    for i, (t, w) in enumerate(zip(tags, words)):
        if t == "O":
            continue
        if t == "I" and last is not None and i - last == 1:
            out[-1] += " " + w
        else:
            out.append(w)
            first.append(i)
        last = i
    return (out, first) if out else (["None"], [0])


def test_bio_fold_matches_python(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(400):
        words = [rnd.choice(VOCAB) for _ in range(rnd.randint(1, 8))]
        aspects = [" ".join(rnd.choice(VOCAB[:5] + words) for _ in range(rnd.randint(1, 3)))
                   for _ in range(rnd.randint(0, 3))]
        rows.append((k, " ".join(words), aspects))
    df = spark.createDataFrame(rows, "k long, review_text string, aspect array<string>")
    for compat in (False, True):
        got = {r.k: (r.tags, r.status) for r in B.bio_tags(df, compat_null=compat).collect()}
        for k, text, aspects in rows:
            exp_tags, exp_status = py_bio(text.split(" "), aspects, compat)
            assert got[k][1] == exp_status, (text, aspects, compat)
            assert (list(got[k][0]) if got[k][0] is not None else None) == exp_tags, (text, aspects, compat)


def test_window_bounds_match_python(spark):
    rnd = random.Random(11)
    rows = []
    for k in range(400):
        n_tok = rnd.randint(1, 30)
        s = sorted(rnd.choice(range(n_tok)) for _ in range(rnd.randint(1, 5)))
        rows.append((k, s, rnd.choice(s), n_tok, rnd.randint(1, 8)))
    df = spark.createDataFrame(rows, "k long, s array<int>, p int, nt int, n int")
    out = {}
    for n in sorted({r[4] for r in rows}):
        sub = df.filter(F.col("n") == n)
        left, right = SP.window_bounds(F.col("p"), F.col("s"), F.col("nt"), n)
        out.update({r.k: (r.l, r.r) for r in sub.select("k", left.alias("l"), right.alias("r")).collect()})
    for k, s, p, nt, n in rows:
        assert out[k] == py_window(s, p, nt, n), (s, p, nt, n)


def test_decode_matches_python(spark):
    rnd = random.Random(5)
    cases, rows = {}, []
    for k in range(300):
        tags = [rnd.choice("OOBI") for _ in range(rnd.randint(1, 10))]
        words = [f"w{i}" for i in range(len(tags))]
        cases[k] = (tags, words)
        rows += [(k, i, w, t) for i, (t, w) in enumerate(zip(tags, words))]
    df = spark.createDataFrame(rows, "review_id long, i int, text string, tag_pred string")
    keys = spark.createDataFrame([(k,) for k in cases], "review_id long")
    got = {r.review_id: (list(r.aspects), list(r.first_ids))
           for r in SP.bio_decode_lists(SP.bio_decode(df), keys).collect()}
    for k, (tags, words) in cases.items():
        assert got[k] == py_decode(tags, words), (tags,)


def test_relational_window_bounds_match_python(spark):
    rnd = random.Random(23)
    rows, sentences = [], {}
    for sid in range(150):
        n_tok = rnd.randint(1, 25)
        positions = [rnd.randrange(n_tok) for _ in range(rnd.randint(1, 6))]
        sentences[sid] = (n_tok, positions)
        rows += [(1, sid, p, n_tok) for p in positions]
    df = spark.createDataFrame(rows, "review_id long, sent_id int, aspect_i int, n_tokens int")
    for keep in (False, True):
        got = SP.add_window_bounds(df, 6, keep_duplicates=keep).collect()
        for r in got:
            n_tok, positions = sentences[r.sent_id]
            s = sorted(positions) if keep else sorted(set(positions))
            assert (r.win_left, r.win_right) == py_window(s, r.aspect_i, n_tok, 6), (positions, r.aspect_i, keep)


def test_distributed_rank_matches_row_number_with_a_hot_group(spark):
    from pyspark.sql import Window

    from aspectra.operators.stats import histogram_quantiles, rank_within_groups
    rnd = random.Random(3)
    rows = [(i, "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"]), rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    exp = {r.id: r.rn for r in df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id"))).collect()}
    for parts in (1, 7, 16):
        got = {r.id: r.rn for r in rank_within_groups(df, ["g"], ["v", "id"], num_partitions=parts).collect()}
        assert got == exp, parts
    # exact quantiles from the histogram equal numpy's linear interpolation
    import numpy as np
    q = {r.g: (r.q25, r.q75) for r in histogram_quantiles(df, "v", [0.25, 0.75], ["g"], ["q25", "q75"]).collect()}
    for g in q:
        vals = [v for _, gg, v in rows if gg == g]
        assert q[g] == (float(np.quantile(vals, 0.25)), float(np.quantile(vals, 0.75)))
