"""FIXTURES C2, C4, C5: windows, decoding, cleaning, tokens, labels, filters."""
from pyspark.sql import functions as F

from aspectra.functions import text as TX
from aspectra.operators import annotate as A
from aspectra.operators import polarity as P
from aspectra.operators import spans as SP


def _bounds(spark, positions, pos, n_tok, n=6):
    df = spark.createDataFrame([(sorted(positions), pos, n_tok)], "s array<int>, p int, nt int")
    left, right = SP.window_bounds(F.col("p"), F.col("s"), F.col("nt"), n)
    r = df.select(left.alias("l"), right.alias("r")).collect()[0]
    return r.l, r.r


def test_windows(spark):
    assert _bounds(spark, [1, 6], 1, 10) == (0, 5)
    assert _bounds(spark, [1, 6], 6, 10) == (2, 10)
    assert _bounds(spark, [1, 1, 6], 1, 10) == (0, 0)   # compat: duplicate position
    assert _bounds(spark, [1, 6], 1, 10) == (0, 5)      # default: distinct positions
    assert _bounds(spark, [1, 1], 1, 10) == (0, 0)
    assert _bounds(spark, [1], 1, 10) == (0, 10)


def test_bio_decode(spark):
    cases = [("I like the wine list and staff", "O O O B I O B", "wine list|staff", "3|6"),
             ("food was ok", "O O O", "None", "0"),
             ("food staff ok", "B B O", "food|staff", "0|1"),
             ("food was ok", "B O I", "food|ok", "0|2"),
             ("the food ok", "O I O", "food", "1")]
    rows = []
    for k, (words, tags, _, _) in enumerate(cases):
        for i, (w, t) in enumerate(zip(words.split(), tags.split())):
            rows.append((k, i, w, t))
    df = spark.createDataFrame(rows, "review_id long, i int, text string, tag_pred string")
    d = SP.bio_decode(df)
    keys = spark.createDataFrame([(k,) for k in range(len(cases))], "review_id long")
    out = {r.review_id: r for r in SP.bio_decode_lists(d, keys).collect()}
    for k, (_, _, asp, ids) in enumerate(cases):
        assert "|".join(out[k].aspects) == asp
        assert "|".join(str(x) for x in out[k].first_ids) == ids


def test_clean_and_tokens(spark):
    df = spark.createDataFrame([("Café  food (small) #1 – 50% off!",), ("The food wasn't bad",)], "t string")
    r = df.select(TX.clean_text(F.col("t")).alias("c")).collect()
    assert r[0].c == "Cafe food (small) 1 50 off!"
    s = A.split_sentences(spark.createDataFrame([(1, "The food wasn't bad")], "review_id long, review_text string"))
    toks = A.tokenize(s).orderBy("i").collect()
    assert [(t.text, t.idx) for t in toks] == [("The", 0), ("food", 4), ("was", 9), ("n't", 12), ("bad", 16)]


def test_exact_unicode_path_agrees_on_latin(spark):
    df = spark.createDataFrame([("éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ ﬁne ½",)], "t string")
    a = df.select(TX.clean_text(F.col("t")).alias("a"), TX.clean_text(F.col("t"), True).alias("b")).collect()[0]
    assert a.a == a.b


def test_rating_and_threshold(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (3.0,), (5.0,), (float("nan"),), (None,)], "v double")
    got = [r.p for r in df.select(P.rating_to_polarity(F.col("v")).alias("p")).collect()]
    assert got == ["negative", "negative", "neutral", "positive", "positive", None, None]
    t = spark.createDataFrame([("positive", 0.70), ("negative", 0.6999)], "l string, p double")
    assert [r.s for r in t.select(P.neutral_threshold(F.col("l"), F.col("p")).alias("s")).collect()] == \
        ["positive", "neutral"]


def test_length_filter_and_balance(spark):
    rows = [(i, " ".join(["w"] * i), "positive") for i in range(1, 11)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, polarity string")
    kept = sorted(r.review_id for r in P.length_iqr_filter(df).collect())
    assert kept == [4, 5, 6, 7]
    b = spark.createDataFrame([(1, "positive"), (2, "negative"), (3, "positive"), (4, "negative"), (5, "positive")],
                              "review_id long, polarity string")
    assert sorted(r.review_id for r in P.balance_binary(b).collect()) == [1, 2, 3, 4]
