"""Cases behind answers that used to be wrong: folding, raw scores, ids, lists, readers."""
import random
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aspectra import schema as S
from aspectra.functions import text as TX
from aspectra.operators import annotate as A
from aspectra.operators import bio as B
from aspectra.operators import evaluate as EV
from aspectra.operators import polarity as P
from aspectra.operators import predict as PR
from aspectra.operators import sampling as SA
from aspectra.operators import stats as ST
from aspectra.operators import tagger as TG
from aspectra.sources import readers as RD

TRAIN = [(1, "good great fine tasty food", "positive"), (2, "bad awful poor food", "negative"),
         (3, "fine good service", "positive"), (4, "poor bad service", "negative")]


def train_frame(spark):
    return spark.createDataFrame(TRAIN, "review_id long, review_text string, polarity string")


def test_every_code_point_folds_like_unicode(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    step = 4000
    rows = [(i, "".join(chars[i:i + step])) for i in range(0, len(chars), step)]
    got = spark.createDataFrame(rows, "i int, t string").repartition(8, "i").select("i", TX.fold_accents(F.col("t")).alias("f"))
    for r in got.collect():
        want = unicodedata.normalize("NFKD", "".join(chars[r.i:r.i + step])).encode("ascii", "ignore").decode()
        # characters are folded one by one: no composition across neighbours
        single = "".join(unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in chars[r.i:r.i + step])
        assert r.f == single and sorted(want) == sorted(single)


def test_clean_keeps_compatibility_characters(spark):
    df = spark.createDataFrame([("Brand™ №5 size Ⅳ 10㎏",)], "t string")
    assert df.select(TX.clean_text(F.col("t"))).first()[0] == "BrandTM No5 size IV 10kg"


def test_list_literals(spark):
    cases = [(["chef's special", "a"], None), (["say \"x\"", "it's \"y\""], None), (["back\\slash", "new\nline"], None), ([], None),
             (["a, b", "']["], None), (None, "not a list"), (None, "['a'"), (None, "['a' 'b']"), (None, "[a]")]
    df = spark.createDataFrame([(i, lit or repr(items)) for i, (items, lit) in enumerate(cases)], "i int, t string")
    for r in df.select("i", TX.parse_list_literal(F.col("t")).alias("x")).collect():
        assert r.x == cases[r.i][0], cases[r.i]
    long = ["w" * 20_000, "it's"]
    assert spark.createDataFrame([(repr(long),)], "t string").select(TX.parse_list_literal(F.col("t"))).first()[0] == long


def test_one_class_training_is_an_error(spark):
    with pytest.raises(ValueError):
        P.nb_train(train_frame(spark).filter("polarity = 'positive'"))


def test_scores_are_raw_and_threshold_uses_them(spark):
    s = spark.createDataFrame([(0.8472978,), (0.8472978604,), (90.0,), (-90.0,)], "s double")
    label, prob, sentiment = P.probability_columns(F.col("s"), 0.7)
    got = s.select(label.alias("l"), prob.alias("p"), sentiment.alias("x")).collect()
    assert got[0].x == S.NEUTRAL and 0.6999999 < got[0].p < 0.7     # rounds to 0.7 but is below it
    assert got[1].x == S.POSITIVE and got[2].p == 1.0 and got[3].l == S.NEGATIVE


def test_rare_words_take_the_shuffled_way(spark, monkeypatch):
    m = P.nb_train(train_frame(spark))
    docs = spark.createDataFrame([(1, "good bad unknown"), (2, "tasty awful good"), (3, "zzz"), (4, " "), (5, None)],
                                 "review_id long, review_text string")
    want = sorted(map(tuple, P.polarity_score(docs, m).collect()))
    assert [w[0] for w in want] == [1, 2, 3]
    for size in (0, 60, 200):
        monkeypatch.setattr(P, "HEAD_BYTES", size)
        head, tail = P.frequent_words(m)
        assert tail is not None and head.count() + tail.count() == m.vocab.count()
        got = sorted(map(tuple, P.polarity_score(docs, m).collect()))
        assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_string_ids(spark):
    df = spark.createDataFrame([("app:7", "The food was good. The staff was bad"), ("x", None)], "review_id string, review_text string")
    out = PR.predict(df, P.nb_train(train_frame(spark)), flat=True).collect()
    assert [r.review_id for r in out] == ["app:7"]
    assert [tuple(r) for r in PR.reject_reviews(df).collect()] == [("x", "null_text")]


def test_predict_options(spark):
    m = P.nb_train(train_frame(spark))
    df = spark.createDataFrame([(1, "The food was good. The staff was bad"), (2, "  ")], "review_id long, review_text string")
    base = PR.predict(df, m)
    _, _, tokens = A.annotate_corpus(df.filter("review_id = 1"))
    cols = ["sent_id", "rule_no", "aspect", "sentiment", "sentiment_prob"]
    own = sorted(map(str, PR.predict(df, m, tokens=tokens).select(*cols).collect()))
    assert own == sorted(map(str, base.select(*cols).collect()))
    lr = PR.lr_scorer(P.lr_train(train_frame(spark), num_features=1 << 10, max_iter=5))
    scored = PR.predict(df, m, scorer=lr).collect()
    assert len(scored) == base.count() and all(0.5 <= r.sentiment_prob <= 1 for r in scored)
    rule = lambda w: w.withColumn("tag_pred", F.when(F.col("word").isin("food", "staff"), "B").otherwise("O"))
    flat = PR.predict(df, m, flat=True, aux=rule, include_text=True).collect()
    assert len(flat) == 1 and flat[0].aspects_aux == ["food", "staff"] and len(flat[0].polarity_prob_aux) == 2
    assert flat[0].review == "The food was good. The staff was bad"
    long = PR.predict(df, m, aux=rule)
    assert {"aspects_aux", "polarity_aux", "polarity_prob_aux"} <= set(long.columns) and long.count() == base.count()
    none = PR.predict(df, m, flat=True, aux=lambda w: w.withColumn("tag_pred", F.lit("O"))).first()
    assert none.aspects_aux == [S.NO_ASPECT]


def tagged_words(spark):
    rows, r = [], random.Random(1)
    for k in range(60):
        noun = r.choice(["food", "staff", "room"])
        for i, (w, g) in enumerate([("the", "O"), (noun, "B"), ("was", "O"), (r.choice(["good", "bad"]), "O")]):
            rows.append((k, i, w, g))
    return spark.createDataFrame(rows, "review_id long, i int, word string, gold string")


def test_trained_tagger_and_aux_path(spark):
    f = TG.token_features(tagged_words(spark), ["review_id"])
    model = TG.tagger_train(f.filter("review_id < 45"), num_features=1 << 10)
    held = TG.tagger_predict(model, f.filter("review_id >= 45")).collect()
    assert len(held) == 60 and sum(r.tag_pred == r.gold for r in held) / 60 > 0.95
    df = spark.createDataFrame([(1, "the room was good")], "review_id long, review_text string")
    out = TG.predict_aux(df, model, P.nb_train(train_frame(spark))).first()
    assert out.aspects_aux == ["room"] and out.polarity_aux[0] in (S.POSITIVE, S.NEUTRAL)


def test_aspect_without_a_token_is_corrupted(spark):
    df = spark.createDataFrame([("food was ok", ["-"]), ("food was ok", ["…"]), ("food was ok", ["food", "日本"])],
                               "review_text string, aspect array<string>")
    assert [r.status for r in B.bio_tags(df).collect()] == [S.STATUS_CORRUPTED] * 3


def test_tags_that_share_a_prefix(spark):
    df = spark.createDataFrame([("<reviewer_location>\nX\n</reviewer_location>\n<reviewer>\nBob\n</reviewer>",),
                                ("<reviewer_location>\nX\n</reviewer_location>",), ("<reviewer id='1'>A</reviewer>",)], "value string")
    got = [r.reviewer for r in RD.extract_tags(df, ["reviewer"]).collect()]
    assert got == ["Bob", None, "A"]


def test_legacy_csv_with_quotes(spark, tmp_path):
    import pandas as pd
    text = 'He said "ok; fine" and left\nnow'
    pd.DataFrame({"review_text": [text, "b"], "aspect": ["[\"chef's\", 'x']", "[]"]}).to_csv(tmp_path / "g.csv", sep=";", index=False)
    got = RD.read_gold_csv(spark, str(tmp_path / "g.csv")).collect()
    assert (got[0].review_text, got[0].aspect, got[1].aspect) == (text, ["chef's", "x"], [])


def test_review_ids_are_unique(spark):
    d = RD.build_reviews(spark, "/root/testdata/sf0.001")
    assert d.count() == d.select("review_id").distinct().count()


def test_labels_encode_and_decode(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "y string")
    index = EV.label_index(df, "y")
    coded = EV.encode_labels(df, index, "y")
    assert {(r.y, r.label_id) for r in coded.collect()} == {("a", 0), ("b", 1), (None, None)}
    assert {r.label for r in EV.decode_labels(coded, index).collect()} == {"a", "b", None}
    with pytest.raises(PySparkException):
        EV.encode_labels(spark.createDataFrame([("c",)], "y string"), index, "y").collect()
    with pytest.raises(PySparkException):
        EV.decode_labels(spark.createDataFrame([(9,)], "label_id long"), index).collect()


def test_running_totals_and_auc(spark):
    r = random.Random(4)
    rows = [(round(r.random(), 2), r.random() < 0.4) for _ in range(500)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = EV.roc_auc(df, "s", "y").first()
    assert got.auc == pytest.approx(want) and (got.n_pos, got.n_neg) == (len(pos), len(neg))
    curve = EV.roc_points(df, "s", "y").orderBy(F.desc("threshold")).collect()
    assert curve[-1].tpr == curve[-1].fpr == 1.0 and [c.tp for c in curve] == sorted(c.tp for c in curve)
    seen = ST.running_totals(df.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "s", ["n"]).orderBy("s").collect()
    total = 0
    for x in seen:
        total += x.n
        assert x.n_total == total
    assert EV.roc_auc(df.filter("s > 2"), "s", "y").first().auc is None


def test_no_exchange_carries_the_text(spark):
    df = spark.createDataFrame([(i, "word " * 5, "positive" if i % 3 else "negative") for i in range(60)],
                               "review_id long, review_text string, polarity string")
    for out in (P.balance_binary(df), SA.stratified_split(df, "review_id", "polarity")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.split("\n") if "Exchange" in x and "review_text" in x]
    assert P.balance_binary(df).groupBy("polarity").count().collect()[0]["count"] == 20
    split = {r.split: r["count"] for r in SA.stratified_split(df, "review_id", "polarity").groupBy("split").count().collect()}
    assert split == {"valid": 12, "train": 48}
