"""FIXTURES C3, C6: BIO tags, metrics."""
from pyspark.sql import functions as F

from aspectra.operators import bio as B
from aspectra.operators import evaluate as EV


def test_bio_tags(spark):
    rows = [("the wine list and staff are great", ["wine list", "staff"], "O B I O B O O", "ok"),
            ("food wine list ok", ["food", "wine list"], "B I I O", "ok"),
            ("food was ok", [], "O O O", "ok"), ("food was ok", ["NULL"], "O O O", "ok"),
            ("food was ok", ["food", "NULL"], None, "implicit_aspect"),
            ("food was ok", ["pizza"], None, "corrupted"), ("food was ok", ["Food"], None, "corrupted"),
            ("list of wine list", ["wine list"], None, "aspect_multi_occurrence"),
            ("food was ok", ["N"], None, "corrupted")]
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "review_text string, aspect array<string>")
    out = B.bio_tags(df).collect()
    for r, (_, _, tags, status) in zip(out, rows):
        assert r.status == status
        assert (" ".join(r.tags) if r.tags else None) == tags
    compat = B.bio_tags(df, compat_null=True).collect()[-1]
    assert compat.status == "ok" and compat.tags == ["O", "O", "O"]


def test_classification_report(spark):
    df = spark.createDataFrame(list(zip("neg neg pos pos neu".split(), "neg pos pos pos neg".split())),
                               "y_true string, y_pred string")
    rep = {r.label: r for r in EV.classification_report(df).collect()}
    assert rep["accuracy"].f1 == 0.6
    assert (rep["neg"].precision, rep["neg"].recall, rep["neg"].f1, rep["neg"].support) == (0.5, 0.5, 0.5, 2)
    assert (rep["pos"].precision, rep["pos"].recall, rep["pos"].f1) == (0.666667, 1.0, 0.8)
    assert rep["neu"].f1 == 0.0
    assert rep["macro avg"].f1 == 0.433333 and rep["weighted avg"].f1 == 0.52
    assert EV.micro_f1(df).collect()[0].micro_f1 == 0.6


def test_sequence_report(spark):
    gold, pred = "O B I O B".split(), "O B I O O".split()
    df = spark.createDataFrame([(0, i, g, p) for i, (g, p) in enumerate(zip(gold, pred))],
                               "review_id long, i int, gold string, pred string")
    r = EV.seq_report(df, ["review_id"]).collect()[0]
    assert (r.precision, r.recall, r.f1, r.accuracy) == (1.0, 0.5, 0.666667, 0.8)
    o = {x.outcome: x.n for x in EV.token_outcomes(
        spark.createDataFrame([(0, 0, "O", "B")], "review_id long, i int, gold string, pred string"))
        .groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert o == {"FP": 1}


def test_auc_and_aspect_hit(spark):
    df = spark.createDataFrame([(0.9, True), (0.4, True), (0.5, False), (0.1, False)], "s double, pos boolean")
    assert EV.roc_auc(df, "s", "pos").collect()[0].auc == 0.75
    base = spark.createDataFrame(
        [(i, "a b c", ["wine list"], ["positive"], p) for i, p in enumerate([["wine"], ["Wine"], []])],
        "review_id long, review_text string, aspect array<string>, polarity array<string>, aspects array<string>")
    hits = [r.hit for r in EV.eval_aspect(base).orderBy("review_id").collect()]
    assert hits == [True, False, False]
