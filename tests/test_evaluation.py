"""Evaluation runs, grouping sets, cross-fitting, metric store, rejects, dataset registry."""
import statistics

import pytest
from pyspark.sql import functions as F

from aspectra.operators import evaluate as EV
from aspectra.operators import evaluation as EN
from aspectra.operators import models as MD
from aspectra.sources import readers as RD


def test_gold_without_prediction_stays_and_is_wrong(spark):
    gold = spark.createDataFrame([
        (1, "the food was really good", ["food"], ["positive"]), (2, "the room was really bad", ["room"], ["negative"]),
        (3, "one two three four five", ["one"], ["none"])],
        "review_id long, review_text string, aspect array<string>, polarity array<string>")
    pred = spark.createDataFrame([(1, ["food", None], ["positive", "neutral"]), (9, ["x"], ["positive"])],
                                 "review_id long, aspects array<string>, polarity array<string>")
    a = EN.align(gold, pred)
    assert {r.review_id: (r.has_prediction, r.aspects, r.pred_polarity) for r in a.collect()} == {
        1: (True, ["food", None], ["positive", "neutral"]), 2: (False, [], []), 3: (False, [], [])}
    ok = {r.review_id: r.ok for r in EV.eval_polarity(a).collect()}
    assert ok[1] is True and ok[2] is False
    hits = {r.review_id: r.hit for r in EV.eval_aspect(a).collect()}
    assert hits == {1: True, 2: False, 3: False}
    assert EN.coverage(gold, pred).first().asDict() == {
        "gold": 3, "predicted": 2, "matched": 1, "gold_without_prediction": 2, "prediction_without_gold": 1}
    assert EN.coverage(gold.limit(0), pred).first().gold == 0
    report = {r.label: r for r in EN.polarity_report(a).collect()}
    assert report["negative"].recall == 0 and report["positive"].recall == 1


def test_describe_sets_against_python(spark):
    import random
    r = random.Random(3)
    rows = [(r.random() < 0.5, r.choice([True, False, None]), r.randrange(1, 30)) for _ in range(400)] + [(True, True, None)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, size int")
    got = {(x.grouping, x.a, x.b): x for x in EN.describe_sets(df, {"one": ["a"], "two": ["a", "b"], "all": []}, "size").collect()}
    want = {}
    for a, b, v in rows:
        if v is not None:
            for key in (("one", a, None), ("two", a, b), ("all", None, None)):
                want.setdefault(key, []).append(v)
    assert got.keys() == want.keys()
    for key, values in want.items():
        x = got[key]
        q = statistics.quantiles(values, n=4, method="inclusive")
        assert (x["count"], x.min, x.max) == (len(values), min(values), max(values))
        assert x["mean"] == pytest.approx(statistics.mean(values), abs=1e-6)
        assert x["std"] == pytest.approx(statistics.stdev(values), abs=1e-5)
        assert [x.q25, x.q50, x.q75] == pytest.approx(q)


def test_single_value_has_no_spread(spark):
    df = spark.createDataFrame([(True, 7)], "a boolean, size int")
    x = EN.describe_sets(df, {"one": ["a"]}, "size").first()
    assert (x["count"], x["std"], x.q25, x.q75) == (1, None, 7.0, 7.0)


def test_cross_fit_never_sees_its_own_sentences(spark):
    words = spark.createDataFrame([(s, i, f"w{s}", "O") for s in range(10) for i in range(3)],
                                  "review_id long, i int, word string, gold string")
    seen = []

    def train(features):
        ids = {r.review_id for r in features.select("review_id").distinct().collect()}
        seen.append(ids)
        return ids

    def predict(ids, features):
        return features.withColumn("tag_pred", F.when(F.col("review_id").isin(*ids), "I").otherwise("B"))

    out = EN.cross_fit(words, ["review_id"], F.col("review_id") % 4, 4, train, predict)
    rows = out.collect()
    assert len(rows) == 30 and all(r.tag_pred == "B" and r.fold == r.review_id % 4 for r in rows)
    assert [len(s) for s in seen] == [7, 7, 8, 8]
    e = EN.error_analysis(out, words.groupBy("review_id").agg(F.array(F.lit("a b")).alias("aspect"), F.collect_list("word").alias("text_tokens")))
    assert {r.outcome: r.n for r in e.outcomes.collect()} == {"FP": 30}
    assert {(r.grouping, r["count"]) for r in e.stats.collect()} == {("correct", 10), ("empty", 10), ("composed", 10)}


def test_metric_store_appends_and_reloads(spark, tmp_path):
    path = f"{tmp_path}/bundle"
    assert MD.read_metrics(spark, path).count() == 0
    report = EV.classification_report(spark.createDataFrame([("a", "a"), ("b", "a")], "y_true string, y_pred string"))
    MD.append_metrics(path, "r1", "valid", MD.metrics_long(report))
    first = {tuple(r) for r in MD.read_metrics(spark, path).collect()}
    seq = EV.seq_report(spark.createDataFrame([(1, 0, "B", "B"), (1, 1, "O", "B")], "k long, i int, gold string, pred string"), ["k"])
    MD.append_metrics(path, "r2", "valid", MD.sequence_metrics_long(seq))
    both = {tuple(r) for r in MD.read_metrics(spark, path).collect()}
    assert first < both and ("r1", "valid", "recall", "a", 1.0) in first and ("r2", "valid", "precision", "all", 0.5) in both
    assert len(both) == len(first) + 4


def test_lr_and_tagger_metrics_on_validation_rows(spark, tmp_path):
    """The metric store filled from fitted models, reloaded with their pipeline."""
    from aspectra.operators import polarity as P
    train = spark.createDataFrame([(i, ("good fine " if i % 2 else "bad poor ") * 3, "positive" if i % 2 else "negative")
                                   for i in range(20)], "review_id long, review_text string, polarity string")
    valid = train.filter("review_id < 6")
    model = P.lr_train(train.filter("review_id >= 6"))
    path = f"{tmp_path}/lr"
    MD.save_pipeline(model, path)
    scored = P.lr_score(MD.load_pipeline(spark, path), valid).join(valid.select("review_id", F.col("polarity").alias("y_true")), "review_id")
    MD.append_metrics(path, "lr", "valid", MD.metrics_long(EV.classification_report(scored, y_pred="label")))
    assert MD.read_metrics(spark, path).filter("metric = 'f1' AND label = 'accuracy'").first().value == 1.0


def test_csv_rejects_keep_their_rows(spark, tmp_path):
    path = f"{tmp_path}/g.csv"
    with open(path, "w") as f:
        f.write('review_text;aspect\n"good ""food"";\nindeed";"[\'food\']"\n" ";"[]"\n"x y";"[\'a"\n"x";"[]";"more"\nplain;[]\n')
    good, bad = RD.read_gold_csv_checked(spark, path)
    assert {(r.review_text, tuple(r.aspect)) for r in good.collect()} == {('good "food";\nindeed', ("food",)), ("plain", ())}
    assert sorted(r.reason for r in bad.collect()) == ["bad_list", "malformed_row", "no_text"]
    assert all("review_text" in r.record or "_broken" in r.record for r in bad.collect())


def test_registry_reads_every_gold_dataset(spark):
    from aspectra.sources import derived as DV
    root = DV.write_gold_sources(spark, "/root/testdata/sf0.001")
    g = RD.read_gold_sources(spark, root)
    assert {r.source for r in g.select("source").distinct().collect()} == {RD.GOLD_2014, RD.GOLD_2015, RD.GOLD_2016, RD.GOLD_MAMS}
    assert g.filter((F.col("source") == RD.GOLD_2014) & F.col("position").isNotNull()).count() == 0
    assert g.filter((F.col("source") == RD.GOLD_MAMS) & F.col("position").isNull()).count() == 0
    assert RD.READERS.keys() == RD.REGISTRY.keys()
    with pytest.raises(KeyError):
        RD.source_path(root, "nope")


def test_reviews_dataset_contract(spark, tmp_path):
    one = spark.createDataFrame([("a:1", "a", "good", "positive"), ("a:2", "a", None, "negative"), (None, "a", "x", None)],
                                "review_id string, source string, review_text string, polarity string")
    two = spark.createDataFrame([("b:1", "b", "text", 2.0), ("c:1", None, "text", 1.0)],
                                "review_id string, source string, review_text string, rating double")
    manifest = RD.write_reviews_dataset([one, two], f"{tmp_path}/d")
    assert {tuple(r) for r in manifest.collect()} == {("a", 1, 2), ("b", 1, 0), ("unknown", 0, 1)}
    assert {r.review_id for r in RD.read_reviews_of(spark, f"{tmp_path}/d").collect()} == {"a:1", "b:1"}
    b = RD.read_reviews_of(spark, f"{tmp_path}/d", ["b"])
    assert [(r.review_id, r.polarity, r.rating) for r in b.collect()] == [("b:1", None, 2.0)]
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reason" in plan and "source" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    with pytest.raises(KeyError):
        RD.read_reviews_of(spark, f"{tmp_path}/d", ["z"])
