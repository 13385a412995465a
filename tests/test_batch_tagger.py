"""Tags, spans and windows over Arrow batches give the rows of the relational operators."""
import random

import numpy as np
import pytest
from pyspark.ml.feature import FeatureHasher
from pyspark.sql import functions as F

from aspectra import schema as S
from aspectra.operators import annotate as A
from aspectra.operators import batches as B
from aspectra.operators import polarity as P
from aspectra.operators import spans as SP
from aspectra.operators import tagger as TG

REVIEWS = [(1, "The food was good. The nice staff and room was bad, really"), (2, "food. food staff. room"), (9, "the staff desk good. the food was bad"), (3, "nothing here"),
           (4, None), (5, " . "), (6, "é…"), (7, "…. food"), (8, "The Food wasn't 9 good food food staff; bad room " * 5)]
COLS = "review_id long, review_text string"


@pytest.fixture(scope="module")
def model(spark):
    rows, r = [], random.Random(3)
    for k in range(60):
        words = [("the", "O"), (r.choice(["food", "staff", "room"]), "B"), ("desk", "I") if k % 2 else ("was", "O"),
                 (r.choice(["good", "bad", "Good"]), "O")]
        rows += [(k, i, w, g) for i, (w, g) in enumerate(words)]
    f = TG.token_features(spark.createDataFrame(rows, "review_id long, i int, word string, gold string"), ["review_id"])
    return TG.tagger_train(f, num_features=1 << 10)


@pytest.fixture(scope="module")
def nb(spark):
    vocab = [("good", 9, 1, 2.1), ("bad", 1, 9, -2.3), ("the", 5, 5, 0.7), ("was", 1, 0, 0.1), ("and", 3, 4, -0.3)]
    return P.NaiveBayesModel(spark.createDataFrame(vocab, "word string, n_pos long, n_neg long, lo double"), 0.125)


def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        (F.col("doc_id") + 100).alias("review_id"), F.col("text").alias("review_text")).limit(40)
    return docs.unionByName(spark.createDataFrame(REVIEWS, COLS))


def same(new, old):
    assert new.dtypes == old.dtypes
    assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def rounded(aux):
    return aux.withColumn("polarity_prob_aux", F.transform("polarity_prob_aux", lambda x: F.round(x, 9)))


def test_hashes_are_those_of_the_feature_hasher(spark):
    words = ["", "a", "ab", "abc", "abcd", "wörld", "x" * 37, "ŝ"]
    df = spark.createDataFrame([(w,) for w in words], "lower string")
    got = FeatureHasher(inputCols=["lower"], outputCol="f", numFeatures=1 << 18).transform(df).collect()
    assert [int(r.f.indices[0]) for r in got] == (TG.murmur3([f"lower={w}".encode() for w in words]) % (1 << 18)).tolist()


def test_spans_by_sentence(spark, model):
    df = texts(spark)
    words = A.annotate(A.split_sentences(df)).select(*A.SENT_KEYS, "i", F.col("text").alias("word"))
    old = SP.bio_decode(TG.tagger_predict(model, TG.token_features(words, A.SENT_KEYS)), A.SENT_KEYS, "tag_pred", "word", "i")
    assert old.filter("aspect like '% %'").count() > 0
    same(TG.review_spans(df, model), old)
    plan = TG.tag_spans(df, TG.LinearTagger.of(model))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "FeatureHasher" not in plan


def test_spans_of_a_group():
    tagged, inner = np.array([1, 1, 0, 1, 1, 1], dtype=bool), np.array([1, 1, 0, 1, 0, 1], dtype=bool)
    assert [x.tolist() for x in TG._spans(tagged, inner, np.array([0, 0, 0, 0, 0, 1]))] == [[0, 3, 4, 5], [2, 1, 1, 1]]


@pytest.mark.parametrize("head_bytes", [P.HEAD_BYTES, 60])
def test_aux_of_a_pipeline(spark, model, nb, monkeypatch, head_bytes):
    df = texts(spark)
    old = TG._aux_of_tokens(df, model, nb, S.WINDOW_AUX, S.NEUTRAL_THRESHOLD)
    monkeypatch.setattr(P, "HEAD_BYTES", head_bytes)
    pick = rounded if head_bytes == 60 else lambda d: d           # the very same numbers if no word is joined
    same(pick(TG.predict_aux(df, model, nb)), pick(old))


def test_aux_of_a_function(spark, nb, monkeypatch):
    df = texts(spark)
    rule = lambda w: w.withColumn("tag_pred", F.when(F.col("word").isin("food", "staff"), "B")
                                  .when(F.length("word") == 4, "I").when(F.length("word") < 9, "O"))
    monkeypatch.setattr(B, "CHUNK", 3000)
    same(rounded(TG.predict_aux(df, rule, nb, 2)), rounded(TG._aux_of_tokens(df, rule, nb, 2, S.NEUTRAL_THRESHOLD)))
    spark.catalog.clearCache()
    TG.predict_aux(df, rule, nb).collect()
    assert not spark.sparkContext._jsc.getPersistentRDDs()       # no cached token table


def test_aux_of_repeated_and_null_ids(spark, model, nb):
    df = texts(spark).unionByName(spark.createDataFrame([(3, "nothing here"), (None, "food was good")], COLS))
    old = TG._aux_of_tokens(df, model, nb, S.WINDOW_AUX, S.NEUTRAL_THRESHOLD)
    same(rounded(TG.predict_aux(df, model, nb)), rounded(old))


def test_other_pipelines_keep_their_way(spark, model):
    from pyspark.ml import PipelineModel
    assert TG.LinearTagger.of(model) is not None
    assert TG.LinearTagger.of(PipelineModel(model.stages[:2])) is None
