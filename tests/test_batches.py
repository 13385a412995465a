"""The Arrow-batch path gives the rows of the relational one."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from aspectra.operators import annotate as A
from aspectra.operators import batches as B
from aspectra.operators import polarity as P
from aspectra.operators import predict as PR
from aspectra.operators import rules as R

HARD = [
    "", " . ", "It", "the", "no good food", "This is not a very good phone, the battery isn't bad; it works.", " . x",
    "We loved New York City Hotel and Big Apple. Apple Pie was great! THE END", "it, this; they: these", ", ; x : was helpful",
    "wow wow wow", "not not really really good good service was amazing, oh", "A A A A a A. b's c've d're 9 99", "don't n'txy 'sx '",
    "The room was cleaned quickly and beautifully by John Smith", "could would not be good", "é è ü Größe naïve café is nice ㎏ Ⅳ x",
    "was was was", "food, food, food, food was helpful and service was horrible and the place were terrible", "a\x01b.  c? 　 d",
    "No horrible staff was never really awful. They were really nervous, it is a place. Wow it is nice",
]
VOCAB = [("good", 9, 1, 2.0), ("bad", 1, 9, -2.0), ("the", 5, 5, 0.5), ("was", 1, 0, 0.25)]


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"))
    hard = spark.createDataFrame([(-i, t) for i, t in enumerate(HARD, 1)] + [(-100, None)], "review_id long, review_text string")
    return docs.unionByName(hard)


def same(new, old):
    assert new.dtypes == old.dtypes
    assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def test_tokens_equal(texts, monkeypatch):
    old = A.annotate(A.split_sentences(texts))
    same(B.token_rows(texts), old)
    same(B.token_rows(texts, ("i", "text")), old.select(*A.SENT_KEYS, "i", "text"))
    words = B.sentence_words(texts).select(*A.SENT_KEYS, F.posexplode("words").alias("i", "text"))
    same(words, old.select(*A.SENT_KEYS, "i", "text"))


@pytest.mark.parametrize("keep_duplicates,window,compat", [(False, 6, False), (True, 1, True)])
def test_findings_equal(texts, keep_duplicates, window, compat):
    s = A.split_sentences(texts, num_partitions=2)
    t = A.annotate(s)
    new = B.extract(texts, window, compat, keep_duplicates)
    same(new, R.extract_aspects(s, t, window, compat, keep_duplicates, span_tokens=t.select(*A.SENT_KEYS, "i", "idx", "text"))
         .select(*new.columns))
    assert {r.rule_no for r in new.select("rule_no").distinct().collect()} >= {1, 2, 3, 4, 7, None}


def test_no_token_leaves_the_batch(spark, texts, tmp_path):
    texts.write.parquet(f"{tmp_path}/r")
    r = spark.read.parquet(f"{tmp_path}/r")
    for out in (B.token_rows(r), B.extract(r)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("Exchange", "Sort [", "Window [", "HashAggregate", "Join ", "regexp") if x in plan]
    model = P.NaiveBayesModel(spark.createDataFrame(VOCAB, "word string, n_pos long, n_neg long, lo double"), 0.125)
    plan = PR.predict(r, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and "Aggregate" not in plan


def test_small_chunks_and_many_rows(texts, monkeypatch):
    want = B.token_rows(texts)
    want = want.sparkSession.createDataFrame(want.collect(), want.schema)
    monkeypatch.setattr(B, "CHUNK", 50)
    monkeypatch.setattr(B, "OUT_ROWS", 7)
    got = [tuple(r) for b in B.chunks(iter(texts.toArrow().to_batches())) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert len(got) == texts.count()
    same(B.token_rows(texts), want)


def test_span_sums():
    v = np.array([1.0, 2.0, 4.0, 8.0])
    lo, hi = np.array([0, 1, 3, 2, 4, 0]), np.array([4, 3, 4, 2, 4, 1])
    assert B.span_sums(v, lo, hi).tolist() == [15.0, 6.0, 8.0, 0.0, 0.0, 1.0]


def test_repeated_ids_are_merged_as_before(spark):
    df = spark.createDataFrame([(1, "The food was horrible and bad. The nice staff"), (1, "The food was horrible and bad. The bad staff"),
                                (2, "good good food"), (None, "bad food"), (None, "bad food")], "review_id long, review_text string")
    model = P.NaiveBayesModel(spark.createDataFrame(VOCAB, "word string, n_pos long, n_neg long, lo double"), 0.125)
    from aspectra.operators import inrow as I
    old = PR.window_scores(I.extract(A.split_sentences(df), with_words=True), model, 0.7)
    pick = lambda d: d.withColumn("sentiment_prob", F.round("sentiment_prob", 9)).select(*sorted(d.columns))
    same(pick(PR.predict(df, model)), pick(old))


def test_word_counts_equal_exploded_words(spark, texts):
    t = texts.select((F.col("review_id") % 2 == 0).alias("p"), "review_text")
    old = t.select("p", F.explode(P.words_of(F.col("review_text"))).alias("word")).groupBy("word").agg(
        F.sum(F.col("p").cast("long")).alias("n_pos"), F.sum((~F.col("p")).cast("long")).alias("n_neg"))
    same(B.word_counts(t).groupBy("word").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg")), old)


def test_training_counts_words_once(spark, monkeypatch):
    from aspectra.functions import text as TX
    calls = []
    whole = TX.word_count
    monkeypatch.setattr(TX, "word_count", lambda c: calls.append(1) or whole(c))
    df = spark.createDataFrame([(i, "word " * (i % 9 + 1), "positive" if i % 3 else "negative") for i in range(90)],
                               "review_id long, review_text string, polarity string")
    train = P.polarity_training_set(df)
    assert train.columns == df.columns and len(calls) == 1
    assert "regexp_replace" not in train._jdf.queryExecution().optimizedPlan().toString()
    same(train, P.balance_binary(P.length_iqr_filter(df)))


@pytest.mark.parametrize("head_bytes", [P.HEAD_BYTES, 60])
def test_predict_equals_predict_long(spark, texts, monkeypatch, head_bytes):
    monkeypatch.setattr(P, "HEAD_BYTES", head_bytes)
    model = P.NaiveBayesModel(spark.createDataFrame(VOCAB, "word string, n_pos long, n_neg long, lo double"), 0.125)
    good = texts.filter(F.col("review_text").rlike(r"\S"))
    pick = lambda d: d.withColumn("sentiment_prob", F.round("sentiment_prob", 9)).select(*sorted(d.columns))
    same(pick(PR.predict(texts, model)), pick(PR.predict_long(good, model)))
