"""The in-row path gives the rows of the relational one, in one narrow stage."""
import tempfile

import pytest
from pyspark.sql import functions as F

from aspectra.operators import annotate as A
from aspectra.operators import inrow as I
from aspectra.operators import predict as PR
from aspectra.operators import rules as R

HARD = [
    "", " . ", "It", "the", "no good food", "This is not a very good phone, the battery isn't bad; it works.",
    "We loved New York City Hotel and Big Apple. Apple Pie was great! THE END", "it, this; they: these",
    "wow wow wow", "not not really really good good service was amazing, oh", "A A A A a A. b's c've d're 9 99",
    "The room was cleaned quickly and beautifully by John Smith", "could would not be good", "é è ü Größe naïve café is nice",
    "was was was", "food, food, food, food was good and service was bad and the place were terrible",
]


def _both(df, keep_duplicates=False, window=6):
    s = A.split_sentences(df, num_partitions=2)
    t = A.annotate(s)
    new = I.extract(s, window, keep_duplicates=keep_duplicates)
    old = R.extract_aspects(s, t, window, keep_duplicates=keep_duplicates,
                            span_tokens=t.select(*A.SENT_KEYS, "i", "idx", "text")).select(*new.columns)
    return s, t, new, old


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"))
    hard = spark.createDataFrame([(-i, t) for i, t in enumerate(HARD, 1)] + [(-100, None)], "review_id long, review_text string")
    return docs.unionByName(hard)


def test_tokens_equal(texts):
    s = A.split_sentences(texts)
    new, old = I.token_table(I.sentence_tokens(s)), A.annotate(s)
    assert new.dtypes == old.dtypes
    assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


@pytest.mark.parametrize("keep_duplicates,window", [(False, 6), (True, 1)])
def test_findings_equal(texts, keep_duplicates, window):
    _, _, new, old = _both(texts, keep_duplicates, window)
    assert new.dtypes == old.dtypes
    assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def test_blocks_of_running_sums(spark, texts, monkeypatch):
    want = {tuple(r) for r in A.annotate(A.split_sentences(texts)).select(*A.SENT_KEYS, "i", "idx").collect()}
    monkeypatch.setattr(I, "SCAN_BLOCK", 3)
    got = I.token_table(I.sentence_tokens(A.split_sentences(texts))).select(*A.SENT_KEYS, "i", "idx")
    assert {tuple(r) for r in got.collect()} == want


def test_one_narrow_stage(spark, texts, tmp_path):
    texts.write.parquet(f"{tmp_path}/r")
    s = A.split_sentences(spark.read.parquet(f"{tmp_path}/r"), assume_partitioned=True)
    plan = I.extract(s)._jdf.queryExecution().executedPlan().toString()
    for word in ("Exchange", "InMemoryTableScan", "Sort [", "Window [", "HashAggregate", "Join ", "Python", "InArrow"):
        assert word not in plan
    # no array expression is evaluated once per element of another
    optimised = I.extract(s)._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("regexp_extract_all(regexp_replace(sentence") == 1


def test_long_sentence_is_linear(spark):
    import time
    took = {}
    for n in (1_000, 1_000, 8_000):
        text = " ".join(["beautiful", "food", "the", "service", "was", "really"][i % 6] for i in range(n))
        df = spark.createDataFrame([(1, text)], "review_id long, review_text string")
        t0 = time.time()
        rows = I.extract(A.split_sentences(df, assume_partitioned=True)).collect()
        took[n] = time.time() - t0
        assert len(rows) > n // 12
    assert took[8_000] < 8 * 3 * took[1_000] + 2


def test_works_on_a_stream(spark, texts, tmp_path):
    src = f"{tmp_path}/in"
    texts.write.parquet(src)
    stream = spark.readStream.schema("review_id long, review_text string").parquet(src)
    out = I.extract_reviews(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    out.awaitTermination()
    batch = I.extract_reviews(spark.read.parquet(src))
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.exceptAll(batch).count() == 0 and batch.exceptAll(back).count() == 0


def test_scores_equal_running_sums(spark, texts, monkeypatch):
    from aspectra.operators import polarity as P
    vocab = spark.createDataFrame([("good", 9, 1, 2.0), ("bad", 1, 9, -2.0), ("the", 5, 5, 0.5), ("was", 1, 0, 0.25)],
                                  "word string, n_pos long, n_neg long, lo double")
    model = P.NaiveBayesModel(vocab, 0.125)
    s = A.split_sentences(texts)
    cols = [*A.SENT_KEYS, "rule_no", "ord_i", "aspect", "aspect_sentence", "sentiment"]
    pick = lambda df: df.select(*cols, F.round("sentiment_prob", 9).alias("p"))
    old = pick(PR.predict_long(texts, model, sentences=s, tokens=A.annotate(s)))
    for most in (P.HEAD_BYTES, 60):          # whole vocabulary broadcast; rare words shuffled
        monkeypatch.setattr(P, "HEAD_BYTES", most)
        new = pick(PR.predict_long(texts, model))
        assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0
