"""Plans of the text path at size: small tasks, narrow rows for words, nothing cached for one reader."""
import glob
import os

from pyspark.sql import functions as F

from aspectra.operators import annotate as A
from aspectra.operators import inrow as I
from aspectra.operators import polarity as P
from aspectra.operators import predict as PR
from aspectra.session import text_partitions

SF = "/root/testdata/sf0.001"


def _texts(spark, n=40):
    return spark.createDataFrame([(i, f"The room {i} was very nice. We loved Big Apple, the food was bad!") for i in range(n)],
                                 "review_id long, review_text string")


def test_partitions_are_small_and_bounded(spark, monkeypatch):
    import aspectra.session as SE
    d = spark.range(1)
    for size, want in ((1 << 30, 256), (6 << 30, 1536), (100 << 30, 10_000), (100 << 40, 100 << 15)):
        monkeypatch.setattr(SE, "input_bytes", lambda df: size)  # noqa: B023
        assert text_partitions(d) == want


def test_known_input_is_spread_whatever_its_size(spark, monkeypatch):
    import aspectra.session as SE
    monkeypatch.setattr(SE, "TEXT_BYTES_PER_PARTITION", 16)           # every input is "large"
    plan = A.spread(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan


def test_words_travel_without_their_sentence(spark, monkeypatch):
    vocab = spark.createDataFrame([("nice", 9, 1, 2.0), ("bad", 1, 9, -2.0)], "word string, n_pos long, n_neg long, lo double")
    seen = []
    real = P.with_log_odds
    monkeypatch.setattr(PR.P, "with_log_odds", lambda rows, *a, **k: seen.append(rows.columns) or real(rows, *a, **k))
    rows = PR.predict_long(_texts(spark), P.NaiveBayesModel(vocab, 0.0))
    assert seen and "aspect_sentence" not in seen[0] and len(seen[0]) == 2
    assert rows.count() == I.extract_reviews(_texts(spark)).count()


def test_head_children_caches_nothing(spark):
    from aspectra.plans.queries import QUERIES
    plan = QUERIES["head_children"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan


def test_running_sums_copy_no_array_per_token(spark, monkeypatch):
    monkeypatch.setattr(I, "SCAN_BLOCK", 4)
    d = spark.createDataFrame([(list(range(1, k + 1)),) for k in (1, 3, 4, 5, 8, 9, 33)] + [([],)], "sizes array<int>")
    d = d.withColumn("blocks", I.block_starts(F.col("sizes"), F.size("sizes")))
    for r in d.withColumn("idx", I.running_starts(F.col("sizes"), F.col("blocks"))).collect():
        assert r.idx == [sum(r.sizes[:i]) for i in range(len(r.sizes))]


def test_a_bucket_is_one_file(spark, tmp_path):
    from aspectra.sources import readers as RD
    RD.write_bucketed_reviews(_texts(spark).repartition(5), "scale_bucketed", f"{tmp_path}/b", 4)
    assert len(glob.glob(os.path.join(f"{tmp_path}/b", "*.parquet"))) <= 4
    spark.sql("drop table scale_bucketed")
