"""T5-T8 variants, seeded sample, stratified split, label index, partition sizing."""
from pyspark.sql import functions as F

from aspectra.functions import text as TX
from aspectra.operators import evaluate as EV
from aspectra.operators import sampling as SA
from aspectra.session import text_partitions


def test_text_variants(spark):
    df = spark.createDataFrame([("It's what I've said, isn't it? (Yes!)",)], "t string")
    r = df.select(TX.to_lower(F.col("t")).alias("a"), TX.delete_punctuation(F.col("t")).alias("b"),
                  TX.split_contractions(F.col("t")).alias("c"), TX.space_punctuation(F.col("t")).alias("d")).first()
    assert r.a == "it's what i've said, isn't it? (yes!)"
    assert r.b == "Its what Ive said isnt it Yes"
    assert r.c == "It 's what I 've said, is n't it? (Yes!)"
    assert r.d == "It's what I've said ,  isn't it ?   ( Yes !  ) "


def test_seeded_sample_is_deterministic_and_sized(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    a = [r.doc_id for r in SA.seeded_sample(df, "doc_id", n=50).collect()]
    b = [r.doc_id for r in SA.seeded_sample(df.repartition(7), "doc_id", n=50).collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)


def test_stratified_split_proportions(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(200)], "review_id long, y string")
    out = SA.stratified_split(df, "review_id", "y").groupBy("y", "split").count().collect()
    got = {(r.y, r.split): r["count"] for r in out}
    assert got[("a", "valid")] == 30 and got[("a", "train")] == 120   # ceil(0.2 * 150)
    assert got[("b", "valid")] == 10 and got[("b", "train")] == 40    # ceil(0.2 * 50)


def test_label_index_alphabetical(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("conflict",), ("negative",)], "polarity string")
    assert [(r.label, r.label_id) for r in EV.label_index(df, "polarity").orderBy("label_id").collect()] == \
        [("conflict", 0), ("negative", 1), ("positive", 2)]


def test_text_partitions_grow_with_input(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert text_partitions(small) == spark.sparkContext.defaultParallelism
    assert text_partitions(small, bytes_per_partition=1024) > spark.sparkContext.defaultParallelism


def test_lists_aligned_flags_unequal_gold_lists(spark):
    from aspectra.operators import bio as B
    df = spark.createDataFrame([(["a", "b"], ["positive", "negative"]), (["a", "b"], ["positive"])],
                               "aspect array<string>, polarity array<string>")
    got = [r.ok for r in df.select(B.lists_aligned(F.col("aspect"), F.col("polarity")).alias("ok")).collect()]
    assert got == [True, False]
