"""A corpus bucketed by review_id runs the whole extraction plan without an exchange."""
import tempfile
import uuid

from pyspark.sql import functions as F

from aspectra.operators import annotate as A
from aspectra.operators import rules as R
from aspectra.sources import readers as RD


def test_bucketed_corpus_needs_no_shuffle(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang = 'en'")
            .select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text")))
    path = tempfile.mkdtemp(prefix="aspectra-bucketed-", dir="/tmp") + "/t"
    t = RD.write_bucketed_reviews(docs, f"rev_{uuid.uuid4().hex[:8]}", path, 4)
    s = A.split_sentences(t, assume_partitioned=True)
    e = R.extract_aspects(s, A.annotate(s), 6)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = e._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan
    assert e.count() > 0


def test_text_path_has_only_the_one_repartition(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang = 'en'")
            .select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, s, tok = A.annotate_corpus(docs)
        e = R.extract_aspects(s, tok, 6)
        plan = e._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.clearCache()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("REPARTITION_BY_NUM" in line for line in exchanges)
