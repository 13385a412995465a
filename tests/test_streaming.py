import tempfile

from aspectra.operators import polarity as P
from aspectra.streaming.score_stream import score_stream


def test_stream_scores_match_batch(spark):
    train = spark.createDataFrame([(1, "good great fine", "positive"), (2, "bad awful poor", "negative")],
                                  "review_id long, review_text string, polarity string")
    model = P.nb_train(train)
    src = tempfile.mkdtemp(prefix="aspectra-src-", dir="/tmp")
    docs = spark.createDataFrame([(10, "good fine"), (11, "awful bad")], "review_id long, review_text string")
    docs.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(docs.schema).parquet(src + "/in")
    q = score_stream(stream, model, src + "/out", src + "/ckpt", trigger_once=True)
    q.awaitTermination(120)
    got = {r.review_id: r.label for r in spark.read.parquet(src + "/out").collect()}
    assert got == {10: "positive", 11: "negative"}


def test_stream_predict_matches_batch(spark):
    from aspectra.operators import predict as PR
    from aspectra.streaming.score_stream import predict_stream
    train = spark.createDataFrame([(1, "good great fine", "positive"), (2, "bad awful poor", "negative")],
                                  "review_id long, review_text string, polarity string")
    model = P.nb_train(train)
    src = tempfile.mkdtemp(prefix="aspectra-src-", dir="/tmp")
    docs = spark.createDataFrame([(10, "The food was good. The menu is fantastic."), (11, "Staff never made happy")],
                                 "review_id long, review_text string")
    docs.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(docs.schema).parquet(src + "/in")
    q = predict_stream(stream, model, src + "/out", src + "/ckpt", trigger_once=True)
    q.awaitTermination(180)
    got = sorted((r.review_id, list(r.aspects), list(r.polarity))
                 for r in spark.read.parquet(src + "/out").collect())
    exp = sorted((r.review_id, list(r.aspects), list(r.polarity))
                 for r in PR.predict(docs, model, flat=True).collect())
    assert got == exp
