import tempfile

import pytest

from aspectra.operators import models as MD
from aspectra.operators import polarity as P


def _train(spark):
    return spark.createDataFrame([(1, "good great fine tasty", "positive"), (2, "bad awful poor", "negative"),
                                  (3, "fine good", "positive"), (4, "poor bad", "negative")],
                                 "review_id long, review_text string, polarity string")


def test_bundle_round_trip_and_missing(spark):
    path = tempfile.mkdtemp(prefix="aspectra-bundle-", dir="/tmp") + "/m"
    assert not MD.model_status(spark, path)
    with pytest.raises(FileNotFoundError):
        MD.load_nb_bundle(spark, path)
    m = P.nb_train(_train(spark))
    MD.save_nb_bundle(m, path, training=_train(spark))
    MD.save_nb_bundle(m, path, training=_train(spark))  # training kept, not rewritten
    again = MD.load_nb_bundle(spark, path)
    assert sorted(again.vocab.collect()) == sorted(m.vocab.collect())
    assert MD.model_status(spark, path)


def test_predict_one_review(spark):
    m = P.nb_train(_train(spark))
    out = MD.predict_text(spark, "The food was good. The service was bad", m).collect()
    assert out and all(r.review == "The food was good. The service was bad" for r in out)
    assert {r.sentiment for r in out} <= {"positive", "negative", "neutral"}


def test_lr_pipeline_history_and_sorted_probs(spark):
    model = P.lr_train(_train(spark), num_features=1 << 10, max_iter=5)
    hist = MD.training_history(spark, model).collect()
    assert len(hist) >= 1
    s = P.lr_score(model, _train(spark)).collect()
    assert all(0.5 <= r.prob <= 1.0 for r in s)
