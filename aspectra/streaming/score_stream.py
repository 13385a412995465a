"""Polarity scoring of a streaming DataFrame.

The reference has no streams.  Cleaning, tokenising and word scoring are stateless, so a
stream of reviews can be scored micro-batch by micro-batch with the same batch operator
(``foreachBatch``); the sink is idempotent per batch id, so a restarted query that
replays a batch overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import polarity as P


def score_stream(stream: DataFrame, model: P.NaiveBayesModel, sink_path: str, checkpoint_location: str,
                 key_col: str = "review_id", text_col: str = "review_text",
                 threshold: float = S.NEUTRAL_THRESHOLD, trigger_once: bool = False):
    """Start a query writing (key, label, prob, sentiment, batch_id) Parquet under
    ``sink_path/batch_id=<n>``."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        scored = P.polarity_score(batch, model, key_col, text_col, threshold=threshold)
        (scored.withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def predict_stream(stream: DataFrame, model: P.NaiveBayesModel, sink_path: str, checkpoint_location: str,
                   flat: bool = True, trigger_once: bool = False, **kw):
    """Aspect extraction + window polarity for a stream of reviews (review_id,
    review_text): each micro-batch runs the batch ``predict`` plan and is written under
    ``sink_path/batch_id=<n>`` (overwrite per batch id, so a replayed batch is not
    duplicated).  Per-review work needs no state across batches."""
    from ..operators import predict as PR

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = PR.predict(batch, model, flat=flat, **kw)
        out.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
