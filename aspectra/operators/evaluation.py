"""Evaluation runs (E4, E6-E8, J6, A7 over several groupings, cross-fitted taggers).

Every gold row counts: predictions are joined to gold from the left, so a review that was
rejected stays, without aspects and polarity, and is wrong.  Scores are made once, written,
and read by every report.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage
from . import bio as B
from . import evaluate as EV
from . import polarity as P
from . import predict as PR
from . import sampling as SA
from . import tagger as TG


# ---------------------------------------------------------------------------------------
# J6, E4, E6
# ---------------------------------------------------------------------------------------
def align(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Gold (review_id, ...) left outer join flat predictions (review_id, aspects,
    polarity): adds ``aspects``, ``pred_polarity`` (empty lists without a prediction) and
    ``has_prediction``."""
    p = predictions.select("review_id", "aspects", F.col("polarity").alias("pred_polarity"), F.lit(True).alias("has_prediction"))
    empty = F.array().cast("array<string>")
    return gold.join(p, "review_id", "left").withColumns({
        "aspects": F.coalesce("aspects", empty), "pred_polarity": F.coalesce("pred_polarity", empty),
        "has_prediction": F.coalesce("has_prediction", F.lit(False))})


def coverage(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: ids in gold, in the predictions, in both, and in only one of them."""
    ids = lambda df, name: df.select("review_id").distinct().withColumn(name, F.lit(1))
    j = ids(gold, "g").join(ids(predictions, "p"), "review_id", "full_outer")
    n = lambda cond: F.count_if(cond).alias
    g, p = F.col("g").isNotNull(), F.col("p").isNotNull()
    return j.agg(n(g)("gold"), n(p)("predicted"), n(g & p)("matched"),
                 n(g & ~p)("gold_without_prediction"), n(p & ~g)("prediction_without_gold"))


def evaluate_run(gold: DataFrame, model: P.NaiveBayesModel, reviews: DataFrame | None = None, **kw) -> DataFrame:
    """Gold -> batch flat predictions -> aligned table.  ``reviews`` (review_id,
    review_text) are predicted; default: the texts of gold."""
    reviews = gold.select("review_id", "review_text") if reviews is None else reviews
    return align(gold, PR.predict(reviews, model, flat=True, **kw))


def polarity_report(aligned: DataFrame) -> DataFrame:
    """The A9 report of the first predicted polarity against the gold one."""
    return EV.classification_report(EV.eval_polarity(aligned))


# ---------------------------------------------------------------------------------------
# Several groupings in one pass
# ---------------------------------------------------------------------------------------
def describe_sets(df: DataFrame, sets: dict[str, list[str]], value_col: str) -> DataFrame:
    """A7 for every named set of grouping columns: ``grouping``, the columns (null where the
    set does not use them), count, mean, sample std, min, quartiles, max of an integer column.

    The rows are read once: they are counted by (all flags, value), and the grouping sets
    are made from that histogram."""
    flags = sorted({c for cols in sets.values() for c in cols})
    hist = df.filter(F.col(value_col).isNotNull()).groupBy(*flags, F.col(value_col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    name = F.lit(None).cast("string")
    for label, cols in sets.items():
        used = F.lit(True)
        for f in flags:
            used = used & (F.grouping(f) == (0 if f in cols else 1))
        name = F.when(used, F.lit(label)).otherwise(name)
    h = hist.groupingSets([[*cols, "v"] for cols in sets.values()], *flags, "v").agg(F.sum("c").alias("c"), name.alias("grouping"))
    group = ["grouping", *flags]
    upto = Window.partitionBy(*group).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumns({"hi": F.sum("c").over(upto), "n": F.sum("c").over(Window.partitionBy(*group))})
    total, square = F.sum(F.col("v") * F.col("c")), F.sum(F.col("v") * F.col("v") * F.col("c"))
    n = F.max("n")
    spread = F.when(n > 1, F.sqrt(F.greatest(square - total * total / n, F.lit(0.0)) / (n - 1)))

    def quartile(p):
        at = F.lit(p) * (F.col("n") - 1)
        value = lambda k: F.min(F.when(F.col("hi") > k, F.col("v")))
        part = F.max(at - F.floor(at))
        return (value(F.floor(at)) + part * (value(F.ceil(at)) - value(F.floor(at)))).cast("double")

    return h.groupBy(*group).agg(
        n.cast("bigint").alias("count"), F.round(total / n, 6).alias("mean"), F.round(spread, 6).alias("std"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"),
        quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75"))


ERROR_SETS = {"correct": ["is_correct"], "empty": ["is_empty", "is_correct"], "composed": ["composed_aspect", "is_correct"]}


def error_stats(rows: DataFrame, value_col: str = "sentence_size") -> DataFrame:
    """A7 over P16 rows: by correct, empty x correct and composed x correct."""
    return describe_sets(rows.withColumn("is_empty", F.col("aspect_size") == 0), ERROR_SETS, value_col)


# ---------------------------------------------------------------------------------------
# Every gold sentence tagged by a model that has not seen it
# ---------------------------------------------------------------------------------------
def cross_fit(words: DataFrame, keys: list[str], fold: Column, folds: int = 5,
              train: Callable[[DataFrame], object] = TG.tagger_train,
              predict: Callable[[object, DataFrame], DataFrame] = TG.tagger_predict) -> DataFrame:
    """Out-of-fold tags: ``fold`` (0 .. folds - 1, the same for all words of a sentence) names
    the part a word is in; its tag comes from a model trained on the other parts.  Adds
    ``fold`` and ``tag_pred``.  Features are written once and read by every model."""
    f = cut_lineage(TG.token_features(words, keys).withColumn("fold", fold.cast("int")))
    out = None
    for k in range(folds):
        model = train(f.filter(F.col("fold") != k))
        part = predict(model, f.filter(F.col("fold") == k)).select(*words.columns, "fold", "tag_pred")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class ErrorAnalysis:
    """outcomes: tokens per A14 outcome; sentences: P16 rows; stats: A7 in three groupings."""
    outcomes: DataFrame
    sentences: DataFrame
    stats: DataFrame


def error_analysis(tagged: DataFrame, gold: DataFrame, key: str = "review_id", pred_col: str = "tag_pred") -> ErrorAnalysis:
    """E7 from words (key, i, gold, ``pred_col``) and gold sentences (key, aspect, text_tokens)."""
    tokens = EV.token_outcomes(tagged, pred_col=pred_col)
    tags = tagged.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "gold", F.col(pred_col).alias("pred")))).alias("t"))
    tags = tags.select(key, F.transform("t", lambda x: x["gold"]).alias("tags"), F.transform("t", lambda x: x["pred"]).alias("tags_pred"))
    rows = B.error_flags(gold.select(key, "aspect", "text_tokens").join(tags, key))
    return ErrorAnalysis(tokens.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), rows, error_stats(rows))


# ---------------------------------------------------------------------------------------
# The polarity model on rows it was not trained on
# ---------------------------------------------------------------------------------------
def heldout_scores(labelled: DataFrame, threshold: float = S.NEUTRAL_THRESHOLD) -> DataFrame:
    """Labelled reviews (review_id, review_text, polarity) -> stratified 80/20 split, M1 chain
    and naive Bayes on the training part -> the scored validation rows (review_id, y_true,
    y_pred, label, prob, score), written once."""
    lr = labelled.filter(F.col("polarity").isin(S.POSITIVE, S.NEGATIVE))
    split = SA.stratified_split(lr, "review_id", "polarity")
    part = lambda name: split.filter(F.col("split") == name).drop("split")
    model = P.nb_train(P.polarity_training_set(part("train")))
    valid = part("valid")
    scored = P.polarity_score(valid, model, threshold=threshold)
    return cut_lineage(valid.select("review_id", F.col("polarity").alias("y_true")).join(
        scored.select("review_id", F.col("sentiment").alias("y_pred"), "label", "prob", "score"), "review_id"))


def heldout_reports(scored: DataFrame) -> dict[str, DataFrame]:
    """Report (A9), confusion matrix (A10) and AUC (A13) of one scored table."""
    return {"report": EV.classification_report(scored),
            "matrix": EV.confusion_matrix(scored, [S.NEGATIVE, S.NEUTRAL, S.POSITIVE]),
            "auc": EV.roc_auc(scored.withColumn("is_pos", F.col("y_true") == S.POSITIVE), "score", "is_pos")}
