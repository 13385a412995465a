"""Model bundles (K4, K5, M9) and single-review prediction.

A bundle is a folder: ``vocab`` / ``prior`` (naive Bayes tables) or ``pipeline``
(MLlib), ``labels`` (label index), ``metrics`` (long form: metric, label, value) and
``training`` (written only when absent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import polarity as P


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def metrics_long(report: DataFrame) -> DataFrame:
    """Classification report -> (metric, label, value) rows."""
    cols = ["precision", "recall", "f1", "support"]
    stacked = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    return report.selectExpr("label", f"stack({len(cols)}, {stacked}) AS (metric, value)")


METRIC_SCHEMA = "run string, split string, metric string, label string, value double"


def append_metrics(path: str, run: str, split: str, rows: DataFrame) -> None:
    """M9: append (label, metric, value) rows of a run on a split to the bundle's metric
    store; earlier runs stay."""
    rows.select(F.lit(run).alias("run"), F.lit(split).alias("split"), "metric", F.col("label").cast("string").alias("label"),
                F.col("value").cast("double").alias("value")).write.mode("append").parquet(f"{path}/metric_store")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a bundle's metric store; no rows if there are none yet."""
    at = f"{path}/metric_store"
    return spark.read.schema(METRIC_SCHEMA).parquet(at) if path_exists(spark, at) else spark.createDataFrame([], METRIC_SCHEMA)


def sequence_metrics_long(report: DataFrame) -> DataFrame:
    """Sequence report (one row) -> (metric, label, value) rows, label ``all``."""
    cols = ["precision", "recall", "f1", "accuracy"]
    stacked = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    return report.selectExpr("'all' AS label", f"stack({len(cols)}, {stacked}) AS (metric, value)")


def save_nb_bundle(model: P.NaiveBayesModel, path: str, labels: DataFrame | None = None,
                   metrics: DataFrame | None = None, training: DataFrame | None = None) -> None:
    """K4: write the model tables, label index and metrics; the training data only if
    the bundle has none yet."""
    spark = model.vocab.sparkSession
    model.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    spark.createDataFrame([(model.prior_lo,)], "prior_lo double").write.mode("overwrite").parquet(f"{path}/prior")
    if labels is not None:
        labels.write.mode("overwrite").parquet(f"{path}/labels")
    if metrics is not None:
        metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    if training is not None and not path_exists(spark, f"{path}/training"):
        training.write.parquet(f"{path}/training")


def model_status(spark: SparkSession, path: str) -> bool:
    """K5: true iff a bundle exists at ``path``."""
    return path_exists(spark, path)


def load_nb_bundle(spark: SparkSession, path: str) -> P.NaiveBayesModel:
    """K5: load a naive Bayes bundle; scoring without a model is an error."""
    if not model_status(spark, path):
        raise FileNotFoundError(f"no trained model at {path}; train and save one first")
    prior = spark.read.parquet(f"{path}/prior").first()["prior_lo"]
    return P.NaiveBayesModel(spark.read.parquet(f"{path}/vocab"), prior)


def save_pipeline(model, path: str) -> None:
    model.write().overwrite().save(f"{path}/pipeline")


def load_pipeline(spark: SparkSession, path: str):
    from pyspark.ml import PipelineModel
    if not model_status(spark, f"{path}/pipeline"):
        raise FileNotFoundError(f"no trained model at {path}; train and save one first")
    return PipelineModel.load(f"{path}/pipeline")


def training_history(spark: SparkSession, pipeline_model) -> DataFrame:
    """M9: objective value per iteration of the fitted logistic regression."""
    lr = pipeline_model.stages[-1]
    hist = list(lr.summary.objectiveHistory) if lr.hasSummary else []
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, objective double")


def predict_text(spark: SparkSession, text: str, model: P.NaiveBayesModel, review_id: int = 0,
                 flat: bool = False, **kw) -> DataFrame:
    """Score one review (the same plan on a one-row DataFrame)."""
    from . import predict as PR
    one = spark.createDataFrame([(review_id, text)], "review_id long, review_text string")
    return PR.predict(one, model, flat=flat, include_text=True, **kw)
