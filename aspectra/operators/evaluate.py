"""Metrics and evaluations.

Every metric starts with a pre-aggregation whose size is bounded by the label set (or
by running totals over range partitions for ROC), so nothing proportional to the data is
ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from .stats import histogram_quantiles, running_totals


def accuracy(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Share of rows with y_true == y_pred."""
    return df.agg(F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


def _pair_counts(df, y_true, y_pred):
    return df.groupBy(F.col(y_true).alias("t"), F.col(y_pred).alias("p")).agg(
        F.count(F.lit(1)).cast("double").alias("c"))


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per label precision, recall, f1, support (labels = union of true and predicted
    values), then rows 'accuracy' (f1 = accuracy), 'macro avg', 'weighted avg'.
    A 0/0 ratio counts as 0."""
    pc = _pair_counts(df, y_true, y_pred)  # at most |labels|^2 rows
    tp = pc.filter("t = p").select(F.col("t").alias("label"), F.col("c").alias("tp"))
    sup = pc.groupBy(F.col("t").alias("label")).agg(F.sum("c").alias("support"))
    npred = pc.groupBy(F.col("p").alias("label")).agg(F.sum("c").alias("npred"))
    labels = sup.select("label").union(npred.select("label")).distinct()
    per = (labels.join(tp, "label", "left").join(sup, "label", "left").join(npred, "label", "left")
           .na.fill(0.0, ["tp", "support", "npred"]))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("npred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp_all"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    rows = per.select("label", "precision", "recall", "f1", "support")
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp_all") / F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    mac = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    wei = tot.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support"))
    out = rows.unionByName(acc).unionByName(mac).unionByName(wei)
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


def confusion_matrix(df: DataFrame, labels: list[str], y_true: str = "y_true",
                     y_pred: str = "y_pred") -> DataFrame:
    """A10: rows = true label, one count column per predicted label, in ``labels`` order."""
    return (df.groupBy(F.col(y_true).alias("y_true")).pivot(y_pred, labels).count().na.fill(0)
            .select("y_true", *[F.col(f"`{l}`").cast("bigint").alias(l) for l in labels]))


def micro_f1(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Micro-averaged F1 from summed tp / fp / fn (single-label: equals accuracy)."""
    pc = _pair_counts(df, y_true, y_pred)
    agg = pc.agg(F.sum(F.when(F.col("t") == F.col("p"), F.col("c")).otherwise(0.0)).alias("tp"),
                 F.sum(F.when(F.col("t") != F.col("p"), F.col("c")).otherwise(0.0)).alias("fp"))
    # single-label: every miss is one fp (for the predicted class) and one fn (true class)
    return agg.select(F.round(F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + 2 * F.col("fp")),
                                         F.lit(0.0)), 6).alias("micro_f1"))


# Scores that agree to this many digits are ties: sums of the same numbers in another
# order differ in the last bits.
TIE_DIGITS = 9


def _roc_groups(df: DataFrame, score_col: str, is_pos_col: str) -> DataFrame:
    """Distinct scores, descending, with counts and the counts above them (running totals
    over range partitions: no single task sees all scores)."""
    g = (df.groupBy(F.round(F.col(score_col), TIE_DIGITS).alias("threshold"))
         .agg(F.sum(F.col(is_pos_col).cast("long")).alias("npos"),
              F.sum((~F.col(is_pos_col)).cast("long")).alias("nneg")))
    return running_totals(g, "threshold", ["npos", "nneg"], descending=True)


def roc_points(df: DataFrame, score_col: str, is_pos_col: str) -> DataFrame:
    """A13 curve: per distinct threshold (descending) the cumulative tpr and fpr."""
    g = _roc_groups(df, score_col, is_pos_col)
    tot = g.agg(F.sum("npos").alias("p"), F.sum("nneg").alias("n")).first()
    rate = lambda c, n: F.try_divide(F.col(c), F.lit(n or 0).cast("double"))
    return g.select("threshold", F.col("npos_total").alias("tp"), F.col("nneg_total").alias("fp"),
                    rate("npos_total", tot["p"]).alias("tpr"), rate("nneg_total", tot["n"]).alias("fpr"))


def roc_auc(df: DataFrame, score_col: str, is_pos_col: str) -> DataFrame:
    """A13 AUC (one class against the rest), ties counted half: trapezoid rule."""
    g = _roc_groups(df, score_col, is_pos_col).withColumn("above", F.col("npos_total") - F.col("npos"))
    area = F.sum(F.col("nneg") * (F.col("above") + 0.5 * F.col("npos")))
    return g.agg(F.coalesce(F.sum("npos"), F.lit(0)).cast("bigint").alias("n_pos"),
                 F.coalesce(F.sum("nneg"), F.lit(0)).cast("bigint").alias("n_neg"),
                 F.try_divide(area, (F.sum("npos") * F.sum("nneg")).cast("double")).alias("auc"))


# ---------------------------------------------------------------------------------------
# Sequence metrics over BIO tags
# ---------------------------------------------------------------------------------------
def tag_spans(tok: DataFrame, key_cols: list[str], tag_col: str) -> DataFrame:
    """Entity spans of a tag column: an entity starts at B, or at an I not continuing an
    entity; it extends over following I tags.  Output: keys, start, end (inclusive)."""
    w = Window.partitionBy(*key_cols).orderBy("i")
    t = tok.withColumn("_prev", F.lag(tag_col).over(w))
    start = (F.col(tag_col) == "B") | ((F.col(tag_col) == "I") & (F.coalesce(F.col("_prev"), F.lit("O")) == "O"))
    t = (t.withColumn("_ent", F.col(tag_col) != "O")
          .withColumn("_st", (F.col("_ent") & start).cast("int"))
          .withColumn("_run", F.sum("_st").over(w.rowsBetween(Window.unboundedPreceding, 0)))
          .filter("_ent"))
    return t.groupBy(*key_cols, "_run").agg(F.min("i").alias("start"), F.max("i").alias("end")).drop("_run")


def seq_report(tok: DataFrame, key_cols: list[str], gold_col: str = "gold", pred_col: str = "pred") -> DataFrame:
    """Entity-level precision / recall / f1 (exact span match) and token accuracy."""
    g = tag_spans(tok, key_cols, gold_col).withColumn("_g", F.lit(1))
    p = tag_spans(tok, key_cols, pred_col).withColumn("_p", F.lit(1))
    j = g.join(p, key_cols + ["start", "end"], "full_outer")
    c = j.agg(F.sum(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1).otherwise(0)).alias("tp"),
              F.sum(F.coalesce(F.col("_p"), F.lit(0))).alias("npred"),
              F.sum(F.coalesce(F.col("_g"), F.lit(0))).alias("ngold"))
    acc = tok.agg(F.avg((F.col(gold_col) == F.col(pred_col)).cast("double")).alias("accuracy")).first()["accuracy"]
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("ngold")), F.lit(0.0))
    r = c.select(prec.alias("precision"), rec.alias("recall"), F.lit(acc).cast("double").alias("accuracy"))
    r = r.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                   F.col("precision") + F.col("recall")), F.lit(0.0)))
    return r.select(*[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "accuracy")])


def token_outcomes(tok: DataFrame, gold_col: str = "gold", pred_col: str = "pred") -> DataFrame:
    """A14 with corrected names: TN (O/O), TP (same aspect tag), FP (gold O, predicted an
    aspect tag, or a wrong aspect tag), FN (gold aspect, predicted O)."""
    g, p = F.col(gold_col), F.col(pred_col)
    return tok.withColumn("outcome", F.when((g == "O") & (p == "O"), "TN").when(g == p, "TP")
                          .when(g == "O", "FP").when(p == "O", "FN").otherwise("FP"))


def describe_by(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per group (quartiles exact, from a
    histogram of the integer values)."""
    base = df.groupBy(*group_cols).agg(F.count(value_col).cast("bigint").alias("count"),
                                       F.round(F.avg(value_col), 6).alias("mean"),
                                       F.round(F.stddev_samp(value_col), 6).alias("std"),
                                       F.min(value_col).cast("double").alias("min"),
                                       F.max(value_col).cast("double").alias("max"))
    q = histogram_quantiles(df, value_col, [0.25, 0.5, 0.75], group_cols, ["q25", "q50", "q75"])
    return base.join(q, group_cols)


# ---------------------------------------------------------------------------------------
# Label index (J7, A6, M8) and end-to-end evaluations
# ---------------------------------------------------------------------------------------
def label_index(df: DataFrame, label_col: str) -> DataFrame:
    """Distinct labels with alphabetical ids (stable between runs)."""
    d = df.select(F.col(label_col).alias("label")).filter(F.col("label").isNotNull()).distinct()
    w = Window.orderBy("label")  # distinct label set: tiny
    return d.withColumn("label_id", (F.row_number().over(w) - 1).cast("bigint"))


def encode_labels(df: DataFrame, index: DataFrame, label_col: str) -> DataFrame:
    """J7 encode: adds ``label_id``.  An unknown label fails the job that meets it; a null
    label stays null."""
    j = df.join(index.withColumnRenamed("label", label_col), label_col, "left")
    unknown = F.col("label_id").isNull() & F.col(label_col).isNotNull()
    wrong = F.raise_error(F.concat(F.lit(f"unknown label in column {label_col}: "), F.col(label_col)))
    return j.withColumn("label_id", F.when(unknown, wrong.cast("bigint")).otherwise(F.col("label_id")))


def decode_labels(df: DataFrame, index: DataFrame, id_col: str = "label_id", label_col: str = "label") -> DataFrame:
    """J7 decode: adds the label of an id; an unknown id fails the job that meets it."""
    j = df.join(index.select(F.col("label_id").alias(id_col), F.col("label").alias(label_col)), id_col, "left")
    unknown = F.col(label_col).isNull() & F.col(id_col).isNotNull()
    wrong = F.raise_error(F.concat(F.lit(f"unknown id in column {id_col}: "), F.col(id_col).cast("string")))
    return j.withColumn(label_col, F.when(unknown, wrong.cast("string")).otherwise(F.col(label_col)))


def eval_polarity(base: DataFrame) -> DataFrame:
    """Gold with exactly one (aspect, polarity) pair, >= 5 words, polarity not
    'conflict'; the *first* predicted polarity against the gold one."""
    words = F.size(F.split(F.trim(F.regexp_replace("review_text", r"\s+", " ")), " "))
    d = base.filter((F.size("aspect") == 1) & (words >= S.EVAL_POLARITY_MIN_WORDS)
                    & (F.get("polarity", 0) != S.CONFLICT))
    d = d.select("review_id", F.lower(F.coalesce(F.get("polarity", 0), F.lit("None"))).alias("y_true"),
                 F.lower(F.coalesce(F.get("pred_polarity", 0), F.lit("None"))).alias("y_pred"))
    return d.withColumn("ok", F.col("y_true") == F.col("y_pred"))


def eval_aspect(base: DataFrame) -> DataFrame:
    """E5: empty gold -> ('None', 'positive'); exactly one pair; <= 15 words; not
    'conflict'; hit when any predicted aspect is a substring of the gold aspect."""
    asp = F.when(F.size("aspect") == 0, F.array(F.lit(S.NO_ASPECT))).otherwise(F.col("aspect"))
    pol = F.when(F.size("aspect") == 0, F.array(F.lit(S.POSITIVE))).otherwise(F.col("polarity"))
    words = F.size(F.split(F.trim(F.regexp_replace("review_text", r"\s+", " ")), " "))
    d = base.withColumn("_a", asp).withColumn("_p", pol)
    d = d.filter((F.size("_a") == 1) & (words <= S.EVAL_ASPECT_MAX_WORDS) & (F.get("_p", 0) != S.CONFLICT))
    gold = F.get("_a", 0)
    hit = F.exists("aspects", lambda p: F.coalesce(F.instr(gold, F.coalesce(p, F.lit("None"))) > 0, F.lit(False)))
    return d.select("review_id", gold.alias("gold_aspect"), hit.alias("hit"))
