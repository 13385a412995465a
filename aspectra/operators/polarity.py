"""Polarity: labelling, training-set preparation, naive Bayes and MLlib models
(P2-P5, P13, W2, A1, M1-M3, L3)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX
from ..session import cut_lineage
from . import batches as B
from .stats import histogram_quantiles, rank_within_groups

# The most frequent words, up to this many bytes, are broadcast to the token join; tokens
# not among them are joined by a shuffle on the word (none of those words is frequent).
HEAD_BYTES = 32 << 20


# ---------------------------------------------------------------------------------------
# P2 / P13
# ---------------------------------------------------------------------------------------
def rating_to_polarity(rating: Column, lo: float = S.RATING_MIN, hi: float = S.RATING_MAX) -> Column:
    """Lo < v < hi neutral, v <= lo negative, v >= hi positive; null/NaN -> null."""
    v = rating.cast("double")
    return (F.when(v.isNull() | F.isnan(v), F.lit(None).cast("string"))
             .when((v > lo) & (v < hi), S.NEUTRAL)
             .when(v <= lo, S.NEGATIVE)
             .when(v >= hi, S.POSITIVE))


def neutral_threshold(label: Column, prob: Column, threshold: float = S.NEUTRAL_THRESHOLD) -> Column:
    """Keep the label when prob >= threshold (inclusive), else 'neutral'."""
    return F.when(prob >= threshold, label).otherwise(F.lit(S.NEUTRAL))


# ---------------------------------------------------------------------------------------
# P5 / A1 length filter, W2 balance, M1 training set
# ---------------------------------------------------------------------------------------
def length_iqr_filter(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """P5: keep rows whose whitespace word count is strictly between the 25 % and 75 %
    quantiles (linear interpolation) taken over all rows of ``df``."""
    S.require_columns(df, [text_col], "length_iqr_filter")
    return _between_quartiles(df.withColumn("_wc", TX.word_count(F.col(text_col))))


def _between_quartiles(x: DataFrame) -> DataFrame:
    """The rows of ``x`` whose ``_wc`` is between the quartiles, without that column."""
    # two numbers from a histogram of word counts (bounded by the longest text)
    q = histogram_quantiles(x, "_wc", [0.25, 0.75], names=["q1", "q3"]).first()
    if q is None or q["q1"] is None:
        return x.filter(F.lit(False)).drop("_wc")
    return x.filter((F.col("_wc") > F.lit(q["q1"])) & (F.col("_wc") < F.lit(q["q3"]))).drop("_wc")


def balance_binary(df: DataFrame, label_col: str = "polarity", order_col: str = "review_id",
                   labels=(S.POSITIVE, S.NEGATIVE)) -> DataFrame:
    """Cut the larger of the two classes to the size of the smaller one, keeping its
    first rows by ``order_col`` (a unique id).  Only the keys are ranked, with a
    range-partitioned sort; the last key kept of each class is the cut-off by which the
    rows themselves are filtered, so no text is shuffled."""
    S.require_columns(df, [label_col, order_col], "balance_binary")
    d = df.filter(F.col(label_col).isin(*labels))
    ranked, sizes = rank_within_groups(d.select(label_col, order_col), [label_col], [order_col],
                                       rank_col="_rn", with_sizes=True)
    # one size per class (a tiny table); a missing class means the smaller class has 0 rows
    got = {r[label_col]: r["group_size"] for r in sizes.collect()}
    k = min(got.values()) if len(got) == len(labels) else 0
    last = {r[label_col]: r[order_col] for r in ranked.filter(F.col("_rn") == k).collect()}
    keep = F.lit(False)
    for label, key in last.items():
        keep = keep | ((F.col(label_col) == label) & (F.col(order_col) <= F.lit(key)))
    return d.filter(keep)


def load_labelled_reviews(reviews: DataFrame, text_col: str = "review_text",
                          label_col: str = "polarity") -> DataFrame:
    """S7 + P4 + P3: drop null text, keep positive/negative rows."""
    return (reviews.filter(F.col(text_col).isNotNull())
            .filter(F.col(label_col).isin(S.POSITIVE, S.NEGATIVE)))


def polarity_training_set(reviews: DataFrame, text_col: str = "review_text",
                          label_col: str = "polarity", order_col: str = "review_id",
                          materialize: bool = True) -> DataFrame:
    """M1: drop null text -> IQR length filter (over all polarities) -> keep
    positive/negative -> balance.

    The input (typically a join of texts and labels) is read by three passes (length
    histogram, range sampling, ranked checkpoint); with ``materialize`` it is
    checkpointed once so those passes do not re-run the join."""
    x = reviews.filter(F.col(text_col).isNotNull()).withColumn("_wc", TX.word_count(F.col(text_col)))
    if materialize:
        x = cut_lineage(x)      # with the word counts, which every pass reads
    x = _between_quartiles(x)
    x = x.filter(F.col(label_col).isin(S.POSITIVE, S.NEGATIVE))
    return balance_binary(x, label_col, order_col)


# ---------------------------------------------------------------------------------------
# M2 / M3 naive Bayes (pure SQL model)
# ---------------------------------------------------------------------------------------
@dataclass
class NaiveBayesModel:
    """``vocab``: word, n_pos, n_neg, lo.  ``prior_lo``: log prior odds (a number)."""
    vocab: DataFrame
    prior_lo: float

    def words(self) -> DataFrame:
        return self.vocab.select(F.col("word"), F.col("lo"))

    def prior(self) -> Column:
        return F.lit(self.prior_lo).cast("double")


def words_of(text: Column) -> Column:
    """Lower-cased tokens of the cleaned text (same tokenizer as the token table)."""
    m = TX.token_matches(TX.clean_text(text))
    return F.transform(m, lambda x: F.lower(F.trim(F.replace(x, F.lit(TX.NT_MARK), F.lit("")))))


def nb_train(train: DataFrame, text_col: str = "review_text", label_col: str = "polarity",
             materialize: bool = True) -> NaiveBayesModel:
    """M2 (b): multinomial naive Bayes with add-one smoothing as aggregates.

    lo(w) = ln((n(w,pos)+1)/(N(pos)+V)) - ln((n(w,neg)+1)/(N(neg)+V)); prior = ln(D_pos/D_neg).
    """
    S.require_columns(train, [text_col, label_col], "nb_train")
    t = train.filter(F.col(label_col).isin(S.POSITIVE, S.NEGATIVE)).select(
        (F.col(label_col) == S.POSITIVE).alias("_pos"), F.col(text_col).alias("_text"))
    counts = B.word_counts(t).groupBy("word").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
    if materialize:
        counts = cut_lineage(counts)  # one pass over the training text; totals read it back
    # three numbers (token totals per class, vocabulary size) read from the counts
    tot = counts.agg(F.sum("n_pos").alias("tp"), F.sum("n_neg").alias("tn"), F.count(F.lit(1)).alias("v")).first()
    tp, tn, v = (tot["tp"] or 0), (tot["tn"] or 0), tot["v"]
    vocab = (counts.withColumn("lo", F.log((F.col("n_pos") + 1) / F.lit(float(tp + v)))
                               - F.log((F.col("n_neg") + 1) / F.lit(float(tn + v))))
             .select("word", "n_pos", "n_neg", "lo"))
    docs = train.agg(F.sum((F.col(label_col) == S.POSITIVE).cast("long")).alias("d_pos"),
                     F.sum((F.col(label_col) == S.NEGATIVE).cast("long")).alias("d_neg")).first()
    d_pos, d_neg = docs["d_pos"] or 0, docs["d_neg"] or 0
    if not d_pos or not d_neg:
        raise ValueError("nb_train needs positive and negative reviews")
    return NaiveBayesModel(vocab, math.log(d_pos / d_neg))


def frequent_words(model: NaiveBayesModel, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(head, tail): word and lo of the words above a frequency, within ``max_bytes`` (so
    the head may be broadcast), and of the others (None if there are none)."""
    max_bytes = HEAD_BYTES if max_bytes is None else max_bytes
    n = F.col("n_pos") + F.col("n_neg")
    # bytes by power of two of the frequency: at most 64 rows
    sizes = (model.vocab.groupBy(F.floor(F.log2(n.cast("double"))).cast("int").alias("k"))
             .agg(F.sum(F.octet_length("word") + 24).alias("b")).orderBy(F.desc("k")).collect())
    floor, total = None, 0
    for r in sizes:
        total += r["b"]
        if total > max_bytes:
            break
        floor = r["k"]
    words = model.vocab.select("word", "lo", n.alias("_n"))
    if total <= max_bytes:
        return words.select("word", "lo"), None
    least = F.lit(2.0 ** floor if floor is not None else float("inf"))
    return (words.filter(F.col("_n") >= least).select("word", "lo"),
            words.filter(F.col("_n") < least).select("word", "lo"))


def with_log_odds(rows: DataFrame, model: NaiveBayesModel, word: Column, max_bytes: int | None = None,
                  parts: tuple[DataFrame, DataFrame | None] | None = None) -> DataFrame:
    """``rows`` plus ``lo`` of their word (0 for unknown words and null).  Frequent words
    are settled on the map side; only rows with other words are shuffled by the word.
    ``parts``: the result of ``frequent_words`` if it is known already."""
    head, tail = parts or frequent_words(model, max_bytes)
    r = rows.withColumn("_word", word)
    j = r.join(F.broadcast(head.withColumnRenamed("word", "_word")), "_word", "left")
    if tail is not None:
        known = F.col("lo").isNotNull() | F.col("_word").isNull()
        rest = j.filter(~known).drop("lo").join(tail.withColumnRenamed("word", "_word"), "_word", "left")
        j = j.filter(known).unionByName(rest)
    return j.withColumn("lo", F.coalesce("lo", F.lit(0.0))).drop("_word")


def probability_columns(score: Column, threshold: float | None = S.NEUTRAL_THRESHOLD):
    """(label, prob, sentiment) from a log-odds score."""
    p = 1.0 / (1.0 + F.exp(-score))
    label = F.when(p >= 0.5, F.lit(S.POSITIVE)).otherwise(F.lit(S.NEGATIVE))
    prob = F.greatest(p, 1.0 - p)
    sentiment = neutral_threshold(label, prob, threshold) if threshold is not None else label
    return label, prob, sentiment


def token_scores(tokens: DataFrame, model: NaiveBayesModel) -> DataFrame:
    """Token table + ``lo`` (0 for unknown words) + ``cum_lo`` (running sum in the
    sentence) so that any token span [l, r) scores as cum(r-1) - cum(l) + lo(l)."""
    t = with_log_odds(tokens, model, F.lower("text"))
    w = Window.partitionBy("review_id", "sent_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("cum_lo", F.sum("lo").over(w))


def polarity_score(docs: DataFrame, model: NaiveBayesModel, key_col: str = "review_id",
                   text_col: str = "review_text", threshold: float | None = None) -> DataFrame:
    """M3 (b): score whole texts: prior + sum of word log-odds -> score, label, prob.

    Null and blank texts get no prediction (``predict.reject_reviews`` lists them)."""
    docs = docs.filter(F.col(text_col).rlike(r"\S"))
    words = docs.select(key_col, F.explode_outer(words_of(F.col(text_col))).alias("word"))
    s = (with_log_odds(words, model, F.col("word"))
         .groupBy(key_col).agg((model.prior() + F.sum("lo")).alias("score")))
    label, prob, sentiment = probability_columns(F.col("score"), threshold)
    out = s.select(key_col, "score", label.alias("label"), prob.alias("prob"))
    if threshold is not None:
        out = out.withColumn("sentiment", neutral_threshold(F.col("label"), F.col("prob"), threshold))
    return out


# ---------------------------------------------------------------------------------------
# M2 (a) / M3 (a): MLlib pipeline
# ---------------------------------------------------------------------------------------
def lr_train(train: DataFrame, text_col: str = "review_text", label_col: str = "polarity",
             num_features: int = 1 << 18, max_iter: int = 50):
    """Distributed logistic regression on hashed TF-IDF of the cleaned text."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer

    d = train.filter(F.col(label_col).isin(S.POSITIVE, S.NEGATIVE)).withColumn(
        "_clean", TX.clean_text(F.col(text_col)))
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc",
                      handleInvalid="error"),
        RegexTokenizer(inputCol="_clean", outputCol="_tok", pattern="\\s+"),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(maxIter=max_iter, regParam=0.01),
    ])
    return pipe.fit(d)


def lr_score(model, docs: DataFrame, key_col: str = "review_id", text_col: str = "review_text",
             threshold: float | None = None) -> DataFrame:
    """Score with a fitted pipeline: argmax label + its probability (vector_to_array)."""
    from pyspark.ml.functions import vector_to_array
    labels = model.stages[0].labels
    d = docs.withColumn("_clean", TX.clean_text(F.col(text_col)))
    if "polarity" in d.columns:
        d = d.drop("polarity")
    p = model.transform(d.withColumn("polarity", F.lit(labels[0])))
    arr = vector_to_array(F.col("probability"))
    names = F.array(*[F.lit(x) for x in labels])
    # L3: class probabilities sorted descending; the first one is the prediction
    probs = F.sort_array(F.arrays_zip(arr.alias("prob"), names.alias("label")), asc=False)
    out = p.select(key_col, F.get(probs, 0)["prob"].alias("prob"), F.get(probs, 0)["label"].alias("label"))
    if threshold is not None:
        out = out.withColumn("sentiment", neutral_threshold(F.col("label"), F.col("prob"), threshold))
    return out
