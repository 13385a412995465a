"""End-to-end prediction.

``predict(reviews, model)`` is DataFrame in, DataFrame out: one row per finding (long
form) or one row per review (flat form).  Findings come from Arrow batches of reviews
(``batches.extract``), which also sum the log-odds of the words of each window that are in the
broadcast head of the vocabulary; only other words are joined to the vocabulary, by the number
of their finding.  ``predict_long`` on its own and other scorers take the in-row path
(``inrow.extract``).  With a token table of another annotator, the relational rules run
on it and windows are scored from per-token running sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage
from . import annotate as A
from . import batches as B
from . import inrow as I
from . import polarity as P
from . import rules as R

K = A.SENT_KEYS
Scorer = Callable[[DataFrame], DataFrame]


def reject_reviews(reviews: DataFrame, id_col: str = "review_id",
                   text_col: str = "review_text") -> DataFrame:
    """Reviews that cannot yield a prediction, with a reason (null or blank text)."""
    t = F.col(text_col)
    reason = (F.when(t.isNull(), F.lit("null_text"))
               .when(~t.rlike(r"\S"), F.lit("blank_text")))
    return (reviews.select(F.col(id_col).alias("review_id"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def span_scores(found: DataFrame, prior: F.Column, threshold: float) -> DataFrame:
    """Score each span [win_left, win_right) = prior + sum of token log-odds."""
    nonempty = F.col("win_right") > F.col("win_left")
    span_sum = F.when(nonempty, F.col("r_cum_lo") - F.col("l_cum_lo") + F.col("l_lo")).otherwise(F.lit(0.0))
    label, prob, sentiment = P.probability_columns(prior + span_sum, threshold)
    return (found.withColumn("sentiment", sentiment).withColumn("sentiment_prob", prob)
                 .drop("l_lo", "l_cum_lo", "r_lo", "r_cum_lo"))


def window_scores(found: DataFrame, model: P.NaiveBayesModel, threshold: float) -> DataFrame:
    """Score each window = prior + sum of the log-odds of its words (``win_words``)."""
    keys = [c for c in found.columns if c != "win_words"]
    # a word travels with the number of its finding alone: with the finding's texts, a sentence
    # would be copied once per word of its own
    found = cut_lineage(found.withColumn("_n", F.monotonically_increasing_id()))
    words = found.select("_n", F.explode_outer("win_words").alias("_w"))
    sums = P.with_log_odds(words, model, F.col("_w")).groupBy("_n").agg(F.sum("lo").alias("_s"))
    out = found.select("_n", *keys).join(sums, "_n").groupBy(*keys).agg(F.sum("_s").alias("_s"))
    label, prob, sentiment = P.probability_columns(model.prior() + F.col("_s"), threshold)
    return out.select(*keys, sentiment.alias("sentiment"), prob.alias("sentiment_prob"))


def batch_scores(found: DataFrame, model: P.NaiveBayesModel, threshold: float, tail: DataFrame | None, repeated: bool) -> DataFrame:
    """Score each window from ``win_lo`` (``batches.extract``) and, with a ``tail`` of the vocabulary,
    the words of ``win_rest``.  Windows of reviews whose ids come more than once (``repeated``) that
    are equal in every column are one."""
    keys = [c for c in found.columns if c not in ("win_lo", "win_rest")]
    score = F.col("win_lo")
    if tail is not None:
        found = cut_lineage(found.withColumn("_n", F.monotonically_increasing_id()))
        rest = found.select("_n", F.explode("win_rest").alias("word")).join(tail, "word")
        found = found.join(rest.groupBy("_n").agg(F.sum("lo").alias("_rest")), "_n", "left")
        score = score + F.coalesce("_rest", F.lit(0.0))
    found = found.select(*keys, score.alias("_s"))
    if repeated:
        found = found.groupBy(*keys).agg(F.sum("_s").alias("_s"))
    label, prob, sentiment = P.probability_columns(model.prior() + F.col("_s"), threshold)
    return found.select(*keys, sentiment.alias("sentiment"), prob.alias("sentiment_prob"))


def predict_batches(reviews: DataFrame, model: P.NaiveBayesModel, window: int = S.WINDOW_MAIN, threshold: float = S.NEUTRAL_THRESHOLD,
                    compat_rule_ids: bool = False, keep_duplicates: bool = False) -> DataFrame:
    """The rows of ``predict_long``, over Arrow batches of (review_id, review_text)."""
    once, again = A.by_repeats(reviews)
    head, tail = P.frequent_words(model)
    odds = B.Odds(head)
    parts = [batch_scores(B.extract(r, window, compat_rule_ids, keep_duplicates, odds, tail is not None), model, threshold, tail, repeated)
             for r, repeated in ((once, False), (again, True)) if r is not None]
    return parts[0] if again is None else parts[0].unionByName(parts[1])


def predict_long(reviews: DataFrame, model: P.NaiveBayesModel, window: int = S.WINDOW_MAIN,
                 threshold: float = S.NEUTRAL_THRESHOLD, compat_rule_ids: bool = False,
                 keep_duplicates: bool = False, tokens: DataFrame | None = None,
                 sentences: DataFrame | None = None, scorer: Scorer | None = None) -> DataFrame:
    """E1/E3 long form: one row per finding (plus one all-null row per sentence without
    a finding) with sentiment and its probability.  ``scorer`` replaces the naive Bayes
    score: it gets each distinct window text once."""
    if sentences is None:
        sentences = A.split_sentences(A.spread(reviews), assume_partitioned=True)
    if scorer is not None:
        if tokens is None:
            found = I.extract(sentences, window, compat_rule_ids, keep_duplicates)
        else:
            found = R.extract_aspects(sentences, tokens, window, compat_rule_ids, keep_duplicates,
                                      span_tokens=tokens.select(*K, "i", "idx", "text"))
        texts = found.select(F.col("aspect_sentence").alias("text")).distinct()
        scored = scorer(texts).select(F.col("text").alias("_text"), "label", F.col("prob").alias("sentiment_prob"))
        return (found.join(scored, found["aspect_sentence"] == scored["_text"], "left").drop("_text")
                .withColumn("sentiment", P.neutral_threshold(F.col("label"), F.col("sentiment_prob"), threshold)).drop("label"))
    if tokens is None:
        return window_scores(I.extract(sentences, window, compat_rule_ids, keep_duplicates, with_words=True), model, threshold)
    scored = P.token_scores(tokens.select(*K, "i", "idx", "text"), model)
    found = R.extract_aspects(sentences, tokens, window, compat_rule_ids, keep_duplicates,
                              span_tokens=scored.select(*K, "i", "idx", "text", "lo", "cum_lo"))
    return span_scores(found, model.prior(), threshold)


def flatten(long_df: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """A2: one row per review with ordered aspect and polarity lists (emission order
    sent_id, rule_no, ord_i).  The list is per review, bounded by the review's length."""
    g = (long_df.groupBy("review_id")
         .agg(F.array_sort(F.collect_list(F.struct("sent_id", "rule_no", "ord_i", "aspect",
                                                   "sentiment"))).alias("_f")))
    out = g.select("review_id",
                   F.transform("_f", lambda x: x["aspect"]).alias("aspects"),
                   F.transform("_f", lambda x: x["sentiment"]).alias("polarity"))
    if reviews is not None:
        out = out.join(reviews.select("review_id", F.col("review_text").alias("review")), "review_id")
    return out


def predict(reviews: DataFrame, model: P.NaiveBayesModel, flat: bool = False,
            include_text: bool = False, tokens: DataFrame | None = None, scorer: Scorer | None = None,
            aux=None, **kw) -> DataFrame:
    """Batch prediction, long or flat.  ``reviews`` has review_id, review_text; null and
    blank texts give no row (``reject_reviews`` lists them).

    * ``tokens``: a token table of another annotator (SENT_KEYS, i, idx, text, lemma, pos,
      tag, dep, head_i, is_stop); ``sent_id`` and ``idx`` refer to ``split_sentences``.
    * ``scorer``: a function from a DataFrame with a ``text`` column to (text, label, prob),
      for example ``lr_scorer``; default: the naive Bayes model.
    * ``aux``: a tagger for the auxiliary path (a fitted pipeline or a function, see
      ``tagger.predict_aux``); adds aspects_aux, polarity_aux, polarity_prob_aux per review.
    * ``include_text`` adds the review text as column ``review`` (a join back to the
      reviews on review_id); it is off by default because it re-reads the text."""
    good = reviews.filter(F.col("review_text").rlike(r"\S"))
    if tokens is None and scorer is None:
        prepared = good.select("review_id", "review_text")
        out = predict_batches(prepared, model, **kw)
    else:
        prepared = A.spread(good) if tokens is None else A.prepare_reviews(good)
        sentences = A.split_sentences(prepared, assume_partitioned=True)
        out = predict_long(prepared, model, sentences=sentences, tokens=tokens, scorer=scorer, **kw)
    if flat:
        out = flatten(out)
    if aux is not None:
        from .tagger import predict_aux
        parts = None if tokens is None else (sentences, tokens)
        out = out.join(predict_aux(prepared, aux, model, parts=parts), "review_id", "left")
    if include_text:
        out = out.join(prepared.select("review_id", F.col("review_text").alias("review")), "review_id")
    return out


def lr_scorer(pipeline) -> Scorer:
    """A scorer for ``predict`` from a fitted ``polarity.lr_train`` pipeline."""
    return lambda texts: P.lr_score(pipeline, texts, key_col="text", text_col="text")
