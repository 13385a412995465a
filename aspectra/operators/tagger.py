"""Token tagger (M4-M7, E2): word-level features, a distributed multinomial logistic
regression over hashed features, tagging and span decoding, and the auxiliary
prediction path."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import text_partitions
from . import annotate as A
from . import batches as B
from . import polarity as P
from . import predict as PR
from . import spans as SP

FEATURE_COLS = ["lower", "prev1", "prev2", "next1", "next2", "suffix3", "shape", "kind"]


def token_features(tok: DataFrame, key_cols: list[str], word_col: str = "word") -> DataFrame:
    """M5: per word ``lag/lead(+-2)`` words, 3-letter suffix, shape and light POS kind
    (word-level rows need no sub-word alignment)."""
    w = Window.partitionBy(*key_cols).orderBy("i")
    low = F.lower(F.col(word_col))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(word_col), "[A-Z]", "X"),
                                              "[a-z]", "x"), "[0-9]", "d")
    return (tok.withColumn("lower", low)
            .withColumn("prev1", F.coalesce(F.lag(low, 1).over(w), F.lit("<s>")))
            .withColumn("prev2", F.coalesce(F.lag(low, 2).over(w), F.lit("<s>")))
            .withColumn("next1", F.coalesce(F.lead(low, 1).over(w), F.lit("</s>")))
            .withColumn("next2", F.coalesce(F.lead(low, 2).over(w), F.lit("</s>")))
            .withColumn("suffix3", F.substring(low, -3, 3))
            .withColumn("shape", shape)
            .withColumn("kind", A.token_kind(F.col(word_col))))


def tagger_train(features: DataFrame, label_col: str = "gold", num_features: int = 1 << 18):
    """M6: FeatureHasher + multinomial logistic regression (3 classes O/B/I)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import FeatureHasher, StringIndexer
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        FeatureHasher(inputCols=FEATURE_COLS, outputCol="features", numFeatures=num_features),
        LogisticRegression(maxIter=30, regParam=0.01, family="multinomial"),
    ])
    return pipe.fit(features)


def tagger_predict(model, features: DataFrame) -> DataFrame:
    """M7: tag every word; ``tag_pred`` in {O, B, I}."""
    labels = model.stages[0].labels
    names = F.array(*[F.lit(x) for x in labels])
    f = features
    if "gold" not in f.columns:
        f = f.withColumn("gold", F.lit(labels[0]))
    p = model.transform(f)
    return p.withColumn("tag_pred", F.get(names, F.col("prediction").cast("int"))).drop(
        "label", "features", "rawPrediction", "probability", "prediction")


# ---------------------------------------------------------------------------------------
# tags, spans and windows over Arrow batches of reviews
# ---------------------------------------------------------------------------------------
def murmur3(strings: list[bytes], seed: int = 42) -> np.ndarray:
    """The signed 32-bit hashes of ``FeatureHasher``, all strings of one length together."""
    out, lengths = np.empty(len(strings), dtype=np.uint32), np.array([len(s) for s in strings], dtype=np.int64)
    u = np.uint32

    def mixed(k):
        k = k * u(0xCC9E2D51)
        return (k << u(15) | k >> u(17)) * u(0x1B873593)

    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        x = np.frombuffer(b"".join([strings[i] for i in at.tolist()]), dtype=np.uint8).reshape(len(at), n)
        h, whole = np.full(len(at), seed, dtype=np.uint32), n // 4 * 4
        words = np.ascontiguousarray(x[:, :whole]).view("<u4")
        for j in range(whole // 4):
            h ^= mixed(words[:, j])
            h = (h << u(13) | h >> u(19)) * u(5) + u(0xE6546B64)
        if n > whole:
            k = np.zeros(len(at), dtype=np.uint32)
            for j in range(n - whole):
                k |= x[:, whole + j].astype(np.uint32) << u(8 * j)
            h ^= mixed(k)
        h ^= u(n)
        h = (h ^ h >> u(16)) * u(0x85EBCA6B)
        h = (h ^ h >> u(13)) * u(0xC2B2AE35)
        out[at] = h ^ h >> u(16)
    return out.view(np.int32)


_SHAPE = str.maketrans({chr(c): "X" if c < 91 and c > 64 else "x" if c > 96 else "d"
                        for c in [*range(48, 58), *range(65, 91), *range(97, 123)]})


class LinearTagger:
    """The fitted pipeline of ``tagger_train`` for Python workers.  The score of a tag is a sum over
    the hashed features of a word, each of which depends on one word: per distinct word the
    parts are looked up once, and added up along the sentence."""

    def __init__(self, labels: list[str], weights: np.ndarray, intercept: np.ndarray):
        self.labels, self.weights, self.intercept = labels, weights, intercept

    @staticmethod
    def of(model) -> LinearTagger | None:
        """None for other pipelines."""
        from pyspark.ml.classification import LogisticRegressionModel
        from pyspark.ml.feature import FeatureHasher, StringIndexerModel
        kinds = (StringIndexerModel, FeatureHasher, LogisticRegressionModel)
        stages = getattr(model, "stages", [])
        if len(stages) != len(kinds) or not all(map(isinstance, stages, kinds)):
            return None
        index, hasher, lr = stages
        if hasher.getInputCols() != FEATURE_COLS or hasher.isDefined(hasher.categoricalCols) or lr.isDefined(lr.thresholds):
            return None
        if lr.coefficientMatrix.numRows != lr.numClasses or lr.coefficientMatrix.numCols != hasher.getNumFeatures():
            return None
        return LinearTagger(list(index.labels), np.ascontiguousarray(lr.coefficientMatrix.toArray().T), lr.interceptVector.toArray())

    def _parts(self, column: str, values: list[str]) -> np.ndarray:
        return self.weights[murmur3([f"{column}={v}".encode() for v in values]) % len(self.weights)]

    def tags(self, w: B.Words) -> np.ndarray:
        """Per token the number of its label (as many as labels or more: none)."""
        numbers = {x: j for j, x in enumerate(dict.fromkeys(w.low))}
        lows, of = list(numbers), np.array([numbers[x] for x in w.low], dtype=np.int64)
        ends = [*lows, "<s>", "</s>"]
        own = (self._parts("lower", lows) + self._parts("suffix3", [x[-3:] for x in lows]))[of]
        own = own + self._parts("shape", [x.translate(_SHAPE) for x in w.vocab]) + self._parts("kind", B.KINDS)[w.kind]
        low, at = of[w.code], np.arange(len(w.code))
        scores = own[w.code] + self.intercept
        left = w.n[w.sent] - 1 - w.i             # tokens after it in its sentence
        for column, step in (("prev1", -1), ("prev2", -2), ("next1", 1), ("next2", 2)):
            inside = w.i + step >= 0 if step < 0 else left >= step
            there = np.full(len(at), len(lows) + (step > 0), dtype=np.int64)
            there[inside] = low[at[inside] + step]
            scores += self._parts(column, ends)[there]
        return scores.argmax(axis=1) if len(scores) else np.empty(0, dtype=np.int64)


def _spans(tagged: np.ndarray, inner: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of every span; ``inner`` tokens extend the one right before."""
    before = np.r_[False, tagged[:-1] & (group[1:] == group[:-1])][:len(tagged)]
    first = tagged & ~(inner & before)
    starts = np.flatnonzero(first)
    return starts, np.bincount(np.cumsum(first)[tagged] - 1, minlength=len(starts))


def _texts(w: B.Words, starts: np.ndarray, lengths: np.ndarray) -> list[str]:
    return [" ".join([w.vocab[c] for c in w.code[a:a + n].tolist()]) for a, n in zip(starts.tolist(), lengths.tolist())]


def _by_labels(labels: list[str], tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tagged, inner) of tokens."""
    tagged = np.isin(tags, [j for j, x in enumerate(labels) if x != "O"])
    return tagged, tags == (labels.index("I") if "I" in labels else -1)


def tag_spans(reviews: DataFrame, tagger: LinearTagger) -> DataFrame:
    """M7 + W4 from (review_id, review_text): the rows of ``spans.bio_decode`` by sentence."""
    shared = reviews.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        for b in B.chunks(batches):
            w, t = B.Words(b.column(1).to_pylist()), shared.value
            starts, lengths = _spans(*_by_labels(t.labels, t.tags(w)), w.sent)
            sent = w.sent[starts]
            number = np.arange(len(sent)) - np.searchsorted(sent, sent) + 1
            yield from B.rows_out([b.column(0).take(pa.array(w.rev[sent])), pa.array(w.sent_id[sent]), pa.array(number),
                                   pa.array(w.i[starts]), pa.array(_texts(w, starts, lengths), pa.string())],
                                  ["review_id", "sent_id", "span_no", "first_i", "aspect"])

    return B.map_reviews(reviews.select(*B.INPUT), run, "sent_id int, span_no long, first_i int, aspect string")


def review_spans(reviews: DataFrame, model) -> DataFrame:
    """The tagged spans of all sentences.  Reviews whose ids repeat or are null, and other pipelines
    than that of ``tagger_train``, take the relational operators."""
    linear, once, again = LinearTagger.of(model), None, reviews
    if linear is not None:
        once, again = A.by_repeats(reviews)
    parts = [] if linear is None else [tag_spans(once, linear)]
    if again is not None:
        words = A.annotate_corpus(again, materialize=False)[2].select(*A.SENT_KEYS, "i", F.col("text").alias("word"))
        pred = tagger_predict(model, token_features(words, A.SENT_KEYS))
        parts.append(SP.bio_decode(pred, A.SENT_KEYS, "tag_pred", "word", "i"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _given_tags(w: B.Words, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tagged, inner) of tokens from per review (sent_id, i, whether inner) of its tagged words."""
    tagged, inner = np.zeros(len(w.code), dtype=bool), np.zeros(len(w.code), dtype=bool)
    rev = column.value_parent_indices().to_numpy() if len(column) else np.empty(0, dtype=np.int64)
    sent_id, i, x = (v.to_numpy(zero_copy_only=False) for v in column.flatten().flatten())
    if len(rev):
        base = int(max(w.sent_id.max(initial=0), sent_id.max())) + 1
        at = w.first[np.searchsorted(w.rev * base + w.sent_id, rev * base + sent_id)] + i
        tagged[at], inner[at[x.astype(bool)]] = True, True
    return tagged, inner


def _running_spans(values: np.ndarray, first: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``values[lo:hi]`` from the running sums of each review, as ``_aux_of_tokens`` takes them."""
    run = np.zeros(len(values) + 1)
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(values)]):
        run[a:z] = values[a:z].cumsum()
    values = np.r_[values, 0.0]
    return np.where(hi > lo, run[np.maximum(hi, 1) - 1] - run[lo] + values[lo], 0.0)


def _aux_rows(reviews: DataFrame, tagger: LinearTagger | None, odds: B.Odds, window: int, with_rest: bool) -> DataFrame:
    """Per review its spans (or one 'None'): review_id, pos, aspect and, as ``batches.extract``,
    win_lo and win_rest.  Without a ``tagger`` the column ``tags`` holds (sent_id, i, whether inner)."""
    spark = reviews.sparkSession
    shared = spark.sparkContext.broadcast((tagger, odds))
    inputs = [*B.INPUT, *([] if tagger is not None else ["tags"])]

    def run(batches):
        for b in B.chunks(batches):
            w, (t, known_odds) = B.Words(b.column(1).to_pylist()), shared.value
            rev = w.rev[w.sent]
            starts, lengths = _spans(*(_by_labels(t.labels, t.tags(w)) if t is not None else _given_tags(w, b.column(2))), rev)
            n_words = np.bincount(rev, minlength=b.num_rows)
            first = np.r_[0, np.cumsum(n_words)][:-1]
            own = rev[starts]
            pos = starts - first[own]
            left, right = B.bounds(pos, own, n_words[own], window)
            # reviews with sentences, but without a span: the whole review
            none = np.setdiff1d(w.rev, own)
            zero = np.zeros(len(none), dtype=np.int64)
            who, left, right = np.r_[own, none], np.r_[left, zero], np.r_[right, n_words[none]]
            a, z = first[who] + left, first[who] + right
            lo, known = known_odds.of(w.low)
            columns = [b.column(0).take(pa.array(who)), pa.array(np.r_[pos, zero].astype(np.int32)),
                       pa.array([*_texts(w, starts, lengths), *[S.NO_ASPECT] * len(none)], pa.string()),
                       pa.array(_running_spans(lo[w.code], first, a, z))]
            if with_rest:
                columns.append(B.unknown_words(w, known, a, z))
            yield from B.rows_out(columns, ["review_id", "pos", "aspect", "win_lo", *(["win_rest"] if with_rest else [])])

    return B.map_reviews(reviews.select(*inputs), run, "pos int, aspect string, win_lo double" + (", win_rest array<string>" if with_rest else ""))


def _with_tags(reviews: DataFrame, tagger) -> DataFrame:
    """``reviews`` with the ``tags`` that a function gives their words; only tagged words are gathered."""
    n = text_partitions(reviews)
    words = (B.sentence_words(reviews).repartition(n, "review_id")
             .select("review_id", "sent_id", F.posexplode("words").alias("i", "word")))
    tagged = tagger(words).filter(F.col("tag_pred") != "O").groupBy("review_id").agg(
        F.collect_list(F.struct("sent_id", "i", (F.col("tag_pred") == "I").alias("inner"))).alias("tags"))
    out = reviews.join(tagged, "review_id", "left")
    return out.withColumn("tags", F.coalesce("tags", F.array().cast(tagged.schema["tags"].dataType)))


def predict_aux(reviews: DataFrame, tagger, nb: P.NaiveBayesModel,
                window: int = S.WINDOW_AUX, threshold: float = S.NEUTRAL_THRESHOLD,
                parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Tagger aspects of each review (computed once per review), a text window of
    ``window`` tokens around each first word (same tokenization as the main path), and
    its polarity.  ``tagger`` is a fitted pipeline, or a function from words (review_id,
    sent_id, i, word) to the same rows with ``tag_pred``; ``parts`` are the sentences and
    tokens if they exist already.  No tagged word -> ['None'] with the whole review as window.

    From the review to its spans and windows this is one step over Arrow batches; reviews whose
    ids repeat or are null, given tokens and other pipelines take the relational operators."""
    linear = None if callable(tagger) else LinearTagger.of(tagger)
    if parts is not None or not (callable(tagger) or linear):
        return _aux_of_tokens(reviews, tagger, nb, window, threshold, parts)
    once, again = A.by_repeats(reviews.select(*B.INPUT))
    head, tail = P.frequent_words(nb)
    rows = _aux_rows(once if linear else _with_tags(once, tagger), linear, B.Odds(head), window, tail is not None)
    scored = PR.batch_scores(rows, nb, threshold, tail, repeated=False)
    out = _aux_lists(scored.withColumnsRenamed({"sentiment": "polarity_aux", "sentiment_prob": "polarity_prob_aux"}))
    return out if again is None else out.unionByName(_aux_of_tokens(again, tagger, nb, window, threshold))


def _aux_lists(spans: DataFrame) -> DataFrame:
    g = spans.groupBy("review_id").agg(F.array_sort(F.collect_list(
        F.struct("pos", "aspect", "polarity_aux", "polarity_prob_aux"))).alias("_a"))
    return g.select("review_id", F.transform("_a", lambda x: x["aspect"]).alias("aspects_aux"),
                    F.transform("_a", lambda x: x["polarity_aux"]).alias("polarity_aux"),
                    F.transform("_a", lambda x: x["polarity_prob_aux"]).alias("polarity_prob_aux"))


def _aux_of_tokens(reviews: DataFrame, tagger, nb: P.NaiveBayesModel, window: int, threshold: float,
                   parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``predict_aux`` over sentence and token tables."""
    sentences, tokens = parts or A.word_corpus(reviews)
    # review-level word positions: offset of each sentence's first token
    ws = Window.partitionBy("review_id").orderBy("sent_id")
    off = sentences.select("review_id", "sent_id", "n_tokens").withColumn(
        "_off", F.coalesce(F.sum("n_tokens").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    words = tokens.select("review_id", "sent_id", "i", F.col("text").alias("word"))
    pred = tagger(words) if callable(tagger) else tagger_predict(tagger, token_features(words, ["review_id", "sent_id"]))
    pred = pred.join(off.select("review_id", "sent_id", "_off"), ["review_id", "sent_id"]).withColumn(
        "ri", (F.col("i") + F.col("_off")).cast("int"))
    dec = SP.bio_decode(pred, ["review_id"], "tag_pred", "word", "ri")
    scored = P.with_log_odds(tokens.select("review_id", "sent_id", "i", "text"), nb, F.lower("text")).join(
        off.select("review_id", "sent_id", "_off"), ["review_id", "sent_id"]).withColumn(
        "ri", (F.col("i") + F.col("_off")).cast("int"))
    # review-level windows: positions are review word ids
    n_words = off.groupBy("review_id").agg(F.sum("n_tokens").cast("int").alias("n_words"))
    a = dec.select("review_id", F.lit(0).alias("sent_id"), F.col("first_i").alias("pos"), "aspect")
    a = a.join(n_words, "review_id")
    a = SP.add_window_bounds(a, window, pos_col="pos", ntok_col="n_words").drop("sent_id")
    none = (n_words.join(a.select("review_id").distinct(), "review_id", "left_anti")
            .select("review_id", F.lit(0).alias("pos"), F.lit(S.NO_ASPECT).alias("aspect"),
                    "n_words", F.lit(0).alias("win_left"), F.col("n_words").alias("win_right")))
    a = a.unionByName(none)
    cum = Window.partitionBy("review_id").orderBy("ri").rowsBetween(Window.unboundedPreceding, 0)
    sc = scored.withColumn("rcum", F.sum("lo").over(cum)).select("review_id", "ri", "lo", "rcum")
    L = sc.select("review_id", F.col("ri").alias("win_left"), F.col("lo").alias("l_lo"), F.col("rcum").alias("l_cum"))
    R = sc.select("review_id", (F.col("ri") + 1).alias("win_right"), F.col("rcum").alias("r_cum"))
    j = a.join(L, ["review_id", "win_left"], "left").join(R, ["review_id", "win_right"], "left")
    span = F.when(F.col("win_right") > F.col("win_left"), F.col("r_cum") - F.col("l_cum") + F.col("l_lo")).otherwise(0.0)
    j = j.withColumn("_score", nb.prior() + span)
    label, prob, sentiment = P.probability_columns(F.col("_score"), threshold)
    j = j.withColumn("polarity_aux", sentiment).withColumn("polarity_prob_aux", prob)
    return _aux_lists(j)
