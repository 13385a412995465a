"""Token spans: aspect text window (W1, L1) and BIO decoding to spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from . import annotate as A

K = A.SENT_KEYS


def bounds_from_neighbours(pos: Column, cnt: Column, prv: Column, nxt: Column, n_tok: Column,
                           n: int) -> tuple[Column, Column]:
    """[left, right) of the text window around the aspect at ``pos``.

    ``cnt`` = number of aspect positions of the sentence; ``prv`` / ``nxt`` = the list
    elements just before / after the first occurrence of ``pos`` in the sorted list
    (null at the ends).  One position -> whole sentence.  Right end: last -> N; else
    min(pos+n, N) if below the next position, else next-1.  Left end: first -> 0; else
    max(pos-n, 0) if above the previous position, else previous+1.  Python slice rules
    then apply (a negative end counts from the end; an end before the start gives an
    empty span).
    """
    r0 = F.least(pos + n, n_tok)
    right = (F.when(cnt == 1, n_tok).when(nxt.isNull(), n_tok)
             .when(r0 < nxt, r0).otherwise(nxt - 1))
    l0 = F.greatest(pos - n, F.lit(0))
    left = (F.when(cnt == 1, 0).when(prv.isNull(), 0)
            .when(l0 > prv, l0).otherwise(prv + 1))
    right = F.when(right < 0, right + n_tok).otherwise(right)
    right = F.least(n_tok, F.greatest(left, right))
    return left.cast("int"), right.cast("int")


def window_bounds(pos: Column, s: Column, n_tok: Column, n: int) -> tuple[Column, Column]:
    """W1 on an explicit sorted position array ``s`` (small inputs and tests)."""
    p = F.array_position(s, pos).cast("int")  # 1-based, first occurrence
    return bounds_from_neighbours(pos, F.size(s), F.get(s, p - 2), F.get(s, p), n_tok, n)


def add_window_bounds(df: DataFrame, n: int, keep_duplicates: bool = False,
                      pos_col: str = "aspect_i", ntok_col: str = "n_tokens") -> DataFrame:
    """W1 bounds for every row of ``df`` (rows with a null position get the whole
    sentence): ``win_left`` / ``win_right``.

    Relational form: the distinct positions of each sentence with their multiplicity,
    ``lag`` / ``lead`` for the neighbours and a partition count — no row ever holds the
    sentence's whole position list, so a sentence with many findings stays linear.
    Default: distinct positions; ``keep_duplicates`` reproduces the variant where one
    position listed twice (two rules, one aspect) is its own next neighbour.
    """
    pos = (df.filter(F.col(pos_col).isNotNull()).groupBy(*K, pos_col)
           .agg(F.count(F.lit(1)).alias("_dup")))
    w = Window.partitionBy(*K).orderBy(pos_col)
    weight = F.col("_dup") if keep_duplicates else F.lit(1)
    pos = (pos.withColumn("_prv", F.lag(pos_col).over(w))
              .withColumn("_nxt", F.lead(pos_col).over(w))
              .withColumn("_cnt", F.sum(weight).over(Window.partitionBy(*K))))
    if keep_duplicates:
        pos = pos.withColumn("_nxt", F.when(F.col("_dup") > 1, F.col(pos_col)).otherwise(F.col("_nxt")))
    d = df.join(pos, K + [pos_col], "left")
    left, right = bounds_from_neighbours(F.col(pos_col), F.col("_cnt"), F.col("_prv"), F.col("_nxt"),
                                         F.col(ntok_col), n)
    hit = F.col(pos_col).isNotNull()
    return (d.withColumn("win_left", F.when(hit, left).otherwise(F.lit(0)))
             .withColumn("win_right", F.when(hit, right).otherwise(F.col(ntok_col).cast("int")))
             .drop("_dup", "_prv", "_nxt", "_cnt"))


def aspect_bounds(aspects: DataFrame, sentences: DataFrame, n: int,
                  keep_duplicates: bool = False, pos_col: str = "aspect_i") -> DataFrame:
    """W1 bounds: add ``win_left`` / ``win_right`` (token positions, right exclusive)."""
    a = aspects.join(sentences.select(*K, "n_tokens"), K)
    return add_window_bounds(a, n, keep_duplicates, pos_col).drop("n_tokens")


def attach_span(spans: DataFrame, sentences: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add ``aspect_sentence`` = cleaned text of tokens [win_left, win_right).

    Every extra column of ``tokens`` (besides keys, i, idx, text) is carried for the
    first (``l_``) and last (``r_``) token of the span.  The tokens of each sentence are
    gathered once into an array ordered by position (bounded by the sentence length;
    a hash aggregate on the already-partitioned token table), so both span ends are
    array lookups after a single join on the sentence keys.
    """
    extra = [c for c in tokens.columns if c not in K + ["i", "idx", "text"]]
    fields = [F.col("i"), F.col("idx"), (F.col("idx") + F.length("text")).alias("end"), *[F.col(c) for c in extra]]
    arr = tokens.groupBy(*K).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_toks"))
    a = spans.join(sentences.select(*K, "sentence"), K).join(arr, K, "left")
    first = F.get(F.col("_toks"), F.col("win_left"))
    last = F.get(F.col("_toks"), F.col("win_right") - 1)
    text = F.when(F.col("win_right") > F.col("win_left"),
                  F.substring(F.col("sentence"), first["idx"] + 1, last["end"] - first["idx"])
                  ).otherwise(F.lit(""))
    a = a.withColumn("aspect_sentence", text)
    for c in extra:
        a = a.withColumn("l_" + c, first[c]).withColumn("r_" + c, last[c])
    return a.drop("sentence", "_toks")


def aspect_window(aspects: DataFrame, sentences: DataFrame, tokens: DataFrame, n: int,
                  keep_duplicates: bool = False, pos_col: str = "aspect_i") -> DataFrame:
    """Bounds + span text.  Findings in arrays (``rules.all_rules`` over arrays of tokens)
    have their sentence and tokens in their row."""
    if "found" in aspects.columns:
        from . import inrow as I
        return I.with_windows(aspects, n, keep_duplicates).filter(F.col(pos_col).isNotNull())
    b = aspect_bounds(aspects, sentences, n, keep_duplicates, pos_col)
    return attach_span(b, sentences, tokens)


# ---------------------------------------------------------------------------------------
# BIO decode
# ---------------------------------------------------------------------------------------
def bio_decode(tagged_words: DataFrame, key_cols=("review_id",), tag_col: str = "tag_pred",
               word_col: str = "text", pos_col: str = "i") -> DataFrame:
    """Gaps-and-islands over tagged words -> one row per decoded aspect span.

    Words tagged O are dropped.  An ``I`` directly after the previous tagged word
    extends that word's span; anything else starts a new span (an ``I`` with nothing to
    extend also starts one).  Output: keys, span_no, first_i, aspect.
    """
    keys = list(key_cols)
    ws = Window.partitionBy(*keys).orderBy(pos_col)
    t = (tagged_words.filter(F.col(tag_col) != "O")
         .withColumn("_prev", F.lag(pos_col).over(ws))
         .withColumn("_start", F.when((F.col(tag_col) == "I") & (F.col(pos_col) - F.col("_prev") == 1), 0)
                     .otherwise(1))
         .withColumn("span_no", F.sum("_start").over(ws.rowsBetween(Window.unboundedPreceding, 0))))
    g = (t.groupBy(*keys, "span_no")
         .agg(F.min(pos_col).cast("int").alias("first_i"),
              F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                   F.col(word_col).alias("w")))).alias("_ws")))
    return g.select(*keys, "span_no", "first_i",
                    F.array_join(F.transform("_ws", lambda x: x["w"]), " ").alias("aspect"))


def bio_decode_lists(decoded: DataFrame, keys_df: DataFrame, key_cols=("review_id",)) -> DataFrame:
    """Per key: ordered aspect list and first positions; ``['None']`` / ``[0]`` when none."""
    keys = list(key_cols)
    g = (decoded.groupBy(*keys)
         .agg(F.array_sort(F.collect_list(F.struct("first_i", "aspect"))).alias("_sp")))
    out = keys_df.select(*keys).join(g, keys, "left")
    return out.select(*keys,
                      F.coalesce(F.transform("_sp", lambda x: x["aspect"]),
                                 F.array(F.lit(S.NO_ASPECT))).alias("aspects"),
                      F.coalesce(F.transform("_sp", lambda x: x["first_i"]),
                                 F.array(F.lit(0))).alias("first_ids"))
