"""BIO gold labelling and its companions.

``bio_tags`` is a fold over the aspect list (``aggregate``) with the tag array as the
accumulator, all inside Spark SQL higher-order functions: no Python UDF.  The work per
row is bounded by that row's own word and aspect lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX


def words(col: Column) -> Column:
    """Word tokens of a text (same token grammar as the token table, no cleaning)."""
    m = TX.token_matches(col)
    return F.transform(m, lambda x: F.trim(F.replace(x, F.lit(TX.NT_MARK), F.lit(""))))


def impute_empty(aspects: Column) -> Column:
    """Empty aspect list -> ['NULL']."""
    return F.when(F.size(aspects) == 0, F.array(F.lit(S.NULL_ASPECT))).otherwise(aspects)


def is_explicit(aspects: Column) -> Column:
    """False iff more than one aspect and 'NULL' among them."""
    return ~((F.size(aspects) > 1) & F.array_contains(aspects, S.NULL_ASPECT))


def lists_aligned(*lists: Column) -> Column:
    """Trap 29: the list-valued gold columns (aspect, polarity, position) have one entry
    per aspect; false when their lengths differ."""
    first = F.size(lists[0])
    cond = F.lit(True)
    for other in lists[1:]:
        cond = cond & (F.size(other) == first)
    return cond


def aspect_type(aspects: Column) -> Column:
    """P10: 'non_aspect' for exactly ['NULL'], else 'aspect'."""
    return F.when((F.size(aspects) == 1) & (F.get(aspects, 0) == S.NULL_ASPECT),
                  F.lit(S.ASPECT_FLAG_FALSE)).otherwise(F.lit(S.ASPECT_FLAG_TRUE))


def _fold_sql(words_col: str, asp_col: str, compat_null: bool) -> str:
    null_test = ("instr('NULL', a[0]) > 0" if compat_null else "a[0] = 'NULL'")
    # Positions (0-based) of the first occurrence of every word of aspect a.
    pos = f"transform(a, w -> array_position({words_col}, w) - 1)"
    one_word = (f"named_struct('labels', transform(acc.labels, (l, j) -> "
                f"IF(j = array_position({words_col}, a[0]) - 1, 'B', l)), 'status', 'ok')")
    multi = (f"named_struct('labels', transform(b.labels, (l, j) -> CASE "
             f"WHEN j = p[0] THEN IF(b.labels[greatest(p[0] - 1, 0)] IN ('B', 'I'), 'I', 'B') "
             f"WHEN j > p[0] AND j < p[0] + size(p) THEN 'I' ELSE l END), 'status', 'ok')")
    step = (f"(acc, a) -> CASE WHEN acc.status <> 'ok' THEN acc "
            f"WHEN size(a) = 0 THEN named_struct('labels', acc.labels, 'status', '{S.STATUS_CORRUPTED}') "
            f"WHEN size(a) = 1 AND array_position({words_col}, a[0]) = 0 "
            f"THEN named_struct('labels', acc.labels, 'status', '{S.STATUS_CORRUPTED}') "
            f"WHEN size(a) = 1 THEN {one_word} "
            f"ELSE (CASE WHEN exists({pos}, x -> x < 0) "
            f"THEN named_struct('labels', acc.labels, 'status', '{S.STATUS_CORRUPTED}') "
            f"ELSE (CASE WHEN {pos} = sequence(({pos})[0], ({pos})[0] + size(a) - 1) "
            f"THEN aggregate(array({pos}), acc, (b, p) -> {multi}) "
            f"ELSE named_struct('labels', acc.labels, 'status', '{S.STATUS_MULTI}') END) END) END")
    init = (f"named_struct('labels', transform({words_col}, x -> 'O'), 'status', 'ok')")
    folded = f"aggregate({asp_col}, {init}, {step})"
    any_null = f"exists({asp_col}, a -> size(a) > 0 AND {null_test})"
    return (f"CASE WHEN size({asp_col}) = 0 THEN {init} "
            f"WHEN {any_null} AND size({asp_col}) = 1 THEN {init} "
            f"WHEN {any_null} THEN named_struct('labels', CAST(NULL AS ARRAY<STRING>), "
            f"'status', '{S.STATUS_IMPLICIT}') "
            f"ELSE {folded} END")


def bio_tags(df: DataFrame, text_col: str = "review_text", aspect_col: str = "aspect",
             compat_null: bool = False) -> DataFrame:
    """Add ``text_tokens``, ``tags`` (O/B/I per word, null when rejected) and
    ``status`` (ok | implicit_aspect | corrupted | aspect_multi_occurrence).

    Aspects are applied in order (later ones overwrite); the first failure decides the
    status.  An aspect without a token (punctuation only) is corrupted.  ``compat_null`` reproduces the substring test for 'NULL' (so an aspect
    starting with N, U, L, LL ... counts as null)."""
    S.require_columns(df, [text_col, aspect_col], "bio_tags")
    x = (df.withColumn("text_tokens", words(F.col(text_col)))
           .withColumn("_asp_tok", F.transform(F.col(aspect_col), lambda a: words(a))))
    r = F.expr(_fold_sql("text_tokens", "_asp_tok", compat_null))
    x = x.withColumn("_r", r)
    return (x.withColumn("status", F.col("_r.status"))
             .withColumn("tags", F.when(F.col("status") == S.STATUS_OK, F.col("_r.labels")))
             .drop("_r", "_asp_tok"))


def bio_clean(tagged: DataFrame) -> DataFrame:
    """Drop rows whose annotation is one of the three error markers."""
    return tagged.filter(F.col("status") == S.STATUS_OK)


def bio_encode(tags: Column) -> Column:
    """O, B, I -> 0, 1, 2."""
    return F.transform(tags, lambda t: (F.array_position(F.array(*[F.lit(x) for x in S.BIO_TAGS]), t) - 1)
                       .cast("int"))


def bio_decode_codes(codes: Column) -> Column:
    """J8 inverse: 0, 1, 2 -> O, B, I."""
    return F.transform(codes, lambda c: F.get(F.array(*[F.lit(x) for x in S.BIO_TAGS]), c))


def status_counts(tagged: DataFrame) -> DataFrame:
    """A3: rows per annotation status."""
    return tagged.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def error_flags(df: DataFrame, aspect_col: str = "aspect", tokens_col: str = "text_tokens",
                gold_col: str = "tags", pred_col: str = "tags_pred") -> DataFrame:
    """aspect_size (0 for ['NULL']), sentence_size, composed_aspect, is_correct."""
    a = F.col(aspect_col)
    return (df.withColumn("aspect_size", F.when(aspect_type(a) == S.ASPECT_FLAG_FALSE, F.lit(0))
                          .otherwise(F.size(a)).cast("bigint"))
              .withColumn("sentence_size", F.size(tokens_col).cast("bigint"))
              .withColumn("composed_aspect", F.exists(a, lambda x: x.like("% %")))
              .withColumn("is_correct", F.col(gold_col) == F.col(pred_col)))
