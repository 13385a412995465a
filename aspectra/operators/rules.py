"""Aspect-extraction rules over a token table.

A token is a row (review_id, sent_id, i, idx, text, pos, tag, dep, head_i, is_stop).
"Last child wins" loops become ``max(struct(i, ...))`` over the matching children and
"first child wins" (break) loops become ``min(struct(i, ...))``, so the result never
depends on row order.  All joins are keyed by (review_id, sent_id, position), i.e. they
reuse the partitioning of the token table and add no exchange.

Instead of a token table, the operators take sentences with their tokens as arrays
(``inrow.sentence_tokens``): findings then stay in an array of their sentence's row
(``found``) until ``finding_rows``, without a join or a cached table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import annotate as A
from . import inrow as I

K = A.SENT_KEYS
ASPECT_COLS = K + ["rule_no", "ord_i", "aspect", "modifier", "rule", "aspect_idx", "aspect_i"]


def _last(cond: Column, *fields: str) -> Column:
    return F.max(F.when(cond, F.struct(*(fields or ("i", "text", "idx")))))


def _first(cond: Column, *fields: str) -> Column:
    return F.min(F.when(cond, F.struct(*(fields or ("i", "text", "idx")))))


def head_children(tokens: DataFrame) -> DataFrame:
    """A5: one row per head token summarising its children (root excluded as a child)."""
    S.require_columns(tokens, K + ["i", "idx", "text", "pos", "tag", "dep", "head_i", "is_stop"],
                      "head_children")
    dep, stop, txt = F.col("dep"), F.col("is_stop"), F.col("text")
    modal = (dep == "aux") & (F.col("tag") == "MD")
    neg_or_modal = F.max(F.when((dep == "neg") | modal,
                                F.struct(F.col("i"),
                                         F.when(dep == "neg", txt).otherwise(F.lit("not")).alias("text"))))
    return (tokens.filter(F.col("head_i") != F.col("i"))
            .groupBy(*K, "head_i")
            .agg(_last((dep == "nsubj") & ~stop).alias("nsubj"),
                 _last(dep.isin("nsubj", "nsubjpass") & ~stop).alias("subj_any"),
                 _last((dep == "dobj") & (F.col("pos") == "ADJ") & ~stop).alias("dobj_adj"),
                 _last((dep == "acomp") & ~stop).alias("acomp"),
                 _last((dep == "advmod") & ~stop).alias("advmod"),
                 _first(dep == "advmod").alias("first_advmod"),
                 _last((dep == "attr") & ~stop).alias("attr"),
                 F.max((dep == "cop") & ~stop).alias("has_cop"),
                 _last(dep == "neg").alias("neg"),
                 neg_or_modal.alias("neg_or_modal"),
                 F.max((dep == "det") & (txt == "no")).alias("has_det_no")))


def _emit(df: DataFrame, rule_no: int, rule_id: str, aspect: str, modifier: Column,
          ord_col: str = "head_i") -> DataFrame:
    return df.select(*K, F.lit(rule_no).alias("rule_no"), F.col(ord_col).cast("int").alias("ord_i"),
                     F.col(f"{aspect}.text").alias("aspect"), modifier.alias("modifier"),
                     F.lit(rule_id).alias("rule"),
                     F.col(f"{aspect}.idx").cast("int").alias("aspect_idx"),
                     F.col(f"{aspect}.i").cast("int").alias("aspect_i"))


def rule_r1(tokens: DataFrame, hc: DataFrame | None = None) -> DataFrame:
    """Adjectival modifier.  Aspect = head of a non-stop ``amod`` token; modifier =
    the token, prefixed by its first advmod child, then by ``not`` when the head has a
    ``det`` child ``no``."""
    hc = head_children(tokens) if hc is None else hc
    m = tokens.filter((F.col("dep") == "amod") & ~F.col("is_stop")).select(
        *K, F.col("i").alias("m_i"), F.col("text").alias("m_text"), "head_i")
    h = tokens.select(*K, F.col("i").alias("head_i"),
                      F.struct("i", "text", "idx").alias("a"))
    hc_m = hc.select(*K, F.col("head_i").alias("m_i"), F.col("first_advmod.text").alias("adv"))
    hc_h = hc.select(*K, "head_i", "has_det_no")
    j = (m.join(h, K + ["head_i"]).join(hc_m, K + ["m_i"], "left")
          .join(hc_h, K + ["head_i"], "left"))
    mod = F.concat_ws(" ", F.when(F.col("has_det_no"), F.lit("not")), F.col("adv"), F.col("m_text"))
    return _emit(j, 1, "r1", "a", mod, ord_col="m_i")


def _heads(tokens: DataFrame, hc: DataFrame) -> DataFrame:
    """A5 rows joined with the head token itself and with the summary of the head's
    last non-stop advmod child (grandchild adverb for R4)."""
    head_tok = tokens.select(*K, F.col("i").alias("head_i"), F.col("text").alias("head_text"),
                             F.col("pos").alias("head_pos"), F.col("is_stop").alias("head_stop"))
    g = hc.select(*K, F.col("head_i").alias("adv_i"), F.col("first_advmod.text").alias("adv_adv"))
    return (hc.join(head_tok, K + ["head_i"])
              .withColumn("adv_i", F.col("advmod.i"))
              .join(g, K + ["adv_i"], "left"))


def _neg(col: str, m: Column) -> Column:
    return F.concat_ws(" ", F.col(col), m)


def _candidate(cond: Column, rule_no: int, rule_id: str, aspect: str, modifier: Column) -> Column:
    return F.when(cond, F.struct(F.lit(rule_no).alias("rule_no"), F.col("head_i").cast("int").alias("ord_i"),
                                 F.col(f"{aspect}.text").alias("aspect"), modifier.alias("modifier"),
                                 F.lit(rule_id).alias("rule"), F.col(f"{aspect}.idx").cast("int").alias("aspect_idx"),
                                 F.col(f"{aspect}.i").cast("int").alias("aspect_i")))


def rules_from_heads(heads: DataFrame, compat_rule_ids: bool = False) -> DataFrame:
    """R2-R7 in one pass over the joined head table: each head row yields the array of
    rules it satisfies, exploded (one scan instead of six)."""
    nn = F.col("nsubj").isNotNull()
    adv = F.concat_ws(" ", F.col("adv_adv"), F.col("advmod.text"))
    cands = F.array(
        _candidate(nn & F.col("dobj_adj").isNotNull(), 2, "r2", "nsubj", _neg("neg.text", F.col("dobj_adj.text"))),
        _candidate(nn & F.col("acomp").isNotNull(), 3, "r3", "nsubj", _neg("neg_or_modal.text", F.col("acomp.text"))),
        _candidate(F.col("subj_any").isNotNull() & F.col("advmod").isNotNull(), 4, "r4", "subj_any",
                   _neg("neg.text", adv)),
        _candidate(nn & F.col("has_cop"), 5, "r5", "nsubj", F.col("head_text")),
        _candidate(nn & (F.col("head_pos") == "INTJ") & ~F.col("head_stop"), 6,
                   S.COMPAT_RULE6_ID if compat_rule_ids else "r6", "nsubj", F.col("head_text")),
        _candidate(nn & F.col("attr").isNotNull(), 7, "r7", "nsubj", _neg("neg.text", F.col("attr.text"))),
    )
    return (heads.select(*K, F.explode(F.filter(cands, lambda c: c.isNotNull())).alias("_r"))
                 .select(*K, "_r.*"))


def all_rules(tokens: DataFrame, compat_rule_ids: bool = False) -> DataFrame:
    """Union of the seven rule outputs (duplicates kept)."""
    if "toks" in tokens.columns:
        return I.with_findings(I.with_heads(tokens), compat_rule_ids)
    hc = head_children(tokens)
    return rule_r1(tokens, hc).unionByName(rules_from_heads(_heads(tokens, hc), compat_rule_ids))


def finding_rows(found: DataFrame) -> DataFrame:
    """One row per finding, of either form."""
    return found.select(*K, F.inline("found")) if "found" in found.columns else found


def rule_by_number(tokens: DataFrame, n: int, compat_rule_ids: bool = False) -> DataFrame:
    if "toks" in tokens.columns:
        return finding_rows(all_rules(tokens, compat_rule_ids)).filter(F.col("rule_no") == n)
    hc = head_children(tokens)
    if n == 1:
        return rule_r1(tokens, hc)
    return rules_from_heads(_heads(tokens, hc), compat_rule_ids).filter(F.col("rule_no") == n)


def map_pronouns(aspects: DataFrame) -> DataFrame:
    """it/this/they/these (case-sensitive) -> 'product'."""
    if "found" in aspects.columns:
        return I.map_pronouns(aspects)
    a = F.col("aspect")
    return aspects.withColumn("aspect", F.when(a.isin(S.PRODUCT_PRONOUNS), F.lit(S.PRODUCT_ASPECT))
                              .otherwise(a))


def entity_match(aspects: DataFrame, ents: DataFrame | None = None) -> DataFrame:
    """Replace the aspect by the entity whose root offset equals ``aspect_idx``.  Findings
    in arrays bring the entities of their sentence along (``inrow.with_entities``)."""
    if "found" in aspects.columns:
        return finding_rows(I.match_entities(aspects))
    e = ents.select(*K, F.col("root_idx").alias("aspect_idx"), "ent_text")
    return (aspects.join(e, K + ["aspect_idx"], "left")
            .withColumn("aspect", F.coalesce(F.col("ent_text"), F.col("aspect")))
            .drop("ent_text"))


def synonym_table(spark) -> DataFrame:
    """J5 dictionary as a (tiny, fixed) table: synonym -> canonical, kind."""
    rows = [(syn, canon, "product") for canon, syns in S.PRODUCT_SYNONYMS.items() for syn in syns]
    rows += [(syn, canon, "feature") for canon, syns in S.FEATURE_SYNONYMS.items() for syn in syns]
    return spark.createDataFrame(rows, "synonym string, canonical string, kind string")


def canonical_aspects(aspects: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Left join of lower-cased aspects to a synonym dictionary (broadcast: the
    dictionary is a fixed-size table)."""
    d = F.broadcast(dictionary.select(F.col("synonym").alias("_syn"), "canonical", "kind"))
    return (finding_rows(aspects).join(d, F.lower(F.col("aspect")) == F.col("_syn"), "left").drop("_syn"))


def extract_aspects(sentences: DataFrame, tokens: DataFrame, window: int = 6,
                    compat_rule_ids: bool = False, keep_duplicates: bool = False,
                    span_tokens: DataFrame | None = None) -> DataFrame:
    """R8 + R9: rules 1-7 -> pronoun map -> entity match -> text window; a sentence with
    no hit gives one row with null aspect fields and the whole sentence as its window.

    Output: review_id, sent_id, rule_no, ord_i, aspect, modifier, rule, aspect_idx,
    aspect_i, win_left, win_right, aspect_sentence (+ carried span columns).  The
    emission order is (sent_id, rule_no, ord_i).  Sentences are left-joined to the
    findings once, which yields both the findings and the no-hit rows.
    """
    from . import spans as SP
    found = all_rules(tokens, compat_rule_ids)
    found = entity_match(map_pronouns(found), A.entities(tokens))
    rows = sentences.select(*K, "n_tokens").join(found, K, "left")
    rows = SP.add_window_bounds(rows, window, keep_duplicates).drop("n_tokens")
    return SP.attach_span(rows, sentences, span_tokens if span_tokens is not None else tokens)
