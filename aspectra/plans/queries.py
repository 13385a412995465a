"""Registered queries: one per operator key of the survey's inventory.

Each callable takes (spark, sf_dir) and returns a DataFrame over the driver's tables;
``finalize`` makes types comparable with the DuckDB oracle (bigint, 6-digit doubles,
'|'-joined arrays).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX
from ..operators import annotate as A
from ..operators import batches as BT
from ..operators import bio as B
from ..operators import evaluate as EV
from ..operators import evaluation as EN
from ..operators import inrow as IR
from ..operators import polarity as P
from ..operators import predict as PR
from ..operators import rules as R
from ..operators import sampling as SA
from ..operators import spans as SP
from ..sources import readers as RD
from .tables import finalize, gold_items, labelled_reviews, reviews, table

Query = Callable[[SparkSession, str], DataFrame]
K = A.SENT_KEYS


def _corpus(spark, sf, materialize=True):
    """``materialize=False`` for a single reader of the tokens: what it does not ask for is not computed."""
    return A.annotate_corpus(reviews(spark, sf), materialize=materialize)


def _aspects(spark, sf, steps, rule_no: int | None = None):
    """``steps(sentences, tokens)`` inside the rows of those sentences in which the rule (or any)
    may find something; reviews whose ids repeat or are null keep the relational operators."""
    once, again = A.by_repeats(reviews(spark, sf))
    s = A.split_sentences(once, assume_partitioned=True)
    out = steps(s, IR.sentence_tokens(s.filter(A.may_find(F.col("sentence"), rule_no))))
    if again is not None:
        out = out.unionByName(steps(*A.annotate_corpus(again, assume_partitioned=True)[1:]))
    return out


def _model(spark, sf) -> P.NaiveBayesModel:
    return P.nb_train(P.polarity_training_set(labelled_reviews(spark, sf)))


# ---------------------------------------------------------------------------------------
# text
# ---------------------------------------------------------------------------------------
def q_clean_corpus(spark, sf):
    d = table(spark, sf, "documents")
    return finalize(d.select("doc_id", TX.clean_text(F.col("text")).alias("clean_text")))


def q_normalise_variants(spark, sf):
    d = table(spark, sf, "documents")
    t = F.col("text")
    return finalize(d.select("doc_id", TX.to_lower(t).alias("lower_text"),
                             TX.delete_punctuation(t).alias("no_punct"),
                             TX.split_contractions(t).alias("contractions"),
                             TX.space_punctuation(t).alias("spaced")))


def q_sentence_table(spark, sf):
    s = A.split_sentences(reviews(spark, sf))
    return finalize(s.select(*K, "sentence", "n_tokens"))


def q_token_table(spark, sf):
    t = A.tokenize(A.split_sentences(reviews(spark, sf)))
    return finalize(t)


def q_annotate_tokens(spark, sf):
    return finalize(BT.token_rows(A.spread(reviews(spark, sf)), ("i", "text", "pos", "tag", "dep", "head_i", "is_stop")))


def q_head_children(spark, sf):
    _, _, t = _corpus(spark, sf, materialize=False)
    hc = R.head_children(t)
    return finalize(hc.select(*K, "head_i",
                              F.col("nsubj.text").alias("nsubj"), F.col("subj_any.text").alias("subj_any"),
                              F.col("dobj_adj.text").alias("dobj_adj"), F.col("acomp.text").alias("acomp"),
                              F.col("advmod.text").alias("advmod"), F.col("advmod.i").alias("advmod_i"),
                              F.col("first_advmod.text").alias("first_advmod"),
                              F.col("attr.text").alias("attr"), "has_cop",
                              F.col("neg.text").alias("neg"), F.col("neg_or_modal.text").alias("neg_or_modal"),
                              "has_det_no"))


def _copula_tokens(t):
    """Tokens of another tagger, derived from ours: auxiliary forms of *be* are copulas, and
    predicates that are verbs of even position count as interjections; passive subjects
    count as subjects."""
    def changed(x):
        be = (x["dep"] == "auxpass") & x["lemma"].isin(S.LEX_BE)
        root = (x["dep"] == "ROOT") & (x["pos"] == "VERB") & (x["i"] % 2 == 0)
        return {"is_stop": x["is_stop"] & ~be, "pos": F.when(root, F.lit("INTJ")).otherwise(x["pos"]),
                "dep": F.when(be, F.lit("cop")).when(x["dep"] == "nsubjpass", "nsubj").otherwise(x["dep"])}
    if "toks" in t.columns:
        return IR.retag(t, changed)
    return t.withColumns(changed({c: F.col(c) for c in t.columns}))


def _rule_query(n: int) -> Query:
    def q(spark, sf):
        # our linker makes neither copulas nor interjections with subjects
        tagged = _copula_tokens if n in (5, 6) else lambda t: t
        return finalize(_aspects(spark, sf, lambda s, t: R.rule_by_number(tagged(t), n), n).drop("rule_no"))
    q.__name__ = f"q_rule_r{n}"
    return q


def q_extract_aspects(spark, sf):
    e = IR.extract_reviews(reviews(spark, sf))
    return finalize(e.select(*K, "rule_no", "ord_i", "aspect", "modifier", "rule", "aspect_idx", "aspect_i",
                             "win_left", "win_right", "aspect_sentence"))


def q_extract_aspects_bucketed(spark, sf):
    """R8/R9 over a corpus table bucketed by review_id: the plan has no exchange."""
    import uuid
    from ..session import text_partitions
    from ..sources.derived import scratch_path
    r = reviews(spark, sf)
    name = f"aspectra_reviews_{uuid.uuid4().hex[:8]}"
    t = RD.write_bucketed_reviews(r, name, scratch_path(spark, "bucketed"), text_partitions(r))
    e = IR.extract(A.split_sentences(t, assume_partitioned=True))
    return finalize(e.select(*K, "rule_no", "ord_i", "aspect", "modifier", "rule", "aspect_idx", "aspect_i",
                             "win_left", "win_right", "aspect_sentence"))


def _window_query(keep_duplicates: bool) -> Query:
    words = lambda t: t if "toks" in t.columns else t.select(*K, "i", "idx", "text")

    def q(spark, sf):
        w = _aspects(spark, sf, lambda s, t: SP.aspect_window(R.all_rules(t), s, words(t), S.WINDOW_MAIN, keep_duplicates).select(
            *K, "rule_no", "ord_i", "aspect_i", "win_left", "win_right", "aspect_sentence"))
        return finalize(w)
    return q


def q_entity_match(spark, sf):
    def steps(s, t):
        if "toks" in t.columns:
            return R.entity_match(R.map_pronouns(R.all_rules(IR.with_entities(t))))
        return R.entity_match(R.map_pronouns(R.all_rules(t)), A.entities(t)).select(*R.ASPECT_COLS)
    return finalize(_aspects(spark, sf, steps).select(*K, "rule_no", "ord_i", "aspect_idx", "aspect"))


def q_aspect_canonical(spark, sf):
    names = R.synonym_table(spark)
    c = _aspects(spark, sf, lambda s, t: R.canonical_aspects(R.map_pronouns(R.all_rules(t)), names))
    return finalize(c.select(*K, "rule_no", "ord_i", "aspect", "canonical", "kind"))


# ---------------------------------------------------------------------------------------
# polarity
# ---------------------------------------------------------------------------------------
def q_rating_to_polarity(spark, sf):
    e = table(spark, sf, "events")
    return finalize(e.select("event_id", "value", P.rating_to_polarity(F.col("value")).alias("polarity")))


def q_load_labelled_reviews(spark, sf):
    return finalize(P.load_labelled_reviews(labelled_reviews(spark, sf)).select("review_id", "polarity"))


def q_length_iqr_filter(spark, sf):
    return finalize(P.length_iqr_filter(labelled_reviews(spark, sf)).select("review_id", "polarity"))


def q_balance_binary(spark, sf):
    return finalize(P.balance_binary(labelled_reviews(spark, sf)).select("review_id", "polarity"))


def q_polarity_training_set(spark, sf):
    return finalize(P.polarity_training_set(labelled_reviews(spark, sf)).select("review_id", "polarity"))


def q_nb_train(spark, sf):
    m = _model(spark, sf)
    return finalize(m.vocab)


def q_polarity_score(spark, sf):
    m = _model(spark, sf)
    return finalize(P.polarity_score(reviews(spark, sf), m).drop("score"))


def q_neutral_threshold(spark, sf):
    m = _model(spark, sf)
    return finalize(P.polarity_score(reviews(spark, sf), m, threshold=S.NEUTRAL_THRESHOLD).drop("score"))


def q_lr_train(spark, sf):
    model = P.lr_train(P.polarity_training_set(labelled_reviews(spark, sf)))
    return finalize(P.lr_score(model, reviews(spark, sf)))


def q_model_bundle(spark, sf):
    from ..operators import models as MD
    from ..sources.derived import scratch_path
    m = _model(spark, sf)
    path = scratch_path(spark, "nb-bundle")
    MD.save_nb_bundle(m, path, labels=EV.label_index(labelled_reviews(spark, sf), "polarity"))
    return finalize(MD.load_nb_bundle(spark, path).vocab)


def q_predict_long(spark, sf):
    m = _model(spark, sf)
    out = PR.predict(reviews(spark, sf), m, flat=False)
    return finalize(out.select(*K, "rule_no", "ord_i", "aspect", "modifier", "rule", "aspect_i",
                               "aspect_sentence", "sentiment", "sentiment_prob"))


def q_predict_flat(spark, sf):
    m = _model(spark, sf)
    out = PR.predict(reviews(spark, sf), m, flat=True)
    return finalize(out.select("review_id", "aspects", "polarity"))


def q_reject_reviews(spark, sf):
    """Every tenth text is made null and every tenth blank, so both reasons occur."""
    k = F.col("doc_id") % 10
    d = table(spark, sf, "documents").withColumn(
        "text", F.when(k == 0, F.lit(None)).when(k == 1, F.lit(" \n\t")).otherwise(F.col("text")))
    return finalize(PR.reject_reviews(d, "doc_id", "text"))


# ---------------------------------------------------------------------------------------
# sampling
# ---------------------------------------------------------------------------------------
def q_seeded_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return finalize(SA.seeded_sample(d, "doc_id"))


def q_stratified_split(spark, sf):
    lr = labelled_reviews(spark, sf).select("review_id", "polarity")
    return finalize(SA.stratified_split(lr, "review_id", "polarity"))


# ---------------------------------------------------------------------------------------
# joins and sources
# ---------------------------------------------------------------------------------------
def q_reviews_with_product(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("App"), "p_name")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("App"))
    return finalize(RD.join_app_reviews(part, li).select("l_orderkey", "l_linenumber", "App", "p_name"))


def q_nested_reviews_explode(spark, sf):
    conv = table(spark, sf, "conversations")
    nested = RD.nest_conversations(conv)
    out = RD.explode_nested_reviews(nested)
    return finalize(out.select("product_name", "review_pos", "review_text", "rating", "polarity"))


def q_tag_extract(spark, sf):
    p = table(spark, sf, "pages")
    return finalize(RD.extract_tags(p.select("page_id", F.col("html").alias("value")), ["title", "h1"])
                    .select("page_id", "title", "h1"))


def q_parse_list_column(spark, sf):
    g = gold_items(spark, sf)
    lit = F.concat(F.lit("["), F.array_join(F.transform("aspect", lambda a: F.concat(F.lit("'"), a, F.lit("'"))), ", "),
                   F.lit("]"))
    return finalize(g.select("review_id", lit.alias("aspect_text"), TX.parse_list_literal(lit).alias("aspect")))


def q_read_tagged_reviews(spark, sf):
    from ..sources import derived as DV
    root = DV.write_tagged_reviews(spark, sf)
    return finalize(RD.read_tagged_reviews(spark, root).select("domain", "polarity", "product_name", "rating",
                                                               "review_text"))


def q_read_gold_xml(spark, sf):
    from ..sources import derived as DV
    root = DV.write_gold_xml(spark, sf)
    g = RD.read_gold_terms(spark, f"{root}/*.xml", source=RD.GOLD_MAMS)
    return finalize(g.select("review_text", "aspect", "polarity", "partition",
                             F.transform("position", lambda p: p["start"]).alias("starts")))


def _opinions_query(compat: bool) -> Query:
    def q(spark, sf):
        from ..sources import derived as DV
        root = DV.write_gold_opinions_xml(spark, sf)
        g = RD.read_gold_opinions(spark, f"{root}/*.xml", year="2015", compat_truncate=compat)
        return finalize(g.select("review_text", "aspect", "polarity", "partition", "source"))
    return q


def q_read_app_reviews(spark, sf):
    from ..sources import derived as DV
    apps, revs = DV.write_app_csvs(spark, sf)
    return finalize(RD.read_app_reviews(spark, apps, revs))


def q_read_app_reviews_by_ranges(spark, sf):
    """S1 with the review file cut into byte ranges."""
    from ..sources import derived as DV
    apps, revs = DV.write_app_csvs(spark, sf)
    return finalize(RD.read_app_reviews(spark, apps, revs, by_ranges=True))


def q_build_gold(spark, sf):
    from ..sources import derived as DV
    root = DV.write_gold_xml(spark, sf)
    mams = RD.read_gold_terms(spark, f"{root}/*.xml", source=RD.GOLD_MAMS)
    other = RD.read_gold_terms(spark, f"{root}/train.xml", source=RD.GOLD_2014, domain="laptop")
    out = DV.scratch_path(spark, "gold")
    RD.write_gold(RD.build_gold([mams, other]), out)
    g = RD.read_gold(spark, out)
    return finalize(g.select("source", "partition", "domain", "review_text", "aspect"))


def q_reviews_roundtrip(spark, sf):
    """K1 + S7: write the reviews dataset partitioned by source, read it back and
    filter one source (partition pruning at the scan)."""
    from ..sources.derived import scratch_path
    path = scratch_path(spark, "reviews")
    RD.write_reviews(RD.build_reviews(spark, sf), path)
    r = RD.read_reviews_dataset(spark, path).filter(F.col("source") == RD.HOTELS)
    return finalize(r.select("review_id", "source", "review_text", "rating", "polarity"))


def _reviews_dataset(spark, sf):
    """The three review sources (S1 among them) and the labelled documents as one dataset."""
    from ..sources import derived as DV
    path = DV.scratch_path(spark, "dataset")
    apps = RD.app_review_rows(RD.read_app_reviews(spark, *DV.write_app_csvs(spark, sf), by_ranges=True))
    return path, RD.write_reviews_dataset([RD.build_reviews(spark, sf), apps], path)


def q_reviews_manifest(spark, sf):
    """Rows and rejects of every source."""
    return finalize(_reviews_dataset(spark, sf)[1])


def q_training_from_dataset(spark, sf):
    """M1 from the cleaned dataset: the folders of the app store and the hotels alone are read."""
    path, _ = _reviews_dataset(spark, sf)
    r = RD.read_reviews_of(spark, path, [RD.APP_STORE, RD.HOTELS])
    return finalize(P.polarity_training_set(r.select("review_id", "review_text", "polarity")).select("review_id", "polarity"))


def q_predictions_csv(spark, sf):
    """K3: flat predictions written as ';' CSV (lists as JSON text) and read back."""
    from ..sources.derived import scratch_path
    m = _model(spark, sf)
    flat = PR.predict(reviews(spark, sf), m, flat=True)
    path = scratch_path(spark, "predictions")
    RD.write_predictions(flat, path, fmt="csv")
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    return finalize(back.select(F.col("review_id").cast("bigint").alias("review_id"),
                                F.from_json("aspects", "array<string>").alias("aspects"),
                                F.from_json("polarity", "array<string>").alias("polarity")))


def q_build_reviews(spark, sf):
    return finalize(RD.build_reviews(spark, sf).select("review_id", "source", "review_text", "rating", "polarity"))


# ---------------------------------------------------------------------------------------
# BIO / tagger
# ---------------------------------------------------------------------------------------
def _bio(spark, sf):
    g = gold_items(spark, sf)
    return B.bio_tags(g.withColumn("aspect", B.impute_empty(F.col("aspect"))))


def q_bio_tags(spark, sf):
    return finalize(_bio(spark, sf).select("review_id", "aspect", "tags", "status"))


def q_bio_clean(spark, sf):
    return finalize(B.bio_clean(_bio(spark, sf)).select("review_id", "tags"))


def q_bio_encode(spark, sf):
    b = B.bio_clean(_bio(spark, sf))
    return finalize(b.select("review_id", B.bio_encode(F.col("tags")).alias("codes")))


def q_bio_status_counts(spark, sf):
    return finalize(B.status_counts(_bio(spark, sf)))


def _gold_tokens(spark, sf):
    """Word rows of clean gold items: review_id, i, word, gold tag, baseline prediction."""
    b = B.bio_clean(_bio(spark, sf))
    t = b.select("review_id", F.posexplode(F.arrays_zip("text_tokens", "tags")).alias("i", "z"))
    t = t.select("review_id", F.col("i").cast("int").alias("i"), F.col("z.text_tokens").alias("word"),
                 F.col("z.tags").alias("gold"))
    return t.withColumn("pred", _baseline_tag(t))


def _baseline_tag(t, keys=("review_id",)):
    """Deterministic baseline tagger used by the metric checks: B for a noun-like word
    right after an adjective-suffixed word, I for a further such noun, else O."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("i")
    kind = A.token_kind(F.col("word"))
    prev_kind = F.lag(kind).over(w)
    prev2_kind = F.lag(kind, 2).over(w)
    return (F.when((kind == "noun") & (prev_kind == "adj"), F.lit("B"))
             .when((kind == "noun") & (prev_kind == "noun") & (prev2_kind == "adj"), F.lit("I"))
             .otherwise(F.lit("O")))


def q_bio_decode(spark, sf):
    t = _gold_tokens(spark, sf)
    d = SP.bio_decode(t, ["review_id"], "gold", "word", "i")
    keys = B.bio_clean(_bio(spark, sf)).select("review_id")
    return finalize(SP.bio_decode_lists(d, keys))


def q_gold_quality_flags(spark, sf):
    g = gold_items(spark, sf)
    a = B.impute_empty(F.col("aspect"))
    return finalize(g.select("review_id", B.is_explicit(a).alias("is_explicit"),
                             B.aspect_type(a).alias("type_aspect"),
                             B.lists_aligned(F.col("aspect"), F.col("polarity")).alias("lists_aligned")))


def q_token_length_filter(spark, sf):
    b = B.bio_clean(_bio(spark, sf))
    return finalize(b.filter(F.size("text_tokens") <= S.TAGGER_MAX_TOKENS).select("review_id"))


def q_aspect_training_set(spark, sf):
    b = B.bio_clean(_bio(spark, sf)).filter(F.size("text_tokens") <= S.TAGGER_MAX_TOKENS)
    b = b.select("review_id", B.bio_encode(F.col("tags")).alias("codes"),
                 B.aspect_type(F.col("aspect")).alias("type_aspect"))
    return finalize(SA.stratified_split(b, "review_id", "type_aspect"))


def q_token_features(spark, sf):
    from ..operators import tagger as TG
    t = _gold_tokens(spark, sf)
    return finalize(TG.token_features(t, ["review_id"]).select(
        "review_id", "i", "word", "lower", "prev1", "prev2", "next1", "next2", "suffix3", "shape", "gold"))


def q_tagger_train(spark, sf):
    from ..operators import tagger as TG
    t = _gold_tokens(spark, sf)
    model = TG.tagger_train(TG.token_features(t, ["review_id"]))
    return finalize(TG.tagger_predict(model, TG.token_features(t, ["review_id"]))
                    .select("review_id", "i", "gold", "tag_pred"))


def q_tagger_predict(spark, sf):
    from ..operators import tagger as TG
    t = _gold_tokens(spark, sf)
    model = TG.tagger_train(TG.token_features(t, ["review_id"]))
    return finalize(TG.review_spans(reviews(spark, sf), model))


def q_predict_flat_aux(spark, sf):
    """Flat prediction with the auxiliary columns, by a deterministic tagger."""
    rule = lambda words: words.withColumn("tag_pred", _baseline_tag(words, K))
    out = PR.predict(reviews(spark, sf), _model(spark, sf), flat=True, aux=rule)
    return finalize(out.select("review_id", "aspects", "polarity", "aspects_aux", "polarity_aux",
                               F.array_min("polarity_prob_aux").alias("least_prob_aux")))


def q_lr_invariants(spark, sf):
    """Logistic regression over all documents: every label known, every probability in
    [0.5, 1], and better than the larger class on the balanced training rows."""
    train = P.polarity_training_set(labelled_reviews(spark, sf))
    model = P.lr_train(train)
    fit = P.lr_score(model, train).join(train.select("review_id", "polarity"), "review_id")
    share = fit.agg(F.avg((F.col("label") == F.col("polarity")).cast("double")).alias("a")).first()["a"]
    s = P.lr_score(model, reviews(spark, sf).filter(F.col("review_text").rlike(r"\S")))
    return s.select("review_id", F.col("label").isin(S.POSITIVE, S.NEGATIVE).alias("label_known"),
                    F.col("prob").between(0.5, 1.0).alias("prob_in_range"), F.lit(share > 0.5).alias("beats_majority"))


def q_predict_aux(spark, sf):
    from ..operators import tagger as TG
    t = _gold_tokens(spark, sf)
    model = TG.tagger_train(TG.token_features(t, ["review_id"]))
    m = _model(spark, sf)
    out = TG.predict_aux(reviews(spark, sf), model, m)
    return finalize(out)


# ---------------------------------------------------------------------------------------
# metrics and evaluation
# ---------------------------------------------------------------------------------------
def _scored_labels(spark, sf):
    m = _model(spark, sf)
    lr = labelled_reviews(spark, sf).filter(F.col("polarity").isin(S.POSITIVE, S.NEGATIVE))
    sc = P.polarity_score(lr, m, threshold=S.NEUTRAL_THRESHOLD)
    return lr.select("review_id", F.col("polarity").alias("y_true")).join(
        sc.select("review_id", F.col("sentiment").alias("y_pred"), "label", "prob", "score"), "review_id")


def q_heldout_report(spark, sf):
    """E8 on the held-out split: stratified 80/20 split of the labelled reviews, naive
    Bayes trained on the training part (M1 chain), report on the validation part."""
    lr = labelled_reviews(spark, sf).filter(F.col("polarity").isin(S.POSITIVE, S.NEGATIVE))
    sp = SA.stratified_split(lr, "review_id", "polarity")
    train = sp.filter(F.col("split") == "train").drop("split")
    valid = sp.filter(F.col("split") == "valid").drop("split")
    m = P.nb_train(P.polarity_training_set(train))
    sc = P.polarity_score(valid, m, threshold=S.NEUTRAL_THRESHOLD)
    y = valid.select("review_id", F.col("polarity").alias("y_true")).join(
        sc.select("review_id", F.col("sentiment").alias("y_pred")), "review_id")
    return finalize(EV.classification_report(y))


def q_classification_report(spark, sf):
    return finalize(EV.classification_report(_scored_labels(spark, sf)))


def q_confusion_matrix(spark, sf):
    return finalize(EV.confusion_matrix(_scored_labels(spark, sf), [S.NEGATIVE, S.NEUTRAL, S.POSITIVE]))


def q_micro_f1(spark, sf):
    return finalize(EV.micro_f1(_scored_labels(spark, sf)))


def q_roc_auc(spark, sf):
    d = _scored_labels(spark, sf).withColumn("is_pos", F.col("y_true") == S.POSITIVE)
    return finalize(EV.roc_auc(d, "score", "is_pos"))


def q_roc_curve(spark, sf):
    """The curve of each class against the other: thresholds are log odds of the class."""
    d = _scored_labels(spark, sf)
    curves = [EV.roc_points(d.select((F.col("score") * sign).alias("s"), (F.col("y_true") == name).alias("is")), "s", "is")
              .select(F.lit(name).alias("label"), "threshold", "tp", "fp", "tpr", "fpr")
              for name, sign in ((S.POSITIVE, 1), (S.NEGATIVE, -1))]
    return finalize(curves[0].unionByName(curves[1]))


def q_seq_report(spark, sf):
    return finalize(EV.seq_report(_gold_tokens(spark, sf), ["review_id"]))


def q_token_outcomes(spark, sf):
    o = EV.token_outcomes(_gold_tokens(spark, sf))
    return finalize(o.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


def _error_rows(spark, sf):
    t = _gold_tokens(spark, sf)
    g = t.groupBy("review_id").agg(F.array_sort(F.collect_list(F.struct("i", "gold", "pred"))).alias("_t"))
    g = g.select("review_id", F.transform("_t", lambda x: x["gold"]).alias("tags"),
                 F.transform("_t", lambda x: x["pred"]).alias("tags_pred"))
    b = B.bio_clean(_bio(spark, sf)).select("review_id", "aspect", "text_tokens")
    return B.error_flags(b.join(g, "review_id"))


def q_error_flags(spark, sf):
    return finalize(_error_rows(spark, sf).select("review_id", "aspect_size", "sentence_size",
                                                  "composed_aspect", "is_correct"))


def q_error_stats(spark, sf):
    return finalize(EV.describe_by(_error_rows(spark, sf), ["is_correct"], "sentence_size"))


def _eval_base(spark, sf):
    g = gold_items(spark, sf)
    m = _model(spark, sf)
    flat = PR.predict(g.select("review_id", "review_text"), m, flat=True)
    return g.join(flat.select("review_id", "aspects", F.col("polarity").alias("pred_polarity")), "review_id")


def q_eval_polarity(spark, sf):
    return finalize(EV.eval_polarity(_eval_base(spark, sf)))


def q_eval_aspect(spark, sf):
    return finalize(EV.eval_aspect(_eval_base(spark, sf)))


def q_error_stats_groupings(spark, sf):
    """A7 in three groupings, one pass."""
    return finalize(EN.error_stats(_error_rows(spark, sf)))


def _blanked_run(spark, sf):
    """Gold aligned with predictions of a run that rejected every ninth review (blank text)."""
    g = gold_items(spark, sf)
    text = F.when(F.col("review_id") % 9 == 0, F.lit(" ")).otherwise(F.col("review_text"))
    return g, g.select("review_id", text.alias("review_text"))


def q_eval_run(spark, sf):
    """A rejected gold row stays, without a prediction."""
    g, texts = _blanked_run(spark, sf)
    return finalize(EN.evaluate_run(g, _model(spark, sf), texts).select("review_id", "has_prediction", "aspects"))


def q_eval_polarity_report(spark, sf):
    """The A9 report over every gold row, rejected ones included."""
    g, texts = _blanked_run(spark, sf)
    return finalize(EN.polarity_report(EN.evaluate_run(g, _model(spark, sf), texts)))


def q_eval_coverage(spark, sf):
    """Gold without a prediction and predictions without gold."""
    g, texts = _blanked_run(spark, sf)
    found = A.split_sentences(A.spread(texts), assume_partitioned=True).select("review_id")
    return finalize(EN.coverage(g.filter(F.col("review_id") % 7 != 0), found))


def _heldout(spark, sf):
    return EN.heldout_reports(EN.heldout_scores(labelled_reviews(spark, sf)))


def q_heldout_confusion_matrix(spark, sf):
    return finalize(_heldout(spark, sf)["matrix"])


def q_heldout_roc_auc(spark, sf):
    return finalize(_heldout(spark, sf)["auc"])


def q_tagger_out_of_fold(spark, sf):
    """Every gold sentence tagged by a model trained on the other folds; per sentence what
    must hold whatever the models say."""
    words = _gold_tokens(spark, sf).select("review_id", "i", "word", "gold")
    t = EN.cross_fit(words, ["review_id"], F.col("review_id") % 3, folds=3)
    o = EV.token_outcomes(t, pred_col="tag_pred")
    return finalize(o.groupBy("review_id").agg(
        F.max("fold").alias("fold"), F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("i").alias("n_positions"),
        F.count_if(F.col("gold") != "O").alias("n_gold"), F.bool_and(F.col("tag_pred").isin("O", "B", "I")).alias("tags_known"),
        (F.count_if((F.col("gold") == "O") & F.col("outcome").isin("TN", "FP"))
         + F.count_if((F.col("gold") != "O") & F.col("outcome").isin("TP", "FN", "FP"))).alias("n_outcomes")))


def q_error_stats_out_of_fold(spark, sf):
    """E7 whole: A14, P16 and A7 on out-of-fold tags; the counts of each grouping add up."""
    words = _gold_tokens(spark, sf).select("review_id", "i", "word", "gold")
    e = EN.error_analysis(EN.cross_fit(words, ["review_id"], F.col("review_id") % 3, folds=3), B.bio_clean(_bio(spark, sf)))
    n = F.sum("count").alias("n_sentences")
    return finalize(e.stats.groupBy("grouping").agg(n, F.min("min").alias("least"), F.max("max").alias("most")))


def q_metric_store(spark, sf):
    """M9: two runs appended to a bundle's metric store, read back."""
    from ..operators import models as MD
    from ..sources.derived import scratch_path
    path = scratch_path(spark, "metrics")
    MD.append_metrics(path, "naive-bayes", "valid", MD.metrics_long(_heldout(spark, sf)["report"]))
    MD.append_metrics(path, "rule-tagger", "gold", MD.sequence_metrics_long(EV.seq_report(_gold_tokens(spark, sf), ["review_id"])))
    return finalize(MD.read_metrics(spark, path))


def q_build_gold_sources(spark, sf):
    """Four gold datasets, each read by its registered reader."""
    from ..sources import derived as DV
    g = RD.read_gold_sources(spark, DV.write_gold_sources(spark, sf))
    return finalize(g.select("source", "domain", "partition", "review_text", "aspect", "polarity",
                             F.size("position").alias("n_positions")))


def q_gold_csv_rejects(spark, sf):
    """Rows and rejects of a legacy CSV, counted by reason."""
    from ..sources import derived as DV
    good, rejects = RD.read_gold_csv_checked(spark, DV.write_gold_csv(spark, sf), header=False)
    path = DV.scratch_path(spark, "rejects")
    RD.write_rejects(rejects, path)
    kept = good.select(F.lit("kept").alias("reason"), F.size("aspect").alias("items"))
    back = spark.read.parquet(path).select("reason", F.lit(0).alias("items"))
    return finalize(kept.unionByName(back).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("items").alias("items")))


def q_aspect_type_counts(spark, sf):
    g = gold_items(spark, sf)
    t = g.select(B.aspect_type(B.impute_empty(F.col("aspect"))).alias("type_aspect"))
    return finalize(t.groupBy("type_aspect").agg(F.count(F.lit(1)).alias("n")))


def q_polarity_accuracy(spark, sf):
    return finalize(EV.accuracy(EV.eval_polarity(_eval_base(spark, sf))))


def q_lr_history(spark, sf):
    from ..operators import models as MD
    model = P.lr_train(P.polarity_training_set(labelled_reviews(spark, sf)))
    return finalize(MD.training_history(spark, model))


def q_production_split(spark, sf):
    import warnings
    lr = labelled_reviews(spark, sf).select("review_id", "polarity")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return finalize(SA.stratified_split(lr, "review_id", "polarity", production=True))


def q_label_encode(spark, sf):
    lr = labelled_reviews(spark, sf)
    return finalize(EV.label_index(lr, "polarity"))


def q_label_roundtrip(spark, sf):
    """Encode every label by the index, decode it again."""
    lr = labelled_reviews(spark, sf).select("review_id", "polarity")
    index = EV.label_index(lr, "polarity")
    back = EV.decode_labels(EV.encode_labels(lr, index, "polarity"), index, label_col="decoded")
    return finalize(back.select("review_id", "polarity", "label_id", "decoded"))


QUERIES: dict[str, Query] = {
    "clean_corpus": q_clean_corpus,
    "normalise_variants": q_normalise_variants,
    "sentence_table": q_sentence_table,
    "token_table": q_token_table,
    "annotate_tokens": q_annotate_tokens,
    "head_children": q_head_children,
    **{f"rule_r{n}": _rule_query(n) for n in range(1, 8)},
    "extract_aspects": q_extract_aspects,
    "extract_aspects_bucketed": q_extract_aspects_bucketed,
    "aspect_window": _window_query(False),
    "aspect_window_compat": _window_query(True),
    "entity_match": q_entity_match,
    "aspect_canonical": q_aspect_canonical,
    "rating_to_polarity": q_rating_to_polarity,
    "load_labelled_reviews": q_load_labelled_reviews,
    "length_iqr_filter": q_length_iqr_filter,
    "balance_binary": q_balance_binary,
    "polarity_training_set": q_polarity_training_set,
    "nb_train": q_nb_train,
    "polarity_score": q_polarity_score,
    "neutral_threshold": q_neutral_threshold,
    "lr_train": q_lr_train,
    "model_bundle": q_model_bundle,
    "predict_long": q_predict_long,
    "predict_flat": q_predict_flat,
    "reject_reviews": q_reject_reviews,
    "seeded_sample": q_seeded_sample,
    "stratified_split": q_stratified_split,
    "reviews_with_product": q_reviews_with_product,
    "nested_reviews_explode": q_nested_reviews_explode,
    "tag_extract": q_tag_extract,
    "parse_list_column": q_parse_list_column,
    "build_reviews": q_build_reviews,
    "read_tagged_reviews": q_read_tagged_reviews,
    "read_gold_xml": q_read_gold_xml,
    "read_app_reviews": q_read_app_reviews,
    "read_app_reviews_by_ranges": q_read_app_reviews_by_ranges,
    "read_gold_opinions": _opinions_query(False),
    "read_gold_opinions_compat": _opinions_query(True),
    "build_gold": q_build_gold,
    "bio_tags": q_bio_tags,
    "bio_clean": q_bio_clean,
    "bio_encode": q_bio_encode,
    "bio_status_counts": q_bio_status_counts,
    "bio_decode": q_bio_decode,
    "gold_quality_flags": q_gold_quality_flags,
    "token_length_filter": q_token_length_filter,
    "aspect_training_set": q_aspect_training_set,
    "token_features": q_token_features,
    "tagger_train": q_tagger_train,
    "tagger_predict": q_tagger_predict,
    "predict_aux": q_predict_aux,
    "predict_flat_aux": q_predict_flat_aux,
    "lr_invariants": q_lr_invariants,
    "classification_report": q_classification_report,
    "heldout_report": q_heldout_report,
    "confusion_matrix": q_confusion_matrix,
    "micro_f1": q_micro_f1,
    "roc_auc": q_roc_auc,
    "roc_curve": q_roc_curve,
    "seq_report": q_seq_report,
    "token_outcomes": q_token_outcomes,
    "error_flags": q_error_flags,
    "error_stats": q_error_stats,
    "error_stats_groupings": q_error_stats_groupings,
    "error_stats_out_of_fold": q_error_stats_out_of_fold,
    "tagger_out_of_fold": q_tagger_out_of_fold,
    "eval_run": q_eval_run,
    "eval_coverage": q_eval_coverage,
    "eval_polarity_report": q_eval_polarity_report,
    "heldout_confusion_matrix": q_heldout_confusion_matrix,
    "heldout_roc_auc": q_heldout_roc_auc,
    "metric_store": q_metric_store,
    "build_gold_sources": q_build_gold_sources,
    "gold_csv_rejects": q_gold_csv_rejects,
    "eval_polarity": q_eval_polarity,
    "eval_aspect": q_eval_aspect,
    "label_encode": q_label_encode,
    "label_roundtrip": q_label_roundtrip,
    "aspect_type_counts": q_aspect_type_counts,
    "polarity_accuracy": q_polarity_accuracy,
    "lr_history": q_lr_history,
    "production_split": q_production_split,
    "reviews_roundtrip": q_reviews_roundtrip,
    "reviews_manifest": q_reviews_manifest,
    "training_from_dataset": q_training_from_dataset,
    "predictions_csv": q_predictions_csv,
}
