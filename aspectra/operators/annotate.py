"""Sentence table, token table and the light annotator.

Partitioning plan: reviews are hash-partitioned by ``review_id`` once (the one shuffle
of the text path) *before* sentences and tokens are exploded, so every later window,
aggregate and self-join keyed by ``(review_id, sent_id, ...)`` finds its required
distribution already satisfied (a hash partitioning on ``review_id`` satisfies any
clustering that contains ``review_id``).  Ids keep the caller's type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX

SENT_KEYS = ["review_id", "sent_id"]


def _sent_window() -> Window:
    return Window.partitionBy(*SENT_KEYS).orderBy("i")


# ---------------------------------------------------------------------------------------
# Sentence table
# ---------------------------------------------------------------------------------------
def prepare_reviews(reviews: DataFrame, id_col: str = "review_id", text_col: str = "review_text",
                    num_partitions: int | None = None) -> DataFrame:
    """(review_id, review_text) hash-partitioned by review_id: the text path's one shuffle.

    Every later per-review / per-sentence operator (and a join back to this frame) reuses
    this partitioning.  Skip it (``assume_partitioned`` below) for tables already bucketed
    by the id.  Default partition count: ``session.text_partitions`` (input bytes / 4 MB,
    at least one per core).
    """
    from ..session import text_partitions
    S.require_columns(reviews, [id_col, text_col], "prepare_reviews")
    r = reviews.select(F.col(id_col).alias("review_id"),
                       F.col(text_col).alias("review_text"))
    # sized from the input files (not a fixed shuffle setting): the cached sentences and
    # tokens keep this partitioning for the rest of the text path
    return r.repartition(num_partitions or text_partitions(reviews), "review_id")


def spread(reviews: DataFrame, id_col: str = "review_id", text_col: str = "review_text") -> DataFrame:
    """(review_id, review_text) for the in-row path.  It needs no partitioning, but costs far more
    than a shuffle of the text, and files may come in a few row groups: an input of known size
    is spread once, by review_id, into many small tasks.  Streams and inputs of unknown size
    stay where they are."""
    from ..session import input_bytes
    S.require_columns(reviews, [id_col, text_col], "spread")
    if reviews.isStreaming or not 0 <= input_bytes(reviews) < 1 << 60:
        return reviews.select(F.col(id_col).alias("review_id"), F.col(text_col).alias("review_text"))
    return prepare_reviews(reviews, id_col, text_col)


def by_repeats(reviews: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Prepared reviews whose id comes once, and the others (ids that come more than once, and
    null ids), or None if there are none: reviews of one id share their sentence keys, so rows
    of such sentences cannot stand for one sentence each."""
    prepared = prepare_reviews(reviews)
    once = (F.col("_n") == 1) & F.col("review_id").isNotNull()
    counts = reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("_n"))
    if counts.filter(~once).isEmpty():
        return prepared, None
    counted = prepared.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("review_id")))
    return counted.filter(once).drop("_n"), counted.filter(~once).drop("_n")


def split_sentences(reviews: DataFrame, id_col: str = "review_id",
                    text_col: str = "review_text", exact_unicode: bool = False,
                    num_partitions: int | None = None,
                    assume_partitioned: bool = False) -> DataFrame:
    """One row per sentence: review_id, sent_id, sentence_raw, sentence (cleaned),
    matches (token matches), n_tokens.

    ``sent_id`` is the position of the piece in the raw split; blank pieces are dropped.
    Sentences whose cleaned text is empty are kept (they yield the all-null aspect row).
    """
    if assume_partitioned:
        r = reviews.select(F.col(id_col).alias("review_id"),
                           F.col(text_col).alias("review_text"))
    else:
        r = prepare_reviews(reviews, id_col, text_col, num_partitions)
    return (r.select("review_id",
                     F.posexplode(TX.sentence_pieces(F.col("review_text"))).alias("sent_id", "sentence_raw"))
            .filter(F.col("sentence_raw").rlike(r"\S"))
            # an inline of one struct: later filters on the cleaned text read it, they do not clean again
            .select(*SENT_KEYS, F.inline(F.array(F.struct("sentence_raw", TX.clean_text(F.col("sentence_raw"), exact_unicode)
                                                          .alias("sentence")))))
            .withColumn("matches", TX.token_matches(F.col("sentence")))
            .withColumn("n_tokens", F.size("matches")))


# ---------------------------------------------------------------------------------------
# T10 + W3: token table (review_id, sent_id, i, idx, text)
# ---------------------------------------------------------------------------------------
def tokenize(sentences: DataFrame) -> DataFrame:
    """Explode token matches; ``idx`` = char offset in the cleaned sentence (running sum
    of the lengths of the preceding matches, trailing space included)."""
    S.require_columns(sentences, SENT_KEYS + ["sentence"], "tokenize")
    matches = F.col("matches") if "matches" in sentences.columns else TX.token_matches(F.col("sentence"))
    t = (sentences.select(*SENT_KEYS, F.posexplode(matches).alias("i", "m"))
         .withColumn("m", F.replace(F.col("m"), F.lit(TX.NT_MARK), F.lit("")))
         .withColumn("text", F.trim(F.col("m"))))
    w = _sent_window().rowsBetween(Window.unboundedPreceding, -1)
    return (t.withColumn("idx", F.coalesce(F.sum(F.length("m")).over(w), F.lit(0)).cast("int"))
             .select(*SENT_KEYS, F.col("i").cast("int").alias("i"), "idx", "text"))


# ---------------------------------------------------------------------------------------
# Lexicon + suffix tagger
# ---------------------------------------------------------------------------------------
def token_kind(text: Column, lowered: bool = False) -> Column:
    low = text if lowered else F.lower(text)
    k = None
    for words, kind in ((S.LEX_DET, "det"), (S.LEX_BE, "be"), (S.LEX_MODAL, "modal"),
                        (S.LEX_NEG, "neg"), (S.LEX_PRON, "pron"), (S.LEX_INTJ, "intj")):
        cond = low.isin(words)
        k = F.when(cond, kind) if k is None else k.when(cond, kind)
    suffix_adj = None
    for suf in S.ADJ_SUFFIXES:
        c = low.endswith(suf)
        suffix_adj = c if suffix_adj is None else (suffix_adj | c)
    return (k.when(text.isin(list(S.PUNCT_CHARS)), "punct")
             .when(text.startswith("'"), "clitic")
             .when(text.rlike("^[0-9]+$"), "num")
             .when(low.endswith(S.ADV_SUFFIX), "adv")
             .when(suffix_adj, "adj")
             .when(low.endswith(S.VERB_SUFFIX), "verb")
             .otherwise("noun"))


_POS_TAG = {
    "det": ("DET", "DT"), "be": ("AUX", "VB"), "modal": ("AUX", "MD"), "neg": ("PART", "RB"),
    "pron": ("PRON", "PRP"), "intj": ("INTJ", "UH"), "punct": ("PUNCT", None),
    "clitic": ("PART", "POS"), "num": ("NUM", "CD"), "adv": ("ADV", "RB"),
    "adj": ("ADJ", "JJ"), "verb": ("VERB", "VBN"), "noun": ("NOUN", "NN"),
}


def _map_kind(kind: Column, which: int, text: Column) -> Column:
    e = None
    for k, pair in _POS_TAG.items():
        v = F.lit(pair[which]) if pair[which] is not None else text
        e = F.when(kind == k, v) if e is None else e.when(kind == k, v)
    return e


def tag_tokens(tokens: DataFrame) -> DataFrame:
    """Lemma (lower-case), kind, pos, tag, is_stop."""
    kind = token_kind(F.col("text"))
    return (tokens.withColumn("kind", kind)
            .withColumn("lemma", F.lower("text"))
            .withColumn("pos", _map_kind(F.col("kind"), 0, F.col("text")))
            .withColumn("tag", _map_kind(F.col("kind"), 1, F.col("text")))
            .withColumn("is_stop", F.lower("text").isin(S.STOP_WORDS)))


_WORD_END = r"(?:(?![A-Za-z0-9])|(?=n't))"


def _holds(sentence: Column, words=(), suffixes=()) -> Column:
    """Whether a token of the cleaned sentence may be one of the words or end in a suffix."""
    head = r"(?<![A-Za-z0-9])(?:" + "|".join(words) + ")" if words else "(?:" + "|".join(suffixes) + ")"
    return sentence.rlike("(?i)" + head + _WORD_END)


def may_find(sentence: Column, rule_no: int | None = None) -> Column:
    """False only for cleaned sentences in which the rule (or any of them) finds nothing, by the
    kinds of words it needs: R1 an adjective; R2-R7 a predicate (-ed verb, form of *be* or
    interjection) and what they take from it.  Holds for predicates re-tagged as interjections
    and forms of *be* re-tagged as copulas, too."""
    adj, adv = _holds(sentence, suffixes=S.ADJ_SUFFIXES), _holds(sentence, suffixes=[S.ADV_SUFFIX])
    be, intj, verb = _holds(sentence, S.LEX_BE), _holds(sentence, S.LEX_INTJ), _holds(sentence, suffixes=[S.VERB_SUFFIX])
    return {1: adj, 2: adj & verb, 3: adj & be, 4: adv & (be | verb | intj), 5: be & verb, 6: verb | intj, 7: be,
            None: be | adj | intj | (adv & verb)}[rule_no]


# ---------------------------------------------------------------------------------------
# Shallow dependency linker
# ---------------------------------------------------------------------------------------
def link_tokens(tagged: DataFrame) -> DataFrame:
    """Assign ``dep`` and ``head_i`` with windows over each clause (sentence cut at , ; :).

    Predicate of a clause: first -ed verb, else first form of *be*, else first
    interjection.  Subject: nearest noun/pronoun left of the predicate (one per
    predicate).  Then: det -> next noun; adjective followed (over adverbs/adjectives)
    by a noun -> amod of that noun; adjective after *be* -> acomp, after a verb -> dobj;
    first noun after *be* -> attr, after a verb -> dobj; adverb before an
    adjective/adverb -> advmod of it, otherwise advmod of the predicate; negation ->
    neg; modal -> aux (tag MD); *be* before a verb predicate -> auxpass and the subject
    becomes nsubjpass.  Tokens of a clause without predicate head themselves.
    """
    ws = _sent_window()
    sep = F.col("text").isin(list(S.CLAUSE_CHARS)).cast("int")
    t = tagged.withColumn(
        "clause_id",
        F.coalesce(F.sum(sep).over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # All clause windows share ONE order (position descending): whole-clause aggregates do
    # not depend on the order, "next token" is lag() in descending order, and "next X
    # after i" is a running minimum over the rows after i (incremental, linear in the
    # clause length; a "1 following .. unbounded following" frame would be re-aggregated
    # for every row).
    desc = Window.partitionBy(*SENT_KEYS, "clause_id").orderBy(F.col("i").desc())
    clause = desc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = desc.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("kind")
    pred_verb = F.min(F.when(kind == "verb", F.col("i"))).over(clause)
    pred_be = F.min(F.when(kind == "be", F.col("i"))).over(clause)
    pred_intj = F.min(F.when(kind == "intj", F.col("i"))).over(clause)
    head_like = ~kind.isin("adv", "adj")
    t = (t.withColumn("pred_i", F.coalesce(pred_verb, pred_be, pred_intj))
          .withColumn("next_i", F.lag("i").over(desc))
          .withColumn("next_kind", F.lag("kind").over(desc))
          .withColumn("next_noun_i", F.min(F.when(kind == "noun", F.col("i"))).over(after))
          .withColumn("_next_head", F.min(F.when(head_like, F.struct(F.col("i"), kind.alias("k")))).over(after))
          .withColumn("next_head_i", F.col("_next_head.i"))
          .withColumn("next_head_kind", F.col("_next_head.k")))
    pred_i = F.col("pred_i")
    t = (t.withColumn("pred_kind", F.max(F.when(F.col("i") == pred_i, kind)).over(clause))
          .withColumn("subj_i", F.max(F.when(kind.isin("noun", "pron") & (F.col("i") < pred_i),
                                             F.col("i"))).over(clause))
          .withColumn("be_before", F.max((kind == "be") & (F.col("i") < pred_i)).over(clause))
          .withColumn("first_noun_after", F.min(F.when((kind == "noun") & (F.col("i") > pred_i),
                                                       F.col("i"))).over(clause)))
    i = F.col("i")
    pk = F.col("pred_kind")
    after = i > pred_i
    to_pred = F.coalesce(pred_i, i)
    dep = (F.when(i == pred_i, "ROOT")
            .when(i == F.col("subj_i"),
                  F.when((pk == "verb") & F.col("be_before"), "nsubjpass").otherwise("nsubj"))
            .when(kind == "det", "det")
            .when((kind == "adj") & (F.col("next_head_kind") == "noun"), "amod")
            .when((kind == "adj") & after & (pk == "be"), "acomp")
            .when((kind == "adj") & after & (pk == "verb"), "dobj")
            .when((kind == "noun") & (i == F.col("first_noun_after")) & (pk == "be"), "attr")
            .when((kind == "noun") & (i == F.col("first_noun_after")) & (pk == "verb"), "dobj")
            .when(kind == "adv", "advmod")
            .when(kind == "neg", "neg")
            .when(kind == "modal", "aux")
            .when((kind == "be") & (pk == "verb") & (i < pred_i), "auxpass")
            .when(kind == "be", "aux")
            .when(kind == "punct", "punct")
            .otherwise("dep"))
    head = (F.when(i == pred_i, i)
             .when(F.col("dep") == "det", F.coalesce(F.col("next_noun_i"), pred_i, i))
             .when(F.col("dep") == "amod", F.col("next_head_i"))
             .when((F.col("dep") == "advmod") & F.col("next_kind").isin("adj", "adv"),
                   F.col("next_i"))
             .otherwise(to_pred))
    t = t.withColumn("dep", dep).withColumn("head_i", head.cast("int")).drop("_next_head")
    return t.select(*SENT_KEYS, "i", "idx", "text", "lemma", "pos", "tag", "dep",
                    "head_i", "is_stop")


def annotate(sentences: DataFrame) -> DataFrame:
    """T10 + N1 + N2: the token table with the schema of ``schema.TOKEN_SCHEMA``."""
    return link_tokens(tag_tokens(tokenize(sentences)))


# ---------------------------------------------------------------------------------------
# Capitalised-run entities
# ---------------------------------------------------------------------------------------
def entities(tokens: DataFrame) -> DataFrame:
    """Runs of consecutive capitalised tokens (not sentence-initial); the root of the
    entity is its last token.  Output: review_id, sent_id, root_idx, root_i, ent_text."""
    # gaps and islands over the (few) capitalised tokens only: a run starts where the
    # previous capitalised token is not the previous token
    cap = (F.col("i") > 0) & F.col("text").rlike("^[A-Z]")
    ws = _sent_window()
    t = (tokens.select(*SENT_KEYS, "i", "idx", "text").filter(cap)
         .withColumn("start", F.coalesce((F.col("i") - F.lag("i").over(ws) != 1).cast("int"), F.lit(1)))
         .withColumn("run", F.sum("start").over(ws.rowsBetween(Window.unboundedPreceding, 0))))
    # Adjacent alphanumeric tokens are always one space apart in cleaned text, so the
    # span text is the run's tokens joined by a space.
    g = (t.groupBy(*SENT_KEYS, "run")
         .agg(F.max(F.struct("i", "idx")).alias("last"),
              F.array_sort(F.collect_list(F.struct("i", "text"))).alias("parts")))
    return g.select(*SENT_KEYS,
                    F.col("last.idx").alias("root_idx"), F.col("last.i").alias("root_i"),
                    F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("ent_text"))


def annotate_corpus(reviews: DataFrame, id_col: str = "review_id", text_col: str = "review_text",
                    materialize: bool = True, exact_unicode: bool = False,
                    assume_partitioned: bool = False):
    """Reviews -> (prepared reviews, sentences, tokens).

    Sentences and tokens are read by many branches (rules, windows, scores).  With
    ``materialize`` they are persisted (memory and disk) once.  Persisting keeps their
    review_id hash partitioning, so the later aggregates and self-joins stay
    exchange-free (a checkpoint would drop that partitioning); the lineage behind them
    is short (scan -> one shuffle -> narrow ops -> windows), so a lost executor only
    recomputes its own partitions.
    """
    from pyspark import StorageLevel
    if assume_partitioned:  # e.g. a table bucketed by the id: no shuffle at all
        prepared = reviews.select(F.col(id_col).alias("review_id"), F.col(text_col).alias("review_text"))
    else:
        prepared = prepare_reviews(reviews, id_col, text_col)
    sentences = split_sentences(prepared, assume_partitioned=True, exact_unicode=exact_unicode)
    tokens = annotate(sentences)
    if materialize:
        # cache only what later steps read: keys, cleaned text, token count
        sentences = sentences.select(*SENT_KEYS, "sentence", "n_tokens").persist(StorageLevel.MEMORY_AND_DISK)
        sentences.count()
        tokens = annotate(sentences).persist(StorageLevel.MEMORY_AND_DISK)
        tokens.count()
    return prepared, sentences, tokens


def word_corpus(reviews: DataFrame, id_col: str = "review_id", text_col: str = "review_text") -> tuple[DataFrame, DataFrame]:
    """Reviews -> (sentences, words), persisted like ``annotate_corpus``, for readers of the words
    alone: sentences are keys and token counts, words are keys, i and text, without tags and links."""
    from pyspark import StorageLevel
    s = split_sentences(reviews, id_col, text_col).select(*SENT_KEYS, "n_tokens", "matches")
    words = s.select(*SENT_KEYS, F.posexplode("matches").alias("i", "m"))
    words = words.select(*SENT_KEYS, F.col("i").cast("int").alias("i"),
                         F.trim(F.replace(F.col("m"), F.lit(TX.NT_MARK), F.lit(""))).alias("text"))
    parts = tuple(d.persist(StorageLevel.MEMORY_AND_DISK) for d in (s.drop("matches"), words))
    for d in parts:
        d.count()
    return parts
