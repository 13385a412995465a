"""Schemas, label canon and fixed values.

Everything in the "FIXED VALUES" blocks must keep these exact spellings for results to
line up with the behaviour being reproduced (label strings, rule ids, pronoun list,
BIO alphabet, annotation status markers, thresholds).  Lexicons of the light annotator
are this project's own choice and are marked as such.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# FIXED VALUES (behaviour contract)
# --------------------------------------------------------------------------------------
# Polarity labels, canonical lower-case spelling used everywhere in this package.
POSITIVE = "positive"
NEGATIVE = "negative"
NEUTRAL = "neutral"
CONFLICT = "conflict"
POLARITY_LABELS = [POSITIVE, NEGATIVE, NEUTRAL, CONFLICT]

# Rating -> polarity bounds used for nested hotel-style reviews: v <= 2 negative,
# 2 < v < 3 neutral, v >= 3 positive.
RATING_MIN = 2.0
RATING_MAX = 3.0

# Neutral band: a prediction keeps its label only if its probability is >= 0.7.
NEUTRAL_THRESHOLD = 0.7

# Text-window sizes: 6 tokens on the main path, 7 on the auxiliary (tagger) path.
WINDOW_MAIN = 6
WINDOW_AUX = 7

# Pronouns reported as the aspect "product" (case-sensitive, exact match).
PRODUCT_PRONOUNS = ["it", "this", "they", "these"]
PRODUCT_ASPECT = "product"

# Rule ids in emission order.  The interjection rule (6) is emitted as "r5" in compat mode.
RULE_IDS = ["r1", "r2", "r3", "r4", "r5", "r6", "r7"]
COMPAT_RULE6_ID = "r5"

# BIO alphabet and its integer codes O=0, B=1, I=2.
BIO_TAGS = ["O", "B", "I"]
# Annotation status values; the last three are the rejected ones.
STATUS_OK = "ok"
STATUS_IMPLICIT = "implicit_aspect"
STATUS_CORRUPTED = "corrupted"
STATUS_MULTI = "aspect_multi_occurrence"
REJECT_STATUSES = [STATUS_IMPLICIT, STATUS_CORRUPTED, STATUS_MULTI]
NULL_ASPECT = "NULL"
# Aspect-type flag values.
ASPECT_FLAG_TRUE = "aspect"
ASPECT_FLAG_FALSE = "non_aspect"
# Decoded tagger output when nothing was tagged.
NO_ASPECT = "None"

# Length limits: aspect training sentences keep <= 32 word pieces; evaluation subsets.
TAGGER_MAX_TOKENS = 32
EVAL_POLARITY_MIN_WORDS = 5
EVAL_ASPECT_MAX_WORDS = 15

# Synonym dictionaries (canonical name -> synonyms), products and features.
PRODUCT_SYNONYMS = {
    "generic": ["product", "item", "article"],
    "iphone": ["iphone", "iphone12"],
    "restaurant": ["restaurant"],
}
FEATURE_SYNONYMS = {
    "battery": ["duration", "cell"],
    "keyboard": ["keys", "keyboard"],
}

# Seeds: sample of 100 rows with seed 1; 80/20 split with seed 100.
SAMPLE_SEED = 1
SAMPLE_SIZE = 100
SPLIT_SEED = 100
VALID_FRACTION = 0.2

# --------------------------------------------------------------------------------------
# FIXED VALUES (Apache Spark's default English stop-word list,
# pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english"), 181 words).
# Kept inline so the DuckDB oracle can use the very same list without a JVM.
# --------------------------------------------------------------------------------------
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

# --------------------------------------------------------------------------------------
# Light annotator lexicon (this project's own closed-class table; word -> pos, tag, kind)
# --------------------------------------------------------------------------------------
LEX_DET = ["a", "an", "the", "no", "this", "that", "these", "those"]
LEX_BE = ["is", "are", "was", "were", "be", "been", "am"]
LEX_MODAL = ["could", "would", "should", "might", "may", "can", "will", "must"]
LEX_NEG = ["not", "never", "n't"]
LEX_PRON = ["i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us", "them"]
LEX_INTJ = ["ok", "wow", "bravo", "great", "thanks"]
ADJ_SUFFIXES = ["ble", "ful", "ous", "ive", "less"]
ADV_SUFFIX = "ly"
VERB_SUFFIX = "ed"
PUNCT_CHARS = "(),:;!?'`"
CLAUSE_CHARS = ",;:"


def lexicon_rows() -> list[tuple[str, str, str, str]]:
    """(word, pos, tag, kind) rows of the closed-class lexicon; first listing wins."""
    rows: dict[str, tuple[str, str, str, str]] = {}
    for words, pos, tag, kind in (
        (LEX_DET, "DET", "DT", "det"),
        (LEX_BE, "AUX", "VB", "be"),
        (LEX_MODAL, "AUX", "MD", "modal"),
        (LEX_NEG, "PART", "RB", "neg"),
        (LEX_PRON, "PRON", "PRP", "pron"),
        (LEX_INTJ, "INTJ", "UH", "intj"),
    ):
        for w in words:
            rows.setdefault(w, (w, pos, tag, kind))
    return list(rows.values())


# --------------------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------------------
REVIEW_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("polarity", T.StringType()),
])

POSITION_TYPE = T.StructType([T.StructField("start", T.IntegerType()),
                              T.StructField("end", T.IntegerType())])

GOLD_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("aspect", T.ArrayType(T.StringType())),
    T.StructField("polarity", T.ArrayType(T.StringType())),
    T.StructField("source", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("position", T.ArrayType(POSITION_TYPE)),
])

TOKEN_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("sent_id", T.IntegerType()),
    T.StructField("i", T.IntegerType()),
    T.StructField("idx", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("lemma", T.StringType()),
    T.StructField("pos", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("dep", T.StringType()),
    T.StructField("head_i", T.IntegerType()),
    T.StructField("is_stop", T.BooleanType()),
])


def require_columns(df, columns, where: str = "") -> None:
    """Raise when ``df`` lacks any of ``columns`` (checked at the head of each operator)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where or 'operator'}: missing required columns {missing}; "
                         f"got {df.columns}")
