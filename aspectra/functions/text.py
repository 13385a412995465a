"""Text column expressions.

All functions map ``Column -> Column`` and use only built-in Spark SQL functions, so
they stay inside whole-stage codegen.  The one optional Python path is
``fold_accents_exact`` (Arrow-batched pandas UDF) for full NFKD parity on rare
compatibility characters.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sentence boundary: ., ! or ? followed by whitespace.  Written with an explicit class so
# Java regex and RE2 (the DuckDB oracle) agree.
SENTENCE_BOUNDARY = r"([.!?])[ \t\n\r\f]+"
SENT_MARK = "\u0001"
# Character whitelist of the cleaner: everything else becomes one space.
NON_WHITELIST = r"[^A-Za-z0-9(),:;!?'`]"
# Marker put in front of "n't" so the token pattern can split "wasn't" into was + n't.
NT_MARK = "\u0002"
TOKEN_PATTERN = ("(" + NT_MARK + "?n't|'(?:s|ve|re|d|ll|m)\\b|[A-Za-z0-9]+|[(),:;!?'`]) ?")


# ---------------------------------------------------------------------------------------
# T2 accent folding
# ---------------------------------------------------------------------------------------
@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from_chars, to_chars, expansions) derived from Unicode NFKD by rule, over every
    code point.

    Characters whose NFKD form reduces to exactly one ASCII character go into a single
    ``translate``; those that reduce to several become a lookup per character, used for
    the rows that hold one; every other non-ASCII character is deleted afterwards, which
    is what NFKD + ASCII-ignore does.
    """
    src, dst, exp = [], [], []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            exp.append((ch, folded))
    return "".join(src), "".join(dst), tuple(exp)


def fold_accents(col: Column) -> Column:
    """NFKD + drop non-ASCII, as column expressions (no UDF)."""
    src, dst, exp = accent_tables()
    table = F.create_map(*[F.lit(x) for pair in exp for x in pair])
    chars = F.regexp_extract_all(col, F.lit("(?s)."), F.lit(0))
    expanded = F.array_join(F.transform(chars, lambda c: F.when(c < "\u0080", c).otherwise(
        F.coalesce(F.element_at(table, c), c))), "")
    # cheap presence test for the rare multi-character expansions (a translate that
    # deletes them shortens the text), instead of a regex scan
    exp_chars = "".join(ch for ch, _ in exp)
    has_exp = F.length(F.translate(col, exp_chars, "")) < F.length(col)
    x = F.when(has_exp, expanded).otherwise(col)
    x = F.translate(x, src, dst)
    # pure ASCII text (as many bytes as characters) stays as it is
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(F.regexp_replace(x, r"[^\x00-\x7F]", ""))


@F.pandas_udf(T.StringType())
def fold_accents_exact(s):  # pragma: no cover - exercised in tests only
    """Exact NFKD + ASCII-ignore, vectorised over Arrow batches (parity path)."""
    return s.map(lambda v: None if v is None else
                 unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode())


# ---------------------------------------------------------------------------------------
# T1-T8 cleaning
# ---------------------------------------------------------------------------------------
# ASCII characters outside the whitelist (T3 on text that is already pure ASCII).
_ASCII_NON_WHITELIST = "".join(chr(c) for c in range(128)
                               if not (chr(c).isascii() and (chr(c).isalnum() or chr(c) in "(),:;!?'`")))


def clean_text(col: Column, exact_unicode: bool = False) -> Column:
    """T1 = T2 -> T3 -> T4; null stays null.

    After T2 the text is pure ASCII, so T3 is a ``translate`` of the non-whitelisted
    ASCII characters to spaces (same result as the regex, one pass, no backtracking),
    and T4 only has runs of spaces left to squeeze."""
    folded = fold_accents_exact(col) if exact_unicode else fold_accents(col)
    spaced = F.translate(folded, _ASCII_NON_WHITELIST, " " * len(_ASCII_NON_WHITELIST))
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def to_lower(col: Column) -> Column:
    """T5."""
    return F.lower(col)


ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def delete_punctuation(col: Column) -> Column:
    """Delete ASCII punctuation characters."""
    return F.translate(col, ASCII_PUNCT, "")


def split_contractions(col: Column) -> Column:
    """Put a space before 's 've n't 're 'd 'll (applied in this order)."""
    x = col
    for pat, rep in (("'s", " 's"), ("'ve", " 've"), ("n't", " n't"),
                     ("'re", " 're"), ("'d", " 'd"), ("'ll", " 'll")):
        x = F.replace(x, F.lit(pat), F.lit(rep))
    return x


def space_punctuation(col: Column) -> Column:
    """Surround , ! ( ) ? with spaces (without the stray backslash slip)."""
    return F.regexp_replace(col, r"([,!()?])", " $1 ")


def word_count(col: Column) -> Column:
    """Number of whitespace-separated words (0 for empty text), as bigint."""
    t = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, " "))).cast("bigint")


def parse_list_literal(col: Column) -> Column:
    """T20: "['a', \"chef's\"]" -> array('a', "chef's"); null when the text is not a list
    of quoted strings.  Items are in single or double quotes with backslash escapes."""
    item = r"(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'" + r'|"[^"\\]*+(?:\\.[^"\\]*+)*+")'
    is_list = col.rlike(rf"(?s)^\s*\[\s*(?:{item}\s*(?:,\s*{item}\s*)*+)?\]\s*$")
    items = F.regexp_extract_all(col, F.lit("(?s)" + item), F.lit(0))

    def value(x: Column) -> Column:
        v = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("\\\\"), F.lit(NT_MARK))
        for esc, ch in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")):
            v = F.replace(v, F.lit(esc), F.lit(ch))
        return F.replace(F.regexp_replace(v, r"\\(.)", "$1"), F.lit(NT_MARK), F.lit("\\"))

    return F.when(is_list, F.transform(items, value))


# ---------------------------------------------------------------------------------------
# T9 / T10 splitting
# ---------------------------------------------------------------------------------------
def sentence_pieces(col: Column) -> Column:
    """Split raw text after ., ! or ? followed by whitespace (keeps the mark)."""
    return F.split(F.regexp_replace(col, SENTENCE_BOUNDARY, "$1" + SENT_MARK), SENT_MARK)


def token_matches(col: Column) -> Column:
    """Token matches (with their trailing space) that tile the cleaned text."""
    return F.regexp_extract_all(_marked(col), F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(col: Column) -> Column:
    """The number of ``token_matches`` of a cleaned text: they tile it, so one mark for each is left."""
    return F.length(F.regexp_replace(_marked(col), TOKEN_PATTERN, "."))


def _marked(col: Column) -> Column:
    return F.regexp_replace(col, r"n't\b", NT_MARK + "n't")
