"""Token counts with a whole-token shortcut.

Offline (on the driver, once per vocabulary file) every vocabulary string is run through
the merges alone; those that come out as one token are *proven*: a pre-token equal to one
of them counts 1, with no merging.  The set is bounded by the vocabulary (49 k strings) and
broadcast.  Only the remaining pre-tokens are merged; their counts are remembered in a
bounded table per worker.

Texts whose characters are all below U+0250 are normalised and split by Python's own string
methods (NFC leaves them alone, lower-casing works per character); the character classes
come from Unicode categories.  Any other text is normalised and split by the tokenizer
itself.  Special strings inside a text count as the special token they name.

Defined cases: null counts as empty; an empty text has 0 bytes and 0 tokens; null and
repeated ids give a row each; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .common import ready, texts_of

LIMIT = 2048
REMEMBERED = 400_000       # merged pre-tokens kept per worker (about 50 MB)
PLAIN_END = 0x250
END_OF_WORD = "</w>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies:
    printable Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


_ALPHABET = byte_alphabet()


def byte_level(s: str) -> str:
    return "".join([_ALPHABET[b] for b in s.encode()])


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (byte-level, without the end-of-word mark) that the merges turn
    into exactly one token when they stand alone."""
    tok = vocab.hf_tokenizer(path)
    words = {v.removesuffix(END_OF_WORD) for v in tok.get_vocab(with_added_tokens=False)}
    return frozenset(w for w in words if w and len(tok.model.tokenize(w)) == 1)


@lru_cache(maxsize=1)
def _plain_patterns():
    plain = "".join(map(chr, range(PLAIN_END)))
    cats = {c: unicodedata.category(c) for c in plain + plain.lower()}   # some lower-case beyond the range
    cls = lambda chars: "".join(re.escape(c) for c in chars)
    letters = cls(c for c, k in cats.items() if k[0] == "L")
    numbers = cls(c for c, k in cats.items() if k[0] == "N")
    # White_Space below U+0250; str.isspace also has the separators U+001C to U+001F
    space = cls("\t\n\x0b\x0c\r \x85\xa0")
    split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
    other = re.compile(f"[^\\x00-{chr(PLAIN_END - 1)}]")
    return split.findall, other.search


class _Counts(dict):
    """Pre-token -> number of tokens; missing ones are looked up among the proven strings,
    then merged, and remembered up to a bound."""

    def __init__(self, model, proven: frozenset[str], level):
        super().__init__()
        self.model, self.proven, self.level = model, proven, level

    def __missing__(self, piece: str) -> int:
        b = self.level(piece)
        n = 1 if b in self.proven else len(self.model.tokenize(b))
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = n
        return n


class Counter:
    """Counts the tokens of whole texts for one vocabulary file."""

    def __init__(self, path: str, proven: frozenset[str]):
        self.tok = vocab.hf_tokenizer(path)
        self.plain = _Counts(self.tok.model, proven, byte_level)
        self.levelled = _Counts(self.tok.model, proven, lambda s: s)
        specials = sorted(vocab.special_ids(path), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        self.split, self.beyond = _plain_patterns()

    def _segment(self, t: str) -> int:
        if self.beyond(t) is None:
            return sum(map(self.plain.__getitem__, self.split(t.lower())))
        norm = self.tok.normalizer.normalize_str(t)
        return sum(self.levelled[p] for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm))

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self._segment(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._segment, parts))


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    spark = ready(docs.sparkSession)
    path = path or vocab.default_path("word_bpe_49k.json")
    shared = spark.sparkContext.broadcast(prove_whole_tokens(path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path, shared.value)
        count = _COUNTERS[path].count
        for b in batches:
            n = [count(t) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], names=["i", "b", "n"])

    return (docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__t"),
                        F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("__b"))
            .mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
