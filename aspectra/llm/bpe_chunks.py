"""Byte-level BPE encoding by overlapping chunks, and decoding by concatenating raw bytes.

A document longer than ``chunk_chars`` is cut into chunks that overlap by ``overlap``
characters:

1. every chunk is pre-tokenised on its own.  The first chunk starts right; a later one may
   start inside a pre-token, so its first boundaries may be wrong;
2. chunks are stitched where the boundaries of neighbours resynchronise: the pattern looks
   only forward, so once a chunk's scan shares one boundary with its (right) predecessor,
   all its later boundaries are right too.  A boundary counts only if the character before
   it is not white space (cutting inside a white-space run would change the look-ahead) and
   if it lies clear of the chunk's end;
3. the pieces between stitches are encoded independently and their ids concatenated.

Documents of at most ``spread_chars`` go through these steps where they are read, many
documents in parallel, and nothing is shuffled.  Longer ones send their chunks, of
``spread_chars`` characters, over the cluster, so that no task holds the work of one huge
text.  Both ways share the scan and the stitching rule.

A document in which two neighbours share no boundary (one run of letters longer than the
overlap) is encoded as one piece, so the result is always exact.

Defined cases: null and empty texts give no ids; repeated rows are separate documents
(rows are numbered, ids need not be unique or present); an empty table gives no rows; other
columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vocab
from .common import cut_lineage, ready, text_or_empty, texts_of

CHUNK_CHARS = 4_096
OVERLAP = 512
SPREAD_CHARS = 65_536  # longer documents, and their chunks, are spread over the cluster
SPREAD_OVERLAP = 4_096
SAFE_END = 4           # a contraction such as 'll may be cut within the last three characters


@lru_cache(maxsize=2)
def _pattern():
    import regex
    return regex.compile(vocab.split_pattern())


def cut_points(chunk: str, first: bool, last: bool, size: int, overlap: int) -> tuple[list[int], list[int]]:
    """Ends of pre-tokens where a chunk may be cut: those within its first ``overlap``
    characters (shared with its predecessor) and those within the ``overlap`` characters
    after its first ``size`` (shared with its successor)."""
    safe = len(chunk) if last else len(chunk) - SAFE_END
    stop = min(overlap, safe) if last else min(size + overlap, safe)
    ends = []
    for m in _pattern().finditer(chunk):
        e = m.end()
        if e >= stop:
            break
        if (e < overlap or e > size) and not chunk[e - 1].isspace():
            ends.append(e)
    return ([0] if first else _preferred(chunk, [e for e in ends if e < overlap]),
            [] if last else _preferred(chunk, [e for e in ends if e > size]))


def _preferred(text: str, ends: list[int]) -> list[int]:
    """Boundaries before a space or newline, if any: they hold whatever precedes them."""
    return [e for e in ends if text[e] in " \n"] or ends


def pieces_of(text: str, chunk: int, overlap: int) -> list[str]:
    """The pieces of a text between the stitches of its chunks."""
    if len(text) <= chunk:
        return [text]
    cuts, tail = [0], []
    for start in range(0, len(text), chunk):
        last = start + chunk >= len(text)
        head, after = cut_points(text[start:start + chunk + overlap], not start, last, chunk, overlap)
        if start:
            common = set(tail).intersection(start + e for e in head)
            if not common:
                return [text]
            cuts.append(min(common))
        tail = [start + e for e in after]
    return [text[x:y] for x, y in zip(cuts, cuts[1:] + [len(text)])]


def encode_bytes(texts, ranks_path: str, chunk: int, overlap: int):
    enc = vocab.rank_encoding(ranks_path)
    return [np.concatenate([np.array(enc.encode_ordinary(p), dtype="<u4") for p in pieces_of(t, chunk, overlap)]).tobytes()
            for t in texts]


def decode_bytes(ids: bytes, ranks_path: str) -> bytes:
    return b"".join(map(_byte_table(ranks_path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _byte_table(ranks_path: str) -> dict[int, bytes]:
    return {i: b for b, i in vocab.ranks(ranks_path).items()}


def _encode_column(ranks_path: str, pos: int, chunk: int, overlap: int):
    def run(batches):
        for b in batches:
            ids = encode_bytes(texts_of(b.column(pos)), ranks_path, chunk, overlap)
            cols = [b.column(i) for i in range(b.num_columns) if i != pos] + [pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])
    return run


def _bound_rows(chunk: int, overlap: int):
    def run(batches):
        for b in batches:
            heads, tails = [], []
            for start, last, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), texts_of(b.column(4))):
                head, tail = cut_points(t, not start, last, chunk, overlap)
                heads.append([start + e for e in head])
                tails.append([start + e for e in tail])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=["k", "no", "head", "tail"])
    return run


def _long_pieces(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(k, no, piece): exact pieces of the long documents; rows has (k, t)."""
    n = F.length("t")
    chunks = cut_lineage(
        rows.select("k", "t", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))).alias("no"))
        .select("k", "no", (F.col("no") * chunk).alias("start"),
                ((F.col("no") + 1) * chunk >= F.col("n")).alias("last"),
                F.expr(f"substring(t, no * {chunk} + 1, {chunk + overlap})").alias("c")))
    spread = chunks.repartition("k", "no")
    bounds = spread.mapInArrow(_bound_rows(chunk, overlap), "k long, no int, head array<int>, tail array<int>")
    w = Window.partitionBy("k").orderBy("no")
    sync = F.when(F.col("no") == 0, 0).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(w))))
    cuts = bounds.select("k", "no", sync.alias("cut")).select(
        "k", "no", "cut", F.lead("cut").over(w).alias("next"),
        F.min(F.col("cut").isNotNull()).over(Window.partitionBy("k")).alias("whole"))
    joined = chunks.join(cuts, ["k", "no"])
    pieces = joined.filter("whole").select(
        "k", "no", F.expr("substring(c, cut - start + 1, coalesce(next, start + length(c)) - cut)").alias("piece"))
    # no common boundary somewhere: the document is put together again, as the row it was
    parts = F.sort_array(F.collect_list(F.struct("no", F.expr(f"substring(c, 1, {chunk})").alias("c"))))
    rest = (joined.filter("NOT whole").groupBy("k").agg(parts.alias("p"))
            .select("k", F.lit(0).alias("no"), F.array_join(F.col("p.c"), "").alias("piece")))
    return pieces.unionByName(rest)


def _in_place_and_spread(docs: DataFrame, id_col: str, text_col: str, path: str, chunk_chars: int, overlap: int,
                         spread_chars: int, spread_overlap: int) -> tuple[DataFrame, DataFrame]:
    """The documents to be encoded where they are read, as (id, t), and the ids of the longer
    ones, as (id, ids)."""
    if not SAFE_END < overlap <= chunk_chars or not SAFE_END < spread_overlap <= spread_chars:
        raise ValueError("an overlap must exceed 4 and be at most its chunk's size")
    ready(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))
    fits = F.length("t") <= spread_chars
    # long documents are numbered once; the numbers are fixed by the checkpoint
    long = cut_lineage(rows.filter(~fits).withColumn("k", F.monotonically_increasing_id()))
    coded = (_long_pieces(long.select("k", "t"), spread_chars, spread_overlap).repartition("k", "no")
             .mapInArrow(_encode_column(path, 2, chunk_chars, overlap), "k long, no int, ids binary"))
    whole = (coded.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("p"))
             .select("k", F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids")))
    return rows.filter(fits), long.select("id", "k").join(whole, "k").select("id", "ids")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
           spread_chars: int = SPREAD_CHARS, spread_overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """One row per document: its id and ``ids``, the token ids as little-endian uint32 bytes."""
    path = ranks_path or vocab.default_path("byte_bpe_multi_50k.tiktoken")
    rows, spread = _in_place_and_spread(docs, id_col, text_col, path, chunk_chars, overlap, spread_chars, spread_overlap)
    id_type = docs.schema[id_col].dataType.simpleString()
    here = rows.mapInArrow(_encode_column(path, 1, chunk_chars, overlap), f"id {id_type}, ids binary")
    return here.unionByName(spread).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """The columns of ``encoded`` with ``ids`` replaced by ``bytes``: the raw text bytes."""
    path = ranks_path or vocab.default_path("byte_bpe_multi_50k.tiktoken")
    others = [c for c in encoded.columns if c != ids_col]

    def run(batches):
        for b in batches:
            raw = [None if i is None else decode_bytes(i, path) for i in b.column(len(others)).to_pylist()]
            cols = [b.column(i) for i in range(len(others))] + [pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))])

    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in others)
    return encoded.select(*[f"`{c}`" for c in others], f"`{ids_col}`").mapInArrow(
        run, (schema + ", " if schema else "") + "bytes binary")


def _digests(keys, coded, path: str) -> pa.RecordBatch:
    """Digests of a batch of encoded documents and of the bytes that they decode to."""
    names = _names(path).__getitem__
    n, ids, raw = [], [], []
    for c in coded:
        n.append(len(c) // 4)
        ids.append(hashlib.sha256(",".join(map(names, np.frombuffer(c, "<u4").tolist())).encode()).hexdigest())
        raw.append(hashlib.sha256(decode_bytes(c, path)).hexdigest())
    return pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                                      names=["id", "n", "i", "d"])


@lru_cache(maxsize=2)
def _names(ranks_path: str) -> dict[int, str]:
    return {i: str(i) for i in vocab.ranks(ranks_path).values()}


_DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip_digests(encoded: DataFrame, id_col: str = "doc_id", ranks_path: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    path = ranks_path or vocab.default_path("byte_bpe_multi_50k.tiktoken")
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield _digests(b.column(0), b.column(1).to_pylist(), path)

    return encoded.select(f"`{id_col}`", "ids").mapInArrow(run, f"`{id_col}` {id_type}, {_DIGESTS}")


def encode_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
                      chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
                      spread_chars: int = SPREAD_CHARS, spread_overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """``round_trip_digests`` of ``encode``, with both steps in one Python worker for texts
    that are encoded where they are read: one copy of the vocabulary a core, and no ids sent
    between workers."""
    path = ranks_path or vocab.default_path("byte_bpe_multi_50k.tiktoken")
    rows, spread = _in_place_and_spread(docs, id_col, text_col, path, chunk_chars, overlap, spread_chars, spread_overlap)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield _digests(b.column(0), encode_bytes(texts_of(b.column(1)), path, chunk_chars, overlap), path)

    here = rows.mapInArrow(run, f"id {id_type}, {_DIGESTS}")
    return here.unionByName(round_trip_digests(spread, "id", path)).withColumnRenamed("id", id_col)
