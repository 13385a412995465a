"""Packing of documents into token windows: best-fit decreasing.

A document's ids plus one separator id are first cut into full windows; each full window is
a sequence of its own.  The rest (shorter than a window) is packed best-fit decreasing: the
rests of a block are taken longest first, and a segment tree indexed by remaining capacity
finds the tightest open window that still has room.  Windows that end with a gap of at
least ``MIN_CUT`` tokens are then topped up by cutting the pieces of the emptiest ones.

Every task packs the documents it reads, in blocks of ``BLOCK`` rests (at most 32 MB of
ids), so no ids are shuffled and memory is bounded whatever the input; a sequence id holds
the task's number and a counter, so it is unique in the result.  Re-run tasks give the same
rows for the same input split.

Token ids are those of the tokenizers library.  For texts of common scripts they come from
the same vocabulary's rank file, unit by unit between single spaces, which gives equal ids;
other texts go through the tokenizers library.  Special strings give their special id.

Defined cases: null counts as empty; an empty text is the separator alone; repeated rows
are separate documents; ties in length keep the input order; an empty table gives no rows;
other columns are dropped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .common import ready, texts_of

WINDOW = 1024
SEPARATOR = 0
BLOCK = 8_192          # rests packed together: at most BLOCK * WINDOW ids are held
MIN_CUT = 64           # a gap this large is worth cutting a document once more
REMEMBERED = 300_000   # encoded units kept per worker

# Scripts whose letters, digits and spaces are classed alike by both libraries.
_RARE = re.compile("[^\u0000-ɏ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]")


# A space between white space (or last after white space) belongs to a run that only the
# whole text can split.
_RUN = re.compile(r"\s (?:\s|\Z)")


class _Units(dict):
    """Text between single spaces (with the leading space) -> its ids as bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.encode(unit), dtype="<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[unit] = ids
        return ids


class Ids:
    """ids(text): little-endian uint32 bytes, equal to the tokenizers library's ids."""

    def __init__(self, json_path: str, ranks_path: str):
        self.hf = vocab.hf_tokenizer(json_path)
        self.fast = vocab.rank_encoding(ranks_path).encode_ordinary
        self.units = _Units(self.fast)
        self.specials = vocab.special_ids(json_path)
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")

    def _plain(self, t: str) -> bytes:
        if _RUN.search(t):
            return np.array(self.fast(t), dtype="<u4").tobytes()
        first, *rest = t.split(" ")
        if rest and not rest[-1]:          # a final space stands alone
            rest.pop()
            return self._join(first, rest) + self.units[" "]
        return self._join(first, rest)

    def _join(self, first: str, rest: list[str]) -> bytes:
        get = self.units.__getitem__
        return (get(first) if first else b"") + b"".join([get(" " + u) for u in rest])

    def __call__(self, text: str) -> bytes:
        if _RARE.search(text):
            return np.array(self.hf.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.special.split(text):
            out.append(np.array([self.specials[part]], dtype="<u4").tobytes() if part in self.specials
                       else self._plain(part))
        return b"".join(out)


class CapacityTree:
    """Segment tree over remaining capacities 0..size: counts of open windows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        i = self.leaves + capacity
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """Smallest capacity >= need that an open window has, or -1."""
        i, count = self.leaves + need, self.count
        if count[i]:
            return need
        while i > 1 and (i & 1 or not count[i + 1]):
            i >>= 1
        if i <= 1:
            return -1
        i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of item numbers; every length is in 1..window."""
    tree, open_by = CapacityTree(window), [[] for _ in range(window + 1)]
    windows: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        room = tree.tightest(n)
        if room < 0:
            w, room = len(windows), window
            windows.append([item])
        else:
            w = open_by[room].pop()
            tree.add(room, -1)
            windows[w].append(item)
        if room > n:
            open_by[room - n].append(w)
            tree.add(room - n, 1)
    return windows


def top_up(windows: list[list[tuple]], window: int, min_cut: int) -> list[list[tuple]]:
    """Cut the pieces (item, start, length) of the emptiest windows into large gaps."""
    used = [sum(p[2] for p in w) for w in windows]
    order = sorted((i for i in range(len(windows)) if window - used[i] >= min_cut), key=lambda i: used[i])
    lo, hi = 0, len(order) - 1
    while lo < hi:
        give, take = windows[order[lo]], windows[order[hi]]
        gap = window - used[order[hi]]
        if not gap:
            hi -= 1
            continue
        if not give:
            lo += 1
            continue
        item, start, n = give.pop()
        part = min(n, gap)
        take.append((item, start, part))
        used[order[hi]] += part
        used[order[lo]] -= part
        if n > part:
            give.append((item, start + part, n - part))
    return [w for w in windows if w]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         separator: int = SEPARATOR, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian uint32 bytes), doc_tokens,
    sequence_id, offset."""
    ready(docs.sparkSession)
    json_path = json_path or vocab.default_path("byte_bpe_50k.json")
    ranks_path = ranks_path or vocab.default_path("byte_bpe_50k.tiktoken")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        ids_of = _worker_ids(json_path, ranks_path)
        end = np.array([separator], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rests: list[tuple] = []           # (id, start, ids, doc_tokens)
        out: list[tuple] = []

        def settle():
            nonlocal sequence
            sizes = [len(r[2]) // 4 for r in rests]
            wins = [[(i, 0, sizes[i]) for i in w] for w in best_fit_decreasing(sizes, window)]
            for w in top_up(wins, window, MIN_CUT):
                at = 0
                for i, start, n in w:
                    doc, base, ids, total = rests[i]
                    out.append((doc, base + start, n, ids[4 * start:4 * (start + n)], total, sequence, at))
                    at += n
                sequence += 1
            rests.clear()

        def batch(rows):
            cols = list(zip(*rows))
            types = [id_arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list("abcdefg"))

        id_arrow = None
        for b in batches:
            id_arrow = b.schema.field(0).type
            for doc, t in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                ids = ids_of(t) + end
                total = len(ids) // 4
                cut = total - total % window
                for start in range(0, cut, window):
                    out.append((doc, start, window, ids[4 * start:4 * (start + window)], total, sequence, 0))
                    sequence += 1
                if cut < total:
                    rests.append((doc, cut, ids[4 * cut:], total))
                if len(rests) >= BLOCK:
                    settle()
                if len(out) >= 2048:
                    yield batch(out)
                    out.clear()
        settle()
        for i in range(0, len(out), 2048):
            yield batch(out[i:i + 2048])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__t")).mapInArrow(
        run, f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


_IDS: dict[tuple, Ids] = {}


def _worker_ids(json_path: str, ranks_path: str) -> Ids:
    key = json_path, ranks_path
    if key not in _IDS:
        _IDS[key] = Ids(json_path, ranks_path)
    return _IDS[key]
