"""Periodic runs of words by an enhanced suffix array.

A *run* is a stretch of consecutive words with smallest period q that no neighbouring word
extends keeping that period, at least ``MIN_LENGTH`` words and two periods long.

1. *Suffix array.*  The words of a group of texts become numbers; all their suffixes are
   sorted at once by prefix doubling, text by text, and every round touches only suffixes
   that are not unique yet in their text.  ISA is the inverse, LCP the lengths that
   neighbouring suffixes share.  A run repeats at least ``MIN_LENGTH`` / 2 words, so a text
   whose LCP stays below has none.
2. *Branching squares.*  A square (two copies of a period side by side, at i and i + q) that
   cannot be rotated right is a pair of suffixes that share exactly q words.  For each
   position of the LCP array, of value d, the interval of suffixes that share d words is cut
   into two sides there; of the smaller side, every suffix i asks through ISA whether i + d
   or i - d lies on the other side.  Intervals are index pairs: no tree nodes are made, and
   a suffix is asked about at most log2(n) times.
3. *Runs.*  A run's last square is branching; rotating it left as far as words agree gives
   the run.  Squares are taken by ascending period, so a square of a multiple of the period
   is recognised by its end and merged.

Texts are independent: no shuffle.  A task holds one Arrow batch of texts and the arrays of
one group of texts of up to ``GROUP_WORDS`` words, or of one longer text.

Defined cases: a null or empty text has no words and no runs, its collapsed text is empty;
repeated rows get a row each; a null id stays null; of ties nothing is dropped (all runs are
returned, by start, then period); an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, texts_of

MIN_LENGTH = 12
GROUP_WORDS = 200_000      # words of the texts that are sorted together
PROBES = 1 << 22           # suffixes asked about at a time

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_arrays(words: np.ndarray, text: np.ndarray, end: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SA and ISA of all texts (suffixes by text, then words; a shorter one first), and the
    numbers of the texts in which some two suffixes share ``shared`` words, or more texts."""
    n = len(words)
    key = text * (int(words.max()) + 1) + words
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    slots, key, h = np.arange(n), key[sa], 1
    repeats = np.unique(text)
    while True:
        lead = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(lead)
        rank[sa[slots]] = slots[np.repeat(first, np.diff(np.r_[first, len(slots)]))]
        slots = slots[~(lead & np.r_[lead[1:], True])]
        if h <= shared:
            repeats = np.unique(text[sa[slots]])
        if not len(slots):
            return sa, rank, repeats
        at = sa[slots]
        ahead = at + h
        inside = ahead < end[at]
        key = rank[at] * (n + 1)
        key[inside] += rank[ahead[inside]] + 1
        order = np.argsort(key, kind="stable")
        sa[slots], key = at[order], key[order]
        h *= 2


def shared_lengths(words: list, sa: list, isa: list) -> list:
    """LCP[k]: words that the suffixes of slots k - 1 and k share (LCP[0] is 0)."""
    n, h = len(words), 0
    lcp = [0] * n
    for i, slot in enumerate(isa):
        if slot:
            j = sa[slot - 1]
            stop = n - max(i, j)
            while h < stop and words[i + h] == words[j + h]:
                h += 1
            lcp[slot] = h
            if h:
                h -= 1
        else:
            h = 0
    return lcp


def cut_intervals(lcp: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, k, right) for every k with d = LCP[k] > 0: slots left .. k - 1 share more than
    d words with one another, slots k .. right - 1 at least d."""
    n = len(lcp)
    left, right = [0] * n, [n] * n
    stack = [0]
    for k in range(1, n):
        d = lcp[k]
        while lcp[stack[-1]] > d:
            right[stack.pop()] = k
        left[k] = stack[-1]
        stack.append(k)
    k = np.flatnonzero(np.asarray(lcp) > 0)
    return np.asarray(left)[k], k, np.asarray(right)[k]


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: list) -> np.ndarray:
    """Rows (period, start) of all squares that cannot be rotated right."""
    left, cut, right = cut_intervals(lcp)
    depth = np.asarray(lcp)[cut]
    n = len(sa)
    small_left = cut - left <= right - cut
    lo, size = np.where(small_left, left, cut), np.where(small_left, cut - left, right - cut)
    other_lo, other_hi = np.where(small_left, cut, left), np.where(small_left, right, cut)
    total = np.cumsum(size)
    found, at = [np.empty((0, 2), dtype=np.int64)], 0
    while at < len(cut):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PROBES, side="right")))
        s = size[at:to]
        which = np.repeat(np.arange(at, to), s)
        i = sa[lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(s) - s, s)]
        d = depth[which]
        for j in (i + d, i - d):
            ok = np.flatnonzero((j >= 0) & (j < n))
            slot, w = isa[j[ok]], which[ok]
            ok = ok[(slot >= other_lo[w]) & (slot < other_hi[w])]
            found.append(np.stack([d[ok], np.minimum(i[ok], j[ok])], axis=1))
        at = to
    return np.concatenate(found)


def runs_of(words: np.ndarray, sa: np.ndarray, isa: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text, by start, then period."""
    seq = words.tolist()
    lcp = shared_lengths(seq, sa.tolist(), isa.tolist())
    if max(lcp) < min_length // 2:
        return []
    squares = branching_squares(sa, isa, lcp)
    runs, ends = [], {}
    for q, i in squares[np.lexsort((squares[:, 1], squares[:, 0]))].tolist():
        end = i + 2 * q
        known = ends.setdefault(end, [])
        if any(s <= i for s in known):         # a multiple of a period that is known
            continue
        while i and seq[i - 1] == seq[i - 1 + q]:
            i -= 1
        known.append(i)
        if end - i >= min_length:
            runs.append((i, end - i, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs of every list of words."""
    out: list = [[] for _ in texts]
    group, held = [], 0
    for number, words in enumerate(texts):
        if len(words) >= min_length:
            group.append(number)
            held += len(words)
        if group and (held >= GROUP_WORDS or number + 1 == len(texts)):
            _group_runs(texts, group, out, min_length)
            group, held = [], 0
    if group:
        _group_runs(texts, group, out, min_length)
    return out


def _group_runs(texts, group, out, min_length) -> None:
    numbers: dict = {}
    length = np.array([len(texts[g]) for g in group])
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for g in group for w in texts[g]), dtype=np.int64,
                      count=int(length.sum()))
    stop = np.cumsum(length)
    text = np.repeat(np.arange(len(group)), length)
    sa, isa, repeats = suffix_arrays(ids, text, stop[text], min_length // 2)
    for t in repeats.tolist():
        lo, hi = int(stop[t] - length[t]), int(stop[t])
        out[group[t]] = runs_of(ids[lo:hi], sa[lo:hi] - lo, isa[lo:hi] - lo, min_length)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period in words, by start,
    then period) and the text with every run collapsed to its first period."""
    ready(docs.sparkSession)
    id_type = docs.select(F.col(f"`{id_col}`").alias("i")).schema["i"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [t.encode("utf-8").split() for t in texts_of(b.column(1))]
            runs = runs_of_texts(texts, min_length)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], _RUNS_ARROW),
                pa.array([collapse(t, r).decode("utf-8") for t, r in zip(texts, runs)], pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, n_words bigint, runs {RUNS}, collapsed string")
            .withColumnRenamed("id", id_col))
