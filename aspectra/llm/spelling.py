"""Spelling variants by a frequency-vector trie.

Two words are *near* if they differ by exactly one inserted, deleted or replaced code point.
A word's form is its near word of largest count (ties: the smallest word in code-point
order), if that count is at least ``RATIO`` times the word's own; its root is reached by
following forms to the last.  Counts at least double at each step, so there are no cycles.

1. *Trie.*  A word's path is its length, then how many of its letters fall into each group of
   ``GROUPS`` in turn.  One inserted letter is a surplus of one in one group; a replaced one
   is a surplus and a deficit of one, or none.
2. *Search.*  Each word looks for the words of its own length (budget: one surplus, one
   deficit) and of one letter more (one surplus); of two near words one thus finds the other.
   The top ``depth`` levels are searched by listing the paths that the budget reaches: the
   word visits the subtrees below them.  A subtree is one task's: words sorted by path, the
   search going depth first with all visitors at once, each with what is left of its budget.
3. *Leaves* of up to ``LEAF`` words compare the remaining counts, and words whose vectors fit
   are verified letter by letter.

The depth is the least at which no subtree holds more than ``SUBTREE`` words; a subtree that
exceeds it at ``DEEPEST`` is cut into blocks and visitors go to each.  Visitors are streamed,
so a task holds one subtree block and a batch of visitors.

Defined cases: null words and words without a count are no words; rows of a word are added
up; a word without near words is its own root, its form is null; an empty table gives no rows;
long words are compared like others (counts above 255 are cut in paths, which only makes
the search wider); other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ready

MIN_LENGTH, MIN_COUNT = 5, 3
RATIO = 2
SUBTREE = 50_000           # words of a subtree
DEEPEST = 6                # levels below the length that subtrees may start at
LEAF = 16                  # words that are compared without going deeper
VISITORS = 20_000          # words that go down a subtree together

# Letters that are counted together, in the order of the trie's levels; all others form a last group.
GROUPS = ["e", "a", "i", "o", "n", "r", "t", "s", "l", "u", "d", "c", "m", "p", "g", "h", "bf", "vw", "jky", "qxz"]
_GROUP_OF = np.full(128, len(GROUPS), dtype=np.int64)
for _g, _letters in enumerate(GROUPS):
    for _x in _letters:
        _GROUP_OF[ord(_x)] = _g
WIDTH = len(GROUPS) + 1


def vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and the letters of every word in each group (255 at most)."""
    length = np.array([len(w) for w in words], dtype=np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    group = np.where(code < 128, _GROUP_OF[np.minimum(code, 127)], len(GROUPS))
    row = np.repeat(np.arange(len(words)), length)
    counts = np.bincount(row * WIDTH + group, minlength=len(words) * WIDTH).reshape(-1, WIDTH)
    return length, np.minimum(counts, 255).astype(np.int16)


def near(a: str, b: str) -> bool:
    """Do two different words, b as long as a or one longer, differ by one code point?"""
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if n == len(b) else a[i:] == b[i + 1:]


class Trie:
    """A subtree: words of one length whose first ``depth`` counts are equal."""

    def __init__(self, words: list[str], counts: list[int], depth: int):
        _, v = vectors(words)
        by = np.lexsort(v.T[::-1])
        self.words, self.counts, self.v, self.depth = [words[i] for i in by], [counts[i] for i in by], v[by], depth

    def near(self, words: list[str]) -> list[tuple[int, int]]:
        """(visitor, word) numbers of the near pairs that are this way's to find."""
        length, q = vectors(words)
        grows = len(self.words[0]) - length                      # 0 or 1
        d = self.v[0, :self.depth] - q[:, :self.depth]
        surplus, deficit = 1 - np.maximum(d, 0).sum(axis=1), (1 - grows) - np.maximum(-d, 0).sum(axis=1)
        some = np.flatnonzero((surplus >= 0) & (deficit >= 0))
        out: list[tuple[int, int]] = []
        stack = [(0, len(self.words), self.depth, some, surplus[some], deficit[some])]
        while stack:
            lo, hi, level, who, s, t = stack.pop()
            if hi - lo > LEAF and level < WIDTH:
                column = self.v[lo:hi, level]
                cuts = [lo, *(np.flatnonzero(np.diff(column)) + lo + 1).tolist(), hi]
                mine = q[who, level]
                for a, b in zip(cuts, cuts[1:]):
                    d = int(self.v[a, level]) - mine
                    left, lack = s - np.maximum(d, 0), t - np.maximum(-d, 0)
                    ok = (left >= 0) & (lack >= 0)
                    if ok.any():
                        stack.append((a, b, level + 1, who[ok], left[ok], lack[ok]))
                continue
            self._leaf(lo, hi, level, who, s, t, q, words, out)
        return out

    def _leaf(self, lo, hi, level, who, s, t, q, words, out) -> None:
        x, y = np.repeat(np.arange(len(who)), hi - lo), np.tile(np.arange(lo, hi), len(who))
        s, t = s[x], t[x]
        for at in range(level, WIDTH):
            d = self.v[y, at] - q[who[x], at]
            s, t = s - np.maximum(d, 0), t - np.maximum(-d, 0)
            ok = np.flatnonzero((s >= 0) & (t >= 0))
            x, y, s, t = x[ok], y[ok], s[ok], t[ok]
            if not len(x):
                return
        for i, j in zip(who[x].tolist(), y.tolist()):
            a, b = words[i], self.words[j]
            if (len(a) < len(b) or a < b) and near(a, b):
                out.append((i, j))


# ---------------------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------------------
def vocabulary(words: DataFrame, word: Column, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: how often every word of at least ``min_length`` code points occurs, if at least ``min_count`` times."""
    return (words.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _key(length: int, path) -> bytes:
    return length.to_bytes(4, "big") + bytes(path)


def reachable(length: int, path: list[int], depth: int) -> list[bytes]:
    """Keys of the subtrees that the budget of a word reaches; the first is its own."""
    p = path[:depth]
    keys = [_key(length, p)]
    more = [[*p[:i], p[i] + 1, *p[i + 1:]] for i in range(depth) if p[i] < 255]
    keys += [_key(length + 1, x) for x in [p, *more]]
    less = [[*x[:i], x[i] - 1, *x[i + 1:]] for x in [p, *more] for i in range(depth) if p[i] and x[i] == p[i]]
    return keys + [_key(length, x) for x in [*more, *less]]


def _sizes(words: DataFrame) -> DataFrame:
    """(depth, key, c): the words of every subtree at every depth, counted map-side first."""
    def run(batches):
        for b in batches:
            length, v = vectors(b.column(0).to_pylist())
            sizes: Counter = Counter()
            for n, p in zip(length.tolist(), v.tolist()):
                sizes.update((d, _key(n, p[:d])) for d in range(1, DEEPEST + 1))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in sizes], pa.int32()), pa.array([k for _, k in sizes], pa.binary()),
                                              pa.array(list(sizes.values()), pa.int64())], names=["depth", "key", "c"])

    return words.select("word").mapInArrow(run, "depth int, key binary, c bigint").groupBy("depth", "key").agg(F.sum("c").alias("c"))


def _routed(words: DataFrame, depth: int) -> DataFrame:
    """(key, home, word, n): every word at home, and as a visitor of every subtree that it reaches."""
    def run(batches):
        for b in batches:
            text, count = b.column(0).to_pylist(), b.column(1).to_pylist()
            length, v = vectors(text)
            key, home, word, n = [], [], [], []
            for w, c, size, path in zip(text, count, length.tolist(), v.tolist()):
                keys = reachable(size, path, depth)
                key += [keys[0], *keys]
                home += [True, *[False] * len(keys)]
                word += [w] * (len(keys) + 1)
                n += [c] * (len(keys) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(home), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                                             names=["key", "home", "word", "n"])

    return words.mapInArrow(run, "key binary, home boolean, word string, n bigint")


def near_pairs(words: DataFrame, tables: Scratch) -> DataFrame:
    """(a, na, b, nb): every two near words once."""
    sizes = tables.keep(_sizes(words))
    largest = {r.depth: r.c for r in sizes.groupBy("depth").agg(F.max("c").alias("c")).collect()}
    depth = next((d for d in sorted(largest) if largest[d] <= SUBTREE), DEEPEST)
    crowded = tables.keep(sizes.filter((F.col("depth") == depth) & (F.col("c") > SUBTREE))
                          .select("key", F.ceil(F.col("c") / SUBTREE).cast("int").alias("blocks")))
    routed = _routed(words, depth).join(crowded, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    routed = routed.select("key", F.explode(F.when(F.col("home"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("block"),
                           (~F.col("home")).alias("visits"), "word", "n")

    def run(batches):
        at, trie, home, visitors = None, None, ([], []), ([], [])

        def ask():
            for i in range(0, len(visitors[0]), VISITORS):
                w, c = visitors[0][i:i + VISITORS], visitors[1][i:i + VISITORS]
                got = trie.near(w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[x] for x, _ in got], pa.string()), pa.array([c[x] for x, _ in got], pa.int64()),
                     pa.array([trie.words[y] for _, y in got], pa.string()), pa.array([trie.counts[y] for _, y in got], pa.int64())],
                    names=["a", "na", "b", "nb"])

        for b in batches:
            for key, block, visits, word, n in zip(*(c.to_pylist() for c in b.columns)):
                if (key, block) != at:
                    if trie:
                        yield from ask()
                    at, trie, home, visitors = (key, block), None, ([], []), ([], [])
                if not visits:
                    home[0].append(word)
                    home[1].append(n)
                elif home[0]:                   # nobody lives in a subtree without homes
                    trie = trie or Trie(*home, depth)
                    visitors[0].append(word)
                    visitors[1].append(n)
                    if len(visitors[0]) >= VISITORS:
                        yield from ask()
                        visitors = ([], [])
        if trie:
            yield from ask()

    return (routed.repartition("key", "block").sortWithinPartitions("key", "block", "visits")
            .mapInArrow(run, "a string, na bigint, b string, nb bigint"))


def _roots(forms: DataFrame, tables: Scratch) -> DataFrame:
    """(word, root) of the words that have a form, by pointer jumping."""
    roots = tables.keep(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = tables.keep(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, word_col: str = "word", count_col: str = "n", ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near (near words) and form_n of every word of a vocabulary."""
    spark = ready(words.sparkSession)
    tables = Scratch(spark, "spelling")
    w = tables.keep(words.select(F.col(f"`{word_col}`").alias("word"), F.col(f"`{count_col}`").cast("long").alias("n"))
                    .filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    pairs = tables.keep(near_pairs(w, tables))
    # the least of (-n, word) is the near word of largest n, the smallest word first
    ends = lambda a, b: pairs.select(F.col(a).alias("word"), F.struct((-F.col(f"n{b}")).alias("less"), F.col(b).alias("form")).alias("near"))
    best = ends("a", "b").unionByName(ends("b", "a")).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    has = F.col("near").isNotNull() & (-F.col("near.less") >= ratio * F.col("n"))
    forms = tables.keep(w.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("near.form")).alias("form"), F.when(has, -F.col("near.less")).alias("form_n")))
    out = Scratch(spark, "spelling-forms").keep(
        forms.join(_roots(forms, tables), "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    tables.drop()
    return out
