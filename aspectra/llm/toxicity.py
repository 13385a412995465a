"""Toxicity: a character n-gram linear classifier over naive Bayes log-count ratios.

Training (labelled rows only):
1. *Ratios*: for every hashed character n-gram (3 to 5 characters, across word edges) the
   number of toxic and of other training documents that contain it, summed by Spark (at
   most 2**BITS rows reach the driver).  The ratio is
   r = log(p / q) with both rates smoothed towards the common rate, so an unseen n-gram has
   r = 0.
2. *Features*: the ``FEATURES`` n-grams that separate the labels best (signed G-statistic
   of their counts).  A document's feature is r if it contains the n-gram, else 0: presence,
   so the length of a text does not dilute it.
3. *Weights*: logistic regression with an L2 penalty over these scaled features.

Both steps learn from a bounded sample of about ``SAMPLE`` labelled rows (all of them if
there are no more), taken by the hash of their id.  Only the sample's ids and labels are
broadcast; no text is shuffled.

Scoring reads every whole text once; the model (two arrays of FEATURES numbers) is the only
thing broadcast.  The score depends on the text alone.

Defined cases: null counts as empty; an empty text gets the model's base rate; without
labels, or with one class only, scores are the smoothed base rate; labels that repeat an id
count as their largest value; rows without an id are scored but never learnt from; an empty
table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, held_out, ready, sampling_hash, share_of_hashes, texts_of
from .ngrams import code_points, hashed

BITS = 20
SIZES = (3, 4, 5)
FEATURES = 2_048
SAMPLE = 20_000
MIN_DOCS = 3
THRESHOLD = 0.7
L2 = 0.02
STEPS = 800


@dataclass
class ToxicityModel:
    bucket: np.ndarray      # bucket numbers of the features, sorted
    weight: np.ndarray      # weight times ratio, per feature
    bias: float


def present(text: str) -> np.ndarray:
    """Distinct buckets of a text's n-grams."""
    p = code_points(text)
    flags = np.zeros(1 << BITS, dtype=bool)
    for n in SIZES:
        flags[hashed(p, n, BITS)] = True
    return np.flatnonzero(flags)


def _count_rows(batches):
    """Documents per bucket and label, of one task."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for b in batches:
        for label, t in zip(b.column(1).to_pylist(), texts_of(b.column(0))):
            counts[label, present(t)] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    for i in range(0, len(seen), 65_536):
        part = seen[i:i + 65_536]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[0, part]), pa.array(counts[1, part])],
                                         names=["b", "n0", "n1"])


def _ratios(counts, total):
    """Chosen buckets and their log-count ratios."""
    b, n = counts[:, 0], counts[:, 1:].astype(float)
    share = total / total.sum()
    rate = (n + 4 * share) / (total + 4 * share)      # the same prior odds in both classes
    r = np.log(rate[:, 1] / rate[:, 0])
    seen = n.sum(axis=1)
    expected = seen[:, None] * share
    g = (n * np.log(np.maximum(n, 1e-9) / expected)).sum(axis=1)
    g[seen < MIN_DOCS] = 0
    best = np.sort(np.argsort(-g, kind="stable")[:FEATURES])
    best = best[g[best] > 0]
    return b[best], r[best]


def _fit_weights(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression over sparse rows, by accelerated gradient steps."""
    lens = np.array([len(r) for r in rows])
    col = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), lens)
    val = ratio[col]
    n = len(rows)
    # the largest row norm bounds the curvature; the bias counts as one more feature
    step = 4 * n / (np.bincount(row, val * val, n).sum() + n + 4 * L2)
    rate = (y.sum() + 0.5) / (n + 1)
    w, bias = np.zeros(len(ratio)), float(np.log(rate / (1 - rate)))
    vw, vb = np.zeros_like(w), 0.0
    for k in range(STEPS):
        m = k / (k + 3)
        lw, lb = w + m * vw, bias + m * vb
        z = np.bincount(row, val * lw[col], n) + lb
        e = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        gw = np.bincount(col, val * e[row], len(w)) + L2 * lw
        nw, nb = lw - step * gw, lb - step * e.sum()
        vw, vb, w, bias = nw - w, nb - bias, nw, nb
    return w, float(bias)


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> ToxicityModel:
    """Fit on rows (text, label 0/1); see ``training_rows`` for their bound."""
    ready(labelled.sparkSession)
    rows = cut_lineage(labelled.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y")))
    counted = (rows.select("t", "y").mapInArrow(_count_rows, "b long, n0 long, n1 long")
               .groupBy("b").agg(F.sum("n0"), F.sum("n1")).toArrow())
    counts = np.stack([c.to_numpy() for c in counted.columns], axis=1) if counted.num_rows else np.zeros((0, 3), dtype=np.int64)
    counts = counts[np.argsort(counts[:, 0])]
    size = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = np.array([size.get(0, 0), size.get(1, 0)], dtype=float)
    if not total.all():
        rate = (total[1] + 0.5) / (total.sum() + 1)
        return ToxicityModel(np.empty(0, dtype=np.int64), np.empty(0), float(np.log(rate / (1 - rate))))
    bucket, ratio = _ratios(counts, total)

    def features(batches):
        for b in batches:
            found = []
            for t in texts_of(b.column(0)):
                x = present(t)
                at = np.searchsorted(bucket, x)
                at[at == len(bucket)] = 0
                found.append(at[bucket[at] == x].astype(np.int16).tobytes() if len(bucket) else b"")
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), b.column(1)], names=["f", "y"])

    got = rows.select("t", "y").mapInArrow(features, "f binary, y int").toArrow()
    y = np.array(got.column(1).to_pylist(), dtype=float)
    w, bias = _fit_weights([np.frombuffer(f, np.int16).astype(np.int64) for f in got.column(0).to_pylist()], ratio, y)
    return ToxicityModel(bucket, w * ratio, bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every document."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)       # FEATURES numbers, twice
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        slot = np.zeros(1 << BITS)                      # weight by bucket; 0 for all others
        slot[m.bucket] = m.weight
        used = np.zeros(1 << BITS, dtype=bool)
        used[m.bucket] = True
        for b in batches:
            out = []
            for t in texts_of(b.column(1)):
                p = code_points(t)
                h = np.concatenate([hashed(p, n, BITS) for n in SIZES])
                z = m.bias + slot[np.unique(h[used[h]])].sum()
                out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["i", "s"])

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, f"`{id_col}` {id_type}, score double")


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Labelled documents that are not held out, about ``sample`` of them: id, text, label."""
    lab = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
           .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label")))
    picked = lab.filter(sampling_hash("doc_id") < share_of_hashes(sample / max(1, lab.count())))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
