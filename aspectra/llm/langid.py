"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums hashed n-gram counts (1 to 3 characters) per language in Spark; each task
adds up its documents first, so at most 2**BITS rows per language and task are shuffled,
and at most 2**BITS rows per language reach the driver.  At most ``PER_LANGUAGE`` documents
of each language are learnt from (a documented bound; chosen by the hash of their id), so
training does not grow with the corpus and rare languages are used whole.  The model is a
matrix of log-probabilities, 2**BITS rows by number of languages, which is broadcast; a
document is scored by adding up the rows of its n-grams (sparse, in numpy).

The score is the posterior probability of the predicted language, with the
log-likelihood divided by the square root of the number of n-grams so that long texts do not all score 1.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every
text when there is nothing to learn from; ties go to the language that sorts first; rows
without an id are never learnt from; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, ready, sampling_hash, share_of_hashes, texts_of
from .ngrams import code_points, hashed

BITS = 16
SIZES = (1, 2, 3)
PER_LANGUAGE = 10_000
SMOOTHING = 0.5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """A character of a Unicode letter category (``isalpha``) occurs."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray      # 2**BITS x languages
    log_prior: np.ndarray


def buckets(text: str) -> np.ndarray:
    p = code_points(text)
    return np.concatenate([hashed(p, n, BITS) for n in SIZES])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = PER_LANGUAGE) -> LanguageModel:
    ready(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"), F.col(id_col).alias("i")).filter(
        F.col("l").isNotNull() & F.col("t").isNotNull() & F.col("i").isNotNull())
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.zeros((1 << BITS, 0), dtype=np.float32), np.zeros(0, dtype=np.float32))
    number = {l: k for k, l in enumerate(langs)}
    share = F.create_map(*[x for l in langs for x in (F.lit(l), share_of_hashes(per_language / sizes[l]))])
    picked = rows.filter(sampling_hash("i") < F.element_at(share, F.col("l")))

    def count(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            for t, l in zip(texts_of(b.column(0)), b.column(1).to_pylist()):
                if l not in acc:
                    acc[l] = np.zeros(1 << BITS, dtype=np.int64)
                acc[l] += np.bincount(buckets(t), minlength=1 << BITS)
        for l, c in acc.items():
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(seen)), pa.array(seen), pa.array(c[seen])],
                                             names=["l", "b", "n"])

    got = (picked.select("t", "l").mapInArrow(count, "l string, b long, n long")
           .groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((1 << BITS, len(langs)))
    col = np.array([number[l] for l in got.column("l").to_pylist()], dtype=np.int64)
    counts[got.column("b").to_numpy(), col] = got.column("n").to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * (1 << BITS))
    prior = np.array([sizes[l] for l in langs], dtype=float)
    return LanguageModel(langs, np.log(p).astype(np.float32), np.log(prior / prior.sum()).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every document."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)       # 2**BITS x languages numbers of 4 bytes
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            langs, scores = [], []
            for t in texts_of(b.column(1)):
                if not m.languages or not has_letter(t):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                seen, n = np.unique(buckets(t), return_counts=True)
                ll = (n.astype(np.float64) @ m.log_prob[seen]) + m.log_prior
                best = int(ll.argmax())
                e = np.exp((ll - ll[best]) / np.sqrt(n.sum()))
                langs.append(m.languages[best])
                scores.append(float(1 / e.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["i", "l", "s"])

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(
        run, f"`{id_col}` {id_type}, lang_pred string, score double")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out("doc_id"))
