"""Quality rules with a bitmask ledger (DataFrame and SQL functions only).

Every rule is evaluated once per document.  The ledger keeps the measurements and one
``fail_mask`` whose bit b is set when rule b fails.  Policies are versioned sets of rules,
that is masks: applying one is a bitwise AND over the ledger, and ablations (what does
dropping a rule bring back?) are counted from the masks alone, without reading texts again.

All measurements are column expressions inside the document's row: no shuffle, no Python.
Repeated 8-word windows are found through 64-bit window hashes built by doubling
(1 -> 2 -> 4 -> 8 words); only documents with a repeated hash sort their windows.

Defined cases: a null or empty text has no words and fails; rows repeat as they come; ties
do not arise (no rule compares documents); an empty table gives an empty ledger; other
columns are ignored (``filter_documents`` carries them).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, ready, text_or_empty

WINDOW = 8                       # words in a repeat window: built by three doublings
SYMBOLS = r"[#*$%&|<>]"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """One rule: its bit in the mask and its failure condition over the measurements."""
    bit: int
    name: str
    fails: Callable[[], Column]

    @property
    def mask(self) -> int:
        return 1 << self.bit


_c = F.col
RULES = [
    Rule(0, "few_words", lambda: _c("n_words") < 20),
    Rule(1, "repeated_windows", lambda: 100 * _c("n_repeat_words") > 30 * _c("n_words")),
    Rule(2, "symbol_share", lambda: 10 * _c("n_symbols") > 3 * _c("n_words")),
    Rule(3, "repeated_lines", lambda: (_c("n_dup_lines") > 2) & (10 * _c("n_dup_lines") > 3 * _c("n_lines"))),
    Rule(4, "short_words", lambda: _c("word_chars") < 2 * _c("n_words")),
    Rule(5, "long_words", lambda: _c("word_chars") > 20 * _c("n_words")),
]
BITS = {r.name: r.mask for r in RULES}

# name -> version -> rules that reject a document
POLICIES = {
    "base": {1: ["few_words", "repeated_windows"]},
    "web": {1: ["few_words", "repeated_windows", "symbol_share"],
            2: [r.name for r in RULES]},
}


def policy_mask(name: str, version: int) -> int:
    return sum(BITS[r] for r in POLICIES[name][version])


def _shifted(a: str, by: int) -> Column:
    """Pairwise hash of a[i] and a[i + by] (null past the end; cut off later)."""
    return F.zip_with(_c(a), F.slice(_c(a), by + 1, F.size(a)), lambda x, y: F.xxhash64(x, y))


def _covered(sorted_pos: str) -> Column:
    """Words covered by windows that start at the given sorted positions."""
    gaps = F.zip_with(_c(sorted_pos), F.slice(_c(sorted_pos), 2, F.size(sorted_pos)),
                      lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def measure(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns plus the measurements of every document."""
    carry = docs.columns if carry is None else carry
    t = F.col("__q_t")
    keep = [f"__q_in.`{c}`" for c in carry]
    # each step reads columns of the step before, so nothing is evaluated twice
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("__q_in") if carry
                    else F.struct(F.lit(1).alias("__one")).alias("__q_in"),
                    text_or_empty(f"`{text_col}`").alias("__q_t"))
    d = d.select("__q_in",
                 F.array_remove(F.split(t, f"{SPACE_CLASS}+"), "").alias("__q_w"),
                 F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__q_l"),
                 F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    keepers = ["__q_in", "n_symbols"]
    d = d.select(*keepers, F.size("__q_w").cast("long").alias("n_words"),
                 F.aggregate("__q_w", F.lit(0).cast("long"), lambda s, w: s + F.length(w)).alias("word_chars"),
                 F.size("__q_l").cast("long").alias("n_lines"),
                 (F.size("__q_l") - F.size(F.array_distinct("__q_l"))).cast("long").alias("n_dup_lines"),
                 F.transform("__q_w", lambda w: F.xxhash64(w)).alias("__q_h1"))
    keepers += ["n_words", "word_chars", "n_lines", "n_dup_lines"]
    d = d.select(*keepers, _shifted("__q_h1", 1).alias("__q_h2"))
    d = d.select(*keepers, _shifted("__q_h2", 2).alias("__q_h4"))
    d = d.select(*keepers, _shifted("__q_h4", 4).alias("__q_h8"))
    d = d.select(*keepers, F.slice("__q_h8", F.lit(1),
                                   F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0))).alias("__q_g"))
    repeats = F.size(F.array_distinct("__q_g")) < F.size("__q_g")
    d = d.select(*keepers, F.when(repeats, F.sort_array(
        F.transform("__q_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__q_s"))
    # equal neighbours in hash order mark the repeated windows
    same = F.zip_with("__q_s", F.slice("__q_s", 2, F.size("__q_s")), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    d = d.select(*keepers, "__q_s", F.when(F.col("__q_s").isNotNull(), same).alias("__q_n"))
    marked = F.zip_with(
        "__q_s", F.zip_with("__q_n", F.concat(F.array(F.lit(False)), F.col("__q_n")), lambda a, b: F.coalesce(a, F.lit(False)) | b),
        lambda s, m: F.when(m, s["i"]))
    d = d.select(*keepers, F.when(F.col("__q_s").isNotNull(), F.sort_array(F.filter(marked, lambda x: x.isNotNull()))).alias("__q_p"))
    d = d.select(*keepers, F.when(F.col("__q_p").isNull(), F.lit(0)).otherwise(_covered("__q_p")).cast("long").alias("n_repeat_words"))
    return d.select(*[F.col(k) for k in keep], *MEASURES)


def add_mask(measured: DataFrame) -> DataFrame:
    mask = F.lit(0).cast("long")
    for r in RULES:
        mask = mask.bitwiseOR(F.when(r.fails(), F.lit(r.mask)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_mask", mask)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, measurements and fail_mask of every document: every rule, evaluated once."""
    ready(docs.sparkSession)
    return add_mask(measure(docs.select(F.col(f"`{id_col}`").alias("__q_id"), F.col(f"`{text_col}`").alias("__q_x")),
                            "__q_x", ["__q_id"])).withColumnRenamed("__q_id", id_col)


def passes(policy: str, version: int) -> Column:
    return F.col("fail_mask").bitwiseAND(F.lit(policy_mask(policy, version)).cast("long")) == 0


def apply_policies(led: DataFrame, policies: list[tuple[str, int]]) -> DataFrame:
    """One boolean column ``kept_<name>_v<version>`` per policy, from the masks alone."""
    return led.withColumns({f"kept_{n}_v{v}": passes(n, v) for n, v in policies})


def ablation(led: DataFrame, policy: str, version: int) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only it rejects
    (what dropping the rule would bring back).  Masks are counted first, so at most
    2^rules rows are exploded."""
    pm = policy_mask(policy, version)
    counts = (led.select(F.col("fail_mask").bitwiseAND(F.lit(pm).cast("long")).alias("m"))
              .groupBy("m").agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit"))
                      for r in RULES if r.mask & pm])
    return (counts.select("m", "n", F.explode(rules).alias("r"))
            .groupBy("r.rule").agg(
                F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this")))


def filter_documents(docs: DataFrame, text_col: str = "text", policy: str = "web", version: int = 2) -> DataFrame:
    """The rows that pass the policy, with all their columns."""
    ready(docs.sparkSession)
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__q_row"),
                    F.col(f"`{text_col}`").alias("__q_x"))
    led = add_mask(measure(d, "__q_x", ["__q_row"]))
    # a filter on fail_mask would be pushed below the measuring steps, each of them inlined
    # many times over; no predicate passes an explode, so the ledger stays as it is
    good = F.filter(F.array(F.struct("__q_row", "fail_mask")),
                    lambda x: x["fail_mask"].bitwiseAND(F.lit(policy_mask(policy, version)).cast("long")) == 0)
    return led.select(F.explode(good).alias("__q_good")).select(*[F.col(f"__q_good.__q_row.`{c}`") for c in cols])
