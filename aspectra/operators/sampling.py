"""Seeded sample and stratified split.

Orderings use ``md5(seed:id)`` so the choice is deterministic and portable to other
engines; per-stratum ranks use the range-partitioned ``rank_within_groups`` so a large
stratum is spread over many tasks.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage
from .stats import rank_within_groups

# One row per stratum is broadcast up to this many strata; beyond it the join is shuffled.
MAX_BROADCAST_STRATA = 100_000


def seeded_key(id_col: str, seed: int):
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))


def seeded_sample(df: DataFrame, id_col: str, n: int = S.SAMPLE_SIZE, seed: int = S.SAMPLE_SEED) -> DataFrame:
    """L4: n rows chosen by the seeded hash order (a top-k: each task keeps its best n,
    the final merge sees n x #partitions rows)."""
    return df.withColumn("_k", seeded_key(id_col, seed)).orderBy("_k", id_col).limit(n).drop("_k")


def stratified_split(df: DataFrame, id_col: str, stratum_col: str | None = None,
                     valid_fraction: float = S.VALID_FRACTION, seed: int = S.SPLIT_SEED,
                     production: bool = False) -> DataFrame:
    """Add ``split`` in {train, valid}: per stratum the first ceil(f * n) rows by
    the seeded hash order are validation.  ``production=True`` puts every row in train
    and *also* emits the validation rows (overlap, as a flagged option)."""
    strat = stratum_col or "_all"
    d = df if stratum_col else df.withColumn("_all", F.lit(1))
    d = d.withColumn("_k", seeded_key(id_col, seed))
    # only keys are ranked; the last validation key of a stratum is its cut-off
    ranked, sizes = rank_within_groups(d.select(strat, "_k", id_col), [strat], ["_k", id_col], rank_col="_rn",
                                       with_sizes=True)
    cut = cut_lineage(ranked.join(sizes, strat).filter(F.col("_rn") == F.ceil(F.col("group_size") * F.lit(valid_fraction)))
                      .select(strat, F.struct("_k", id_col).alias("_cut")))
    r = d.join(F.broadcast(cut) if cut.count() <= MAX_BROADCAST_STRATA else cut, strat, "left")
    is_valid = F.coalesce(F.struct("_k", id_col) <= F.col("_cut"), F.lit(False))
    out = r.withColumn("split", F.when(is_valid, F.lit("valid")).otherwise(F.lit("train")))
    if production:
        warnings.warn("production split: the training set contains the validation rows")
        out = (out.withColumn("split", F.lit("train"))
               .unionByName(out.filter(is_valid).withColumn("split", F.lit("valid"))))
    out = out.select(strat, *[c for c in df.columns if c != strat], "split")
    return out.drop("_all") if not stratum_col else out
