"""Exact deduplication with a heavy-hitter split (DataFrame and SQL functions only).

1. Every text is hashed once: (id, sha256) goes to the shared checkpoint folder.
2. A Misra-Gries summary of the digests finds the frequent ones.  Spark's mergeable
   frequent-items sketch (``approx_top_k_accumulate`` / ``approx_top_k_combine``) is that
   summary: counters with decrements, undercounting by at most 3.5 / 65 536 of the rows
   with ``SKETCH_ITEMS`` counters.  Partial summaries are merged in two levels, so no
   task merges more than about the square root of all of them.
3. The candidates are verified by exact counts (map-side combined).  Digests that hold at
   least ``HEAVY_SHARE`` of the rows are at most 1 / HEAVY_SHARE = 10 000, whatever the
   input; this proven bound allows their winners to be broadcast, and every copy of a
   heavy text is settled on the map side without a shuffle.
4. The remaining digests go through an ordinary shuffle; none of them holds more than
   HEAVY_SHARE of the rows.

The sketch only routes rows: both routes give the same answer, so the result is exact.

Defined cases: a null text counts as empty; texts are equal when identical; the largest id
wins, null ids lose to any id; rows that repeat the winner's id and text are all marked
kept by ``duplicate_groups``, while ``drop_duplicates`` leaves one of them; a group of
null ids only has a null keep_id and keeps its rows (``drop_duplicates``: one); an empty
table gives an empty result; other columns are ignored or carried, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, ready, text_or_empty

SKETCH_ITEMS = 49_152      # counters: a map of 65 536 slots at a load of 3/4
HEAVY_SHARE = 1e-4         # above the sketch's error of 5.4e-5 of the rows
MAX_HEAVY = int(1 / HEAVY_SHARE)
MERGE_FAN = 64             # partial summaries merge in this many tasks first

_ID, _SHA = "__dd_id", "__dd_sha"


@dataclass
class HeavySplit:
    """digests: (id, sha) per row; heavy: at most MAX_HEAVY winners; light: winners of the rest."""
    digests: DataFrame
    heavy: DataFrame
    light: DataFrame


def frequent_candidates(digests: DataFrame, sha: str = _SHA) -> DataFrame:
    """64-bit keys of the digests a Misra-Gries summary reports, at most MAX_HEAVY rows."""
    parts = digests.groupBy((F.spark_partition_id() % MERGE_FAN).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(xxhash64({sha}), {SKETCH_ITEMS})").alias("s"))
    # a keyed aggregate: a global one would also merge the empty summaries of empty partitions
    merged = parts.groupBy(F.lit(1).alias("one")).agg(F.expr(f"approx_top_k_combine(s, {SKETCH_ITEMS})").alias("s"))
    return (merged.select(F.explode(F.expr(f"approx_top_k_estimate(s, {MAX_HEAVY})")).alias("e"))
            .select(F.col("e.item").alias("__dd_key"), F.col("e.count").alias("__dd_est"))
            .filter("__dd_key IS NOT NULL AND __dd_est >= 2"))


def heavy_split(digests: DataFrame, winner) -> HeavySplit:
    """Split digests into heavy and light winners; ``winner`` is the aggregate that picks
    the id that stays (for example ``F.max``)."""
    digests = cut_lineage(digests)
    rows = digests.count()
    floor = max(2, int(rows * HEAVY_SHARE) + 1)
    agg = [winner(F.col(_ID)).alias("__dd_keep"), F.count(F.lit(1)).alias("__dd_n")]
    heavy = cut_lineage(
        digests.withColumn("__dd_key", F.xxhash64(_SHA))
        .join(F.broadcast(frequent_candidates(digests)), "__dd_key", "left_semi")
        .groupBy(_SHA).agg(*agg).filter(F.col("__dd_n") >= floor))
    light = (digests.join(F.broadcast(heavy.select(_SHA)), _SHA, "left_anti")
             .groupBy(_SHA).agg(*agg).filter("__dd_n > 1"))
    return HeavySplit(digests, heavy, light)


def _settle(rows: DataFrame, s: HeavySplit) -> DataFrame:
    """Attach winner and group size: map-side for heavy digests, by shuffle for the rest."""
    heavy = rows.join(F.broadcast(s.heavy), _SHA)
    light = (rows.join(F.broadcast(s.heavy.select(_SHA)), _SHA, "left_anti")
             .join(s.light, _SHA, "left"))
    return heavy, light


def digest_of(text_col: str):
    return F.sha2(text_or_empty(text_col).cast("binary"), 256)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    ready(docs.sparkSession)
    s = heavy_split(docs.select(F.col(f"`{id_col}`").alias(_ID), F.unhex(digest_of(f"`{text_col}`")).alias(_SHA)), F.max)
    heavy, light = _settle(s.digests, s)
    single = F.col("__dd_n").isNull()
    out = heavy.unionByName(light).select(
        F.col(_ID).alias(id_col),
        F.when(single, F.col(_ID)).otherwise(F.col("__dd_keep")).alias("keep_id"),
        F.coalesce("__dd_n", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col(_ID).eqNullSafe(F.col("__dd_keep"))).alias("kept"),
        F.lower(F.hex(_SHA)).alias("text_sha256"))
    return out


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one per distinct text.

    Copies of heavy texts are removed before the shuffle, so no task receives them."""
    ready(docs.sparkSession)
    # the row travels as one struct, so no name of its columns meets one of ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__dd_row"),
                       F.col(f"`{id_col}`").alias(_ID), F.unhex(digest_of(f"`{text_col}`")).alias(_SHA))
    s = heavy_split(rows.select(_ID, _SHA), F.max)
    stays = F.col("__dd_n").isNull() | F.col(_ID).eqNullSafe(F.col("__dd_keep"))
    heavy, light = _settle(rows, s)
    kept = heavy.filter(stays).dropDuplicates([_SHA]).unionByName(light.filter(stays).dropDuplicates([_SHA]))
    return kept.select(*[F.col(f"__dd_row.`{c}`") for c in docs.columns])
