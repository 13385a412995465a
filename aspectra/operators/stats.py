"""Scalable building blocks for ranks and quantiles over a few very large groups.

Windows partitioned by a low-cardinality key (a polarity class, a stratum) put a whole
group into one task.  These helpers avoid that:

* ``rank_within_groups`` — exact row_number within groups via a range-partitioned sort
  (a hot group is spread over many partitions), per-partition counts (a table with at
  most #partitions x #groups rows, broadcast) and offsets.
* ``histogram_quantiles`` — exact linear-interpolation quantiles (pandas/DuckDB
  ``quantile_cont``) of integer-like values from a pre-aggregated histogram, so no
  task ever holds the raw values of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row position


def rank_within_groups(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                       rank_col: str = "rn", num_partitions: int | None = None,
                       materialize: bool = True, with_sizes: bool = False):
    """Add ``rank_col`` = row_number() OVER (PARTITION BY group_cols ORDER BY order_cols).

    ``order_cols`` must make the order total (include a unique id) for a deterministic
    result.  With ``with_sizes`` also returns (group_cols, group_size), read from the
    per-partition counts.  The sorted data is checkpointed (reliable, in spark.checkpoint.dir) so the
    row ids used by the count pass and the numbering pass are the same even if an
    executor is lost in between.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group_cols] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    sorted_df = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    if materialize:
        sorted_df = cut_lineage(sorted_df)
    pid = F.shiftright(F.col("_mid"), _PID_SHIFT)
    stats = (sorted_df.groupBy(pid.alias("_pid"), *group_cols)
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first")))
    ws = Window.partitionBy(*group_cols).orderBy("_pid")
    stats = stats.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # stats has at most (#partitions + #groups) rows: a bounded broadcast.
    out = (sorted_df.withColumn("_pid", pid)
           .join(F.broadcast(stats.select("_pid", *group_cols, "_off", "_first")),
                 ["_pid", *group_cols], "inner"))
    ranked = (out.withColumn(rank_col, (F.col("_mid") - F.col("_first") + F.col("_off") + 1).cast("bigint"))
                 .drop("_mid", "_pid", "_off", "_first"))
    if not with_sizes:
        return ranked
    # group sizes from the small per-partition table: no extra pass over the data
    sizes = stats.groupBy(*group_cols).agg(F.sum("_cnt").alias("group_size"))
    return ranked, sizes


def histogram_quantiles(df: DataFrame, value_col: str, probs: list[float],
                        group_cols: list[str] | None = None,
                        names: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (position h = p * (n - 1)).

    The input is reduced to (group, value, count) first (map-side combine), so the cost
    is bounded by the number of distinct values per group — small for the word counts
    and sizes this package takes quantiles of.
    """
    g = list(group_cols or [])
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    hist = df.groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_c"))
    w_all = Window.partitionBy(*g) if g else Window.partitionBy()
    w_ord = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(value_col)
    # hist is small (distinct values); a global window over it is fine.
    hist = (hist.withColumn("_hi", F.sum("_c").over(w_ord.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("_lo", F.col("_hi") - F.col("_c"))
                .withColumn("_n", F.sum("_c").over(w_all)))
    aggs = []
    for p, name in zip(probs, names):
        h = F.lit(p) * (F.col("_n") - 1)
        k0 = F.floor(h)
        k1 = F.ceil(h)
        v0 = F.min(F.when((F.col("_lo") <= k0) & (k0 < F.col("_hi")), F.col(value_col)))
        v1 = F.min(F.when((F.col("_lo") <= k1) & (k1 < F.col("_hi")), F.col(value_col)))
        frac = F.max(h - k0)
        aggs.append((v0 + frac * (v1 - v0)).cast("double").alias(name))
    return hist.groupBy(*g).agg(*aggs)


def running_totals(df: DataFrame, order_col: str, value_cols: list[str], descending: bool = False) -> DataFrame:
    """``df`` with ``<col>_total``: the sum of ``col`` up to and including the row, in the
    order of ``order_col`` (distinct values).

    Rows are range-partitioned and checkpointed, so partition numbers are fixed; each
    partition is summed on its own and shifted by the sums of the partitions before it (a
    table of one row per partition)."""
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    parts = cut_lineage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    sums = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_s_{c}") for c in value_cols])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("_part", *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in value_cols])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.withColumns({f"_r_{c}": F.sum(c).over(inside) for c in value_cols}).join(F.broadcast(shift), "_part")
    return out.select(*df.columns, *[(F.col(f"_r_{c}") + F.col(f"_b_{c}")).alias(f"{c}_total") for c in value_cols])
