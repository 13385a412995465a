"""Session helpers.

The library never builds its own session inside an operator: every operator takes
DataFrames and returns DataFrames.  These helpers exist for tests, the bench and the
command-line entry points, and for the one setting operators do read from the session:
the checkpoint folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  AQE re-plans joins and coalesces shuffle output at run
# time; letting co-partitioned joins reuse a partitioning on a *subset* of the join keys
# is what keeps the per-sentence joins of the rule engine exchange-free after the one
# shuffle of sentences by review_id.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Cached tables keep the partitioning they were built with, so plans over them can
    # rely on it (AQE may not coalesce a cached plan's output behind their back).
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false",
    "spark.sql.session.timeZone": "UTC",
    # reviews of 100 KB then make Arrow batches of some 25 MB
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "aspectra", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    master = master or os.environ.get("ASPECTRA_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**PLAN_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_plan_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_plan_conf(spark: SparkSession) -> None:
    for k, v in PLAN_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names a shared, reliable folder and is only read.  Only
    when it is unset (local tests) a scratch folder is created and set.
    """
    sc = spark.sparkContext
    cur = sc._jsc.sc().getCheckpointDir()
    if cur.isDefined():
        return cur.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="aspectra-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever it lies on the driver (once a session)."""
    import shutil
    sc = spark.sparkContext
    if getattr(sc, "_aspectra_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    at = tempfile.mkdtemp(prefix="aspectra-package-")
    shutil.copytree(here, f"{at}/package/{os.path.basename(here)}", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{at}/aspectra", "zip", f"{at}/package"))
    sc._aspectra_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Compressed input bytes per partition of the text path: a megabyte of text becomes some
# 300 000 tokens, so partitions this small are sorted in memory; above MANY partitions they
# grow to eight times the size first, so that huge inputs do not drown in them.
TEXT_BYTES_PER_PARTITION = 4 * 1024 * 1024
MANY = 10_000


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame (file sizes for scans; no file is listed
    again by the driver)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def text_partitions(df: DataFrame, bytes_per_partition: int = TEXT_BYTES_PER_PARTITION) -> int:
    """Partition count for the text path: enough partitions for the input size, and at
    least one per core.  An input without statistics (Spark then assumes the largest size)
    takes the session's shuffle setting."""
    size = input_bytes(df)
    if size >= 1 << 60 or size < 0:
        return max(int(df.sparkSession.sparkContext.defaultParallelism),
                   int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = min(-(-size // bytes_per_partition), max(MANY, size // (8 * bytes_per_partition)))
    return max(int(df.sparkSession.sparkContext.defaultParallelism), int(n), 1)
