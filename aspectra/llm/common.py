"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

__all__ = ["Scratch", "cut_lineage", "documents", "ready", "run_folder", "text_or_empty", "held_out", "sampling_hash",
           "share_of_hashes", "texts_of"]

# Rows per Arrow batch handed to a Python worker: with documents of 100 KB a batch stays
# near 25 MB, with documents of 3 KB near 1 MB.
ARROW_ROWS = 256

# A word is a run of characters other than space, tab, newline, VT, FF, CR.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def ready(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known, Arrow batches bounded, AQE on."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder (as a URI) in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Intermediate tables as Parquet in the shared folder: a plan that reads one starts at
    files with known sizes, whatever it took to make them, and a lost executor costs only
    the tasks that read them again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count, self.paths = spark, run_folder(spark, name), 0, {}

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def sweep(self, *read: DataFrame) -> None:
        """Delete tables that nothing reads any more, and let Spark drop the shuffle files of
        finished jobs now (it does so once the driver has collected their handles)."""
        for table in read:
            self._delete(self.paths.pop(id(table)))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self) -> None:
        """Delete the tables; call it when nothing reads them any more."""
        self._delete(self.folder)

    def _delete(self, at: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 3, is 1; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampling_hash(id_col: str) -> Column:
    """A hash of the id from 0 to 2**62 - 1, fine enough for samples of very large tables."""
    return F.shiftrightunsigned(F.xxhash64(id_col), 2)


def share_of_hashes(share: float) -> Column:
    """The bound below which ``sampling_hash`` falls for this share of the ids, at least one
    hash value and at most all."""
    return F.lit(max(1, int(min(1.0, share) * (1 << 62)))).cast("long")


def texts_of(column) -> Iterator[str]:
    """Python strings of an Arrow string column; null counts as empty."""
    return (t or "" for t in column.to_pylist())
