"""Quoted CSV read by many tasks (S1, S7, S8): records are found per byte range, not per file.

A file with line breaks inside quotes cannot be cut at any line break, so Spark reads it whole
(``multiLine``) in one task.  Here lines are read as text, which Spark cuts into byte ranges;
a line break ends a record if the quotes before it, from the start of the file, are even.

1. Per byte range the number of quotes is summed (a small table); running sums per file say
   whether a range starts inside quotes.
2. Each range joins its lines to records.  What belongs to a record of an earlier range
   (*head*), runs into the next (*tail*) or lies within one record (*whole*) is a fragment:
   two of them a range at most.
3. Fragments of a record are put together in file order and join the other records.

Quotes inside a quoted field are doubled; outside quotes none may stand (RFC 4180).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, HEAD, TAIL, WHOLE = range(4)


def _pieces(lines: DataFrame, quote: str) -> DataFrame:
    """file, start, line, kind, first, text from lines (file, start, line, value, open)."""
    def run(batches):
        at, held, begun, inside, ranged, fresh = None, [], 0, False, False, False
        rows: list[tuple] = []

        def put(kind):
            nonlocal held, fresh
            rows.append((*at, begun, kind, fresh and at[1] == 0, "\n".join(held)))
            held, fresh = [], False

        def ended():                            # what is open at the end of a range
            if held:
                put(WHOLE if ranged else TAIL)

        def batch():
            nonlocal rows
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
            rows = []
            return out

        names = ["file", "start", "line", "kind", "first", "text"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        for b in batches:
            for file, start, line, value, opened in zip(*(c.to_pylist() for c in b.columns)):
                if (file, start) != at:
                    ended()
                    # a range that starts inside quotes starts with the rest of a record
                    at, inside, ranged, fresh = (file, start), opened, opened, True
                if not held:
                    begun = line
                held.append(value)
                inside ^= bool(value.count(quote) & 1)
                if not inside:
                    put(HEAD if ranged else RECORD)
                    ranged = False
            if rows:
                yield batch()
        ended()
        if rows:
            yield batch()

    return lines.mapInArrow(run, "file string, start bigint, line bigint, kind int, first boolean, text string")


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """file, first (of its file), text of every record of the files; line breaks inside quotes
    stay, one carriage return at a record's end goes, blank records are left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (lines.groupBy("file", "start").agg(F.sum(quotes).alias("q"))
              .select("file", "start", (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2 == 1).alias("open")))
    # the table of ranges is broadcast or shuffled, as its size has it: the sort restores the order
    joined = lines.join(ranges, ["file", "start"]).select("file", "start", "line", "value", "open")
    pieces = _pieces(joined.sortWithinPartitions("file", "start", "line"), quote)
    order = Window.partitionBy("file").orderBy("start", "line")
    parts = pieces.filter(F.col("kind") != RECORD).withColumn(
        "no", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    stitched = parts.groupBy("file", "no").agg(
        F.bool_or("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "line", "text"))).alias("p"))
    out = pieces.filter(F.col("kind") == RECORD).select("file", "first", "text").unionByName(
        stitched.select("file", "first", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text")))
    return out.withColumn("text", F.regexp_replace("text", "\r$", "")).filter(F.col("text").rlike(r"\S"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True,
                    quote: str = '"') -> DataFrame:
    """The rows of quoted CSV files with the columns of ``schema``, in order of position."""
    schema = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    r = quoted_records(spark, path, quote)
    if header:
        r = r.filter(~F.col("first"))
    row = F.from_csv("text", schema, {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"})
    return r.select(row.alias("row")).select("row.*")
