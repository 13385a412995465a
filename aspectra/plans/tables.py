"""Mapping of the driver's tables onto the review data model.

* reviews: ``documents`` (review_id = doc_id, review_text = text, source)
  in every language.
* polarity labels: ``labels`` — quality 1 and toxic 0 -> positive; quality 0 ->
  negative; quality 1 and toxic 1 -> conflict.
* numeric ratings: ``events.value``.
* gold aspects: the sentences of ``benchmark`` (id = item_id * 2**20 + position), derived
  from the sentence's own words by ``id % 8``: one word / two words / an absent word / NULL /
  a word plus NULL / none / two words apart / two words swapped; gold polarity by ``id % 4``.
* fan-out join: ``part`` x ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX
from ..operators import bio as B


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def label_from_quality(quality: Column, toxic: Column) -> Column:
    return (F.when((quality == 1) & (toxic == 0), F.lit(S.POSITIVE))
             .when(quality == 0, F.lit(S.NEGATIVE))
             .when((quality == 1) & (toxic == 1), F.lit(S.CONFLICT)))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "documents")
            .select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text")))


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label row: review_id, source, review_text, polarity."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return (d.join(lab, "doc_id")
            .select(F.col("doc_id").alias("review_id"), "source", F.col("text").alias("review_text"),
                    label_from_quality(F.col("quality"), F.col("toxic")).alias("polarity")))


def gold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark -> gold table: review_id, review_text, aspect (array), polarity (array)."""
    b = (table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(TX.sentence_pieces(F.col("text"))).alias("pos", "t"))
         .select((F.col("item_id") * 1048576 + F.col("pos")).alias("item_id"),
                 F.regexp_replace("t", r"^\s+|\s+$", "").alias("text")).filter(F.col("text") != ""))
    w = B.words(F.col("text"))
    k = F.col("item_id") % 8
    w0, w1, w2 = F.get(w, 0), F.get(w, 1), F.get(w, 2)
    asp = (F.when(k == 0, F.array(w2))
            .when(k == 1, F.array(F.concat_ws(" ", w1, w2)))
            .when(k == 2, F.array(F.lit("zzqabsent")))
            .when(k == 3, F.array(F.lit(S.NULL_ASPECT)))
            .when(k == 4, F.array(w0, F.lit(S.NULL_ASPECT)))
            .when(k == 6, F.array(w0, w2))
            .when(k == 7, F.array(F.concat_ws(" ", w1, w0)))
            .otherwise(F.array().cast("array<string>")))
    pol_names = F.array(*[F.lit(x) for x in (S.POSITIVE, S.NEGATIVE, S.NEUTRAL, S.CONFLICT)])
    pol = F.get(pol_names, (F.col("item_id") % 4).cast("int"))
    g = b.select(F.col("item_id").alias("review_id"), F.col("text").alias("review_text"), asp.alias("aspect"),
                 pol.alias("_pol"))
    g = g.withColumn("aspect", F.filter("aspect", lambda a: a.isNotNull() & (a != "")))
    return g.withColumn("polarity", F.transform("aspect", lambda a: F.col("_pol"))).drop("_pol")


def finalize(df: DataFrame) -> DataFrame:
    """Comparable output: integers as bigint, floats rounded to 6 digits, arrays joined
    with '|' (nulls as empty strings)."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if t in ("int", "smallint", "tinyint", "bigint"):
            c = c.cast("bigint")
        elif t in ("double", "float"):
            c = F.round(c.cast("double"), 6)
        elif t.startswith("array"):
            c = F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(""))), "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)
