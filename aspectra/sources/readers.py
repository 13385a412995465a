"""Review and gold sources and sinks.

Every reader returns a DataFrame with an explicit schema; nothing is parsed row by row
in Python.  Sinks write Parquet partitioned by the columns a later reader filters on.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..operators.polarity import rating_to_polarity

# --------------------------------------------------------------------------------------
# FIXED VALUES: dataset names (values of the ``source`` column) and their default folders
# under a data root.
# --------------------------------------------------------------------------------------
APP_STORE = "google-play"
HOTELS = "lara-tripadvisor"
SHOP = "multi-domain-amazon"
GOLD_2014 = "sem-eval-2014"
GOLD_2015 = "sem-eval-2015"
GOLD_2016 = "sem-eval-2016"
GOLD_MAMS = "mams_atsa"

REGISTRY = {
    SHOP: "sorted_data", HOTELS: "json", APP_STORE: "archive", GOLD_2014: "sem_eval_2014",
    GOLD_MAMS: "MAMS-ATSA/raw", GOLD_2015: "sem_eval_2015", GOLD_2016: "sem_eval_2016",
}


def source_path(root: str, name: str) -> str:
    """Folder of a registered dataset under ``root``."""
    if name not in REGISTRY:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(REGISTRY)}")
    return os.path.join(root, REGISTRY[name])


# ---------------------------------------------------------------------------------------
# S1 + J1 + P1: app-store reviews (two CSV files joined on the app name)
# ---------------------------------------------------------------------------------------
# FIXED VALUES: columns of the app-store review file.
APP_REVIEW_SCHEMA = T.StructType([
    T.StructField("App", T.StringType()), T.StructField("Translated_Review", T.StringType()),
    T.StructField("Sentiment", T.StringType()), T.StructField("Sentiment_Polarity", T.DoubleType()),
    T.StructField("Sentiment_Subjectivity", T.DoubleType()),
])


def join_app_reviews(apps: DataFrame, reviews: DataFrame, dedupe_apps: bool = False) -> DataFrame:
    """Inner equi-join on ``App``; duplicate app rows multiply reviews unless
    ``dedupe_apps``.  Spark picks broadcast or sort-merge from the sizes (AQE)."""
    a = apps.dropDuplicates(["App"]) if dedupe_apps else apps
    return a.join(reviews, "App", "inner")


def read_app_reviews(spark: SparkSession, apps_csv: str, reviews_csv: str,
                     dedupe_apps: bool = False, multi_line: bool = True, by_ranges: bool = False) -> DataFrame:
    """S1.  ``by_ranges`` lets many tasks read a large review file whose texts may hold line
    breaks (``splitting.read_quoted_csv``); ``multi_line=False`` does if they hold none."""
    opts = dict(header=True, quote='"', escape='"', multiLine=multi_line)
    apps = spark.read.options(**opts).csv(apps_csv).select("App")
    if by_ranges:
        from .splitting import read_quoted_csv
        rev = read_quoted_csv(spark, reviews_csv, APP_REVIEW_SCHEMA)
    else:
        rev = spark.read.options(**opts).schema(APP_REVIEW_SCHEMA).csv(reviews_csv)
    j = join_app_reviews(apps, rev, dedupe_apps)
    return j.select(F.lit(APP_STORE).alias("source"), F.col("App").alias("product_name"),
                    F.col("Translated_Review").alias("review_text"),
                    F.col("Sentiment_Polarity").alias("rating"),
                    F.lower(F.col("Sentiment")).alias("polarity"))


# ---------------------------------------------------------------------------------------
# Nested hotel reviews (one JSON object per file)
# ---------------------------------------------------------------------------------------
HOTEL_SCHEMA = T.StructType([
    T.StructField("HotelInfo", T.StructType([T.StructField("HotelID", T.StringType())])),
    T.StructField("Reviews", T.ArrayType(T.StructType([
        T.StructField("Ratings", T.StructType([T.StructField("Overall", T.StringType())])),
        T.StructField("Content", T.StringType())]))),
])


def explode_nested_reviews(nested: DataFrame, compat_prefix: bool = False) -> DataFrame:
    """S2 core: one row per element of ``Reviews``.  A review whose rating is missing or
    not numeric is rejected alone (``try_cast``); ``compat_prefix`` instead keeps only
    the elements before the first bad one of each file.

    An optional ``_offset`` column gives the position of the record's first element in
    its file (files split into bounded chunks).  The first bad position per file is an
    aggregate (combined map-side) joined back, so a huge file is never one task.
    """
    off = F.col("_offset") if "_offset" in nested.columns else F.lit(0)
    x = nested.select(F.col("_file"), F.col("HotelInfo.HotelID").alias("product_name"), off.alias("_offset"),
                      F.posexplode("Reviews").alias("review_pos", "r"))
    x = x.select("_file", "product_name", (F.col("_offset") + F.col("review_pos")).alias("review_pos"),
                 F.col("r.Content").alias("review_text"),
                 F.expr("try_cast(r.Ratings.Overall AS DOUBLE)").alias("rating"))
    bad = F.col("rating").isNull() | F.col("review_text").isNull()
    if compat_prefix:
        first_bad = x.filter(bad).groupBy("_file").agg(F.min("review_pos").alias("_first_bad"))
        x = (x.join(first_bad, "_file", "left")
             .filter(F.col("_first_bad").isNull() | (F.col("review_pos") < F.col("_first_bad"))).drop("_first_bad"))
    else:
        x = x.filter(~bad)
    return x.select(F.lit(HOTELS).alias("source"), "product_name", "review_pos", "review_text", "rating",
                    rating_to_polarity(F.col("rating")).alias("polarity"))


def read_hotel_reviews(spark: SparkSession, path: str, compat_prefix: bool = False) -> DataFrame:
    nested = (spark.read.schema(HOTEL_SCHEMA).option("multiLine", True).json(path)
              .withColumn("_file", F.col("_metadata.file_path")))
    return explode_nested_reviews(nested, compat_prefix)


NEST_CHUNK = 256


def nest_conversations(conv: DataFrame, chunk: int = NEST_CHUNK) -> DataFrame:
    """Driver-table stand-in for hotel files: each conversation is one "file" of nested
    reviews (one per turn; assistant turns carry no rating).  Turns are nested in chunks
    of at most ``chunk`` elements (``_offset`` = position of the chunk's first turn), so
    no array grows with a conversation's length.  ``turn`` is the 0-based position of
    the turn in its conversation."""
    rating = F.when(F.col("role") == "user", ((F.col("turn") % 5) + 1).cast("string"))
    elem = F.struct(F.struct(rating.alias("Overall")).alias("Ratings"), F.col("text").alias("Content"))
    c = conv.withColumn("_pos", F.col("turn")).withColumn("_chunk", F.floor(F.col("_pos") / chunk))
    g = c.groupBy("conv_id", "_chunk").agg(
        F.array_sort(F.collect_list(F.struct("_pos", elem.alias("e")))).alias("_r"))
    return g.select(F.col("conv_id").cast("string").alias("_file"),
                    F.struct(F.col("conv_id").cast("string").alias("HotelID")).alias("HotelInfo"),
                    (F.col("_chunk") * chunk).cast("int").alias("_offset"),
                    F.transform("_r", lambda x: x["e"]).alias("Reviews"))


# ---------------------------------------------------------------------------------------
# S3: tagged shop reviews (line-oriented pseudo-XML, one file per class per domain)
# ---------------------------------------------------------------------------------------
# FIXED VALUES: tags of a shop review that are read.
SHOP_FIELDS = ["product_name", "rating", "review_text"]


def extract_tags(records: DataFrame, fields: list[str], value_col: str = "value") -> DataFrame:
    """Value of each ``<tag> ... </tag>`` field by name (whole value, trimmed; null when
    the tag is absent)."""
    out = records
    for f in fields:
        tag = rf"<{f}(?:\s[^>]*)?>"        # not the start of a longer tag name
        v = F.regexp_extract(F.col(value_col), f"(?s){tag}(.*?)</{f}>", 1)
        stripped = F.regexp_replace(v, r"^\s+|\s+$", "")
        out = out.withColumn(f, F.when(F.col(value_col).rlike(tag), stripped))
    return out


def read_tagged_reviews(spark: SparkSession, root: str) -> DataFrame:
    """``<root>/<domain>/{positive,negative}.review``; one record per review
    (``lineSep`` = closing tag); label from the file name, domain from the folder."""
    recs = (spark.read.option("lineSep", "</review>").text(f"{root}/*/{{positive,negative}}.review")
            .withColumn("_path", F.col("_metadata.file_path"))
            .filter(F.col("value").contains("<review>")))
    x = extract_tags(recs, SHOP_FIELDS)
    # a "file" may also be a folder of part files written by Spark
    label = F.regexp_extract("_path", r"/(positive|negative)\.review(/|$)", 1)
    domain = F.regexp_extract("_path", r"/([^/]+)/(positive|negative)\.review(/|$)", 1)
    return x.select(F.lit(SHOP).alias("source"), "product_name", "review_text",
                    F.expr("try_cast(rating AS DOUBLE)").alias("rating"), label.alias("polarity"),
                    domain.alias("domain"))


# ---------------------------------------------------------------------------------------
# Gold XML
# ---------------------------------------------------------------------------------------
_TERM = T.StructType([T.StructField(f, T.StringType()) for f in ("_term", "_polarity", "_from", "_to")])
TERMS_XML_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("aspectTerms", T.StructType([T.StructField("aspectTerm", T.ArrayType(_TERM))])),
])
_OPINION = T.StructType([T.StructField(f, T.StringType())
                         for f in ("_target", "_category", "_polarity", "_from", "_to")])
OPINIONS_XML_SCHEMA = T.StructType([
    T.StructField("_rid", T.StringType()),
    T.StructField("sentences", T.StructType([T.StructField("sentence", T.ArrayType(T.StructType([
        T.StructField("_id", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("Opinions", T.StructType([T.StructField("Opinion", T.ArrayType(_OPINION))])),
    ])))])),
])


def read_gold_terms(spark: SparkSession, path: str, source: str = GOLD_MAMS,
                    domain: str = "restaurants") -> DataFrame:
    """``<sentence><text/><aspectTerms><aspectTerm term polarity from to/>``.
    Sentences lacking text or a term list are skipped; partition from the file name."""
    x = (spark.read.format("xml").option("rowTag", "sentence").schema(TERMS_XML_SCHEMA).load(path)
         .withColumn("_path", F.col("_metadata.file_path")))
    terms = F.col("aspectTerms.aspectTerm")
    x = x.filter(F.col("text").isNotNull() & terms.isNotNull())
    return x.select(F.col("text").cast("string").alias("review_text"),
                    F.transform(terms, lambda t: t["_term"].cast("string")).alias("aspect"),
                    F.transform(terms, lambda t: F.lower(t["_polarity"].cast("string"))).alias("polarity"),
                    F.lit(source).alias("source"), F.lit(domain).alias("domain"),
                    F.regexp_extract("_path", r"/([^/]+?)\.xml(/|$)", 1).alias("partition"),
                    F.transform(terms, lambda t: F.struct(t["_from"].cast("int").alias("start"),
                                                          t["_to"].cast("int").alias("end"))).alias("position"))


def read_gold_opinions(spark: SparkSession, path: str, year: str = "2015",
                       compat_truncate: bool = False) -> DataFrame:
    """Review -> sentences -> sentence -> Opinions/Opinion.  Years other than 2015
    and 2016 are an error.  A sentence without opinions is dropped; ``compat_truncate``
    also drops the rest of its review."""
    if year not in ("2015", "2016"):
        raise ValueError(f"year must be 2015 or 2016, got {year}")
    source = GOLD_2015 if year == "2015" else GOLD_2016
    x = (spark.read.format("xml").option("rowTag", "Review").schema(OPINIONS_XML_SCHEMA).load(path)
         .withColumn("_path", F.col("_metadata.file_path"))
         .withColumn("_rid", F.monotonically_increasing_id()))
    s = x.select("_path", "_rid", F.posexplode("sentences.sentence").alias("pos", "s"))
    ops = F.col("s.Opinions.Opinion")
    if compat_truncate:
        w = Window.partitionBy("_rid")
        s = s.withColumn("_cut", F.min(F.when(ops.isNull(), F.col("pos"))).over(w))
        s = s.filter(F.col("_cut").isNull() | (F.col("pos") < F.col("_cut")))
    s = s.filter(ops.isNotNull())
    return s.select(F.col("s.text").cast("string").alias("review_text"),
                    F.transform(ops, lambda o: o["_target"].cast("string")).alias("aspect"),
                    F.transform(ops, lambda o: F.lower(o["_polarity"].cast("string"))).alias("polarity"),
                    F.lit(source).alias("source"), F.lit("restaurants").alias("domain"),
                    F.regexp_extract("_path", r"/([^/]+?)\.xml(/|$)", 1).alias("partition"),
                    F.transform(ops, lambda o: F.struct(o["_from"].cast("int").alias("start"),
                                                        o["_to"].cast("int").alias("end"))).alias("position"))


# ---------------------------------------------------------------------------------------
# S7 / S8 / K1-K5
# ---------------------------------------------------------------------------------------
# Legacy files: quotes inside a quoted field are doubled, texts may hold newlines.
LEGACY_CSV = {"sep": ";", "header": True, "quote": '"', "escape": '"', "multiLine": True}


def read_reviews_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The reviews dataset (Parquet written by ``write_reviews``; CSV ';' accepted)."""
    if path.endswith(".csv"):
        schema = "idx long, source string, product_name string, review_text string, rating double, polarity string"
        return spark.read.options(**LEGACY_CSV).schema(schema).csv(path).drop("idx")
    return spark.read.parquet(path)


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """Legacy ';' CSV with stringified lists -> arrays; bad list texts give null
    (routed to rejects by the caller)."""
    g = spark.read.options(**LEGACY_CSV).csv(path)
    return g.select("review_text", TX.parse_list_literal(F.col("aspect")).alias("aspect"))


def split_rejects(df: DataFrame, reason, source: str) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rejects): a reject keeps its source, reason code and the row
    as JSON, so nothing turns into null unseen."""
    d = df.withColumn("_reason", reason)
    bad = d.filter(F.col("_reason").isNotNull())
    rejects = bad.select(F.lit(source).alias("source"), F.col("_reason").alias("reason"),
                         F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("record"))
    return d.filter(F.col("_reason").isNull()).drop("_reason"), rejects


def read_gold_csv_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S8 with rejects: (gold rows review_text, aspect; rejects).  A row is rejected if it has
    another number of fields than the header, no text, or a list that cannot be parsed."""
    raw = (spark.read.options(**{**LEGACY_CSV, "header": header}).option("columnNameOfCorruptRecord", "_broken")
           .schema("review_text string, aspect string, _broken string").csv(path))
    parsed = raw.withColumn("items", TX.parse_list_literal(F.col("aspect")))
    reason = (F.when(F.col("_broken").isNotNull(), F.lit("malformed_row"))
              .when(~F.coalesce(F.col("review_text"), F.lit("")).rlike(r"\S"), F.lit("no_text"))
              .when(F.col("items").isNull(), F.lit("bad_list")))
    good, rejects = split_rejects(parsed, reason, "gold-csv")
    return good.select("review_text", F.col("items").alias("aspect")), rejects


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejects by source and reason, beside the dataset they were kept out of."""
    rejects.write.mode("append").partitionBy("source", "reason").parquet(path)


def write_reviews(df: DataFrame, path: str) -> None:
    """K1: Parquet partitioned by source."""
    df.write.mode("overwrite").partitionBy("source").parquet(path)


REVIEW_COLUMNS = {"review_id": "string", "source": "string", "product_name": "string", "review_text": "string",
                  "rating": "double", "polarity": "string"}


def app_review_rows(apps: DataFrame) -> DataFrame:
    """S1 rows as rows of the reviews dataset: the file has no ids, so a row's id is made of its
    source, product and text; the text is cleaned (T1)."""
    key = F.md5(F.concat_ws("\x01", "product_name", "review_text").cast("binary"))
    return apps.select(F.concat_ws(":", "source", key).alias("review_id"), "source", "product_name",
                       TX.clean_text(F.col("review_text")).alias("review_text"), "rating", "polarity")


def write_reviews_dataset(parts: list[DataFrame], path: str) -> DataFrame:
    """K1 / U1 as a dataset with a contract: the union of the parts (``REVIEW_COLUMNS``; a missing
    column is null) below ``path/reviews`` by source, rows without id, source or text below
    ``path/rejects`` by source and reason, and ``path/manifest``: rows and rejects per source.
    Returns the manifest, read back."""
    spark = parts[0].sparkSession
    whole = [p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(k).alias(c) for c, k in REVIEW_COLUMNS.items()]) for p in parts]
    out = whole[0]
    for p in whole[1:]:
        out = out.unionByName(p)
    reason = (F.when(F.col("review_id").isNull(), F.lit("no_id")).when(F.col("source").isNull(), F.lit("no_source"))
              .when(F.col("review_text").isNull(), F.lit("no_text")))
    # one pass over the sources: every row is written once, with its reason, and read by the rest
    out.withColumn("reason", F.coalesce(reason, F.lit("kept"))).withColumn("source", F.coalesce("source", F.lit("unknown"))) \
        .write.mode("overwrite").partitionBy("reason", "source").parquet(f"{path}/all")
    rows = spark.read.parquet(f"{path}/all")
    counts = rows.groupBy("source").agg(F.count_if(F.col("reason") == "kept").alias("rows"),
                                        F.count_if(F.col("reason") != "kept").alias("rejects"))
    counts.write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_reviews_of(spark: SparkSession, path: str, sources: list[str] | None = None) -> DataFrame:
    """The kept rows of a dataset of ``write_reviews_dataset``; only the folders of ``sources``
    are read.  An unknown source is an error (the manifest knows them all)."""
    known = {r.source for r in spark.read.parquet(f"{path}/manifest").select("source").collect()}
    if sources is not None and not set(sources) <= known:
        raise KeyError(f"unknown sources {sorted(set(sources) - known)}; the dataset has {sorted(known)}")
    r = spark.read.parquet(f"{path}/all").filter(F.col("reason") == "kept").drop("reason")
    return r if sources is None else r.filter(F.col("source").isin(*sources))


def write_bucketed_reviews(df: DataFrame, table_name: str, path: str, buckets: int) -> DataFrame:
    """Corpus table bucketed (and sorted) by ``review_id`` at ``path``: every later
    per-review step reads it without any shuffle (``annotate_corpus(...,
    assume_partitioned=True)``).  The rows are dealt to their buckets first, so a bucket is one
    file instead of one per writing task.  Returns the table."""
    (df.repartition(buckets, "review_id").write.bucketBy(buckets, "review_id").sortBy("review_id").option("path", path)
       .mode("overwrite").saveAsTable(table_name))
    return df.sparkSession.table(table_name)


def write_gold(df: DataFrame, path: str) -> None:
    """K2: Parquet partitioned by source and partition."""
    df.write.mode("overwrite").partitionBy("source", "partition").parquet(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3: predictions; CSV output turns arrays into JSON strings."""
    if fmt == "csv":
        cols = [F.to_json(F.col(f.name)).alias(f.name) if f.dataType.simpleString().startswith("array")
                else F.col(f.name) for f in df.schema.fields]
        df.select(*cols).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def build_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + P1 + T1 over the driver tables: documents with labels, nested conversation
    reviews and tagged pages, cleaned, one schema.  ``review_id`` is the source and the
    id within it, so it is unique over all sources."""
    from ..plans.tables import labelled_reviews, table
    docs = labelled_reviews(spark, sf_dir).select(
        F.concat_ws(":", "source", F.col("review_id").cast("string")).alias("review_id"), "source", F.lit(None).cast("string").alias("product_name"), "review_text",
        F.lit(None).cast("double").alias("rating"), "polarity")
    conv = explode_nested_reviews(nest_conversations(table(spark, sf_dir, "conversations")))
    conv = conv.select(F.concat_ws(":", "source", "product_name", F.col("review_pos").cast("string")).alias("review_id"),
                       "source", "product_name", "review_text", "rating", "polarity")
    pages = extract_tags(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("value")), ["title"])
    pages = pages.select(F.concat_ws(":", F.lit(SHOP), F.col("page_id").cast("string")).alias("review_id"), F.lit(SHOP).alias("source"),
                         F.lit(None).cast("string").alias("product_name"), F.col("title").alias("review_text"),
                         F.lit(None).cast("double").alias("rating"), F.lit(None).cast("string").alias("polarity"))
    u = docs.unionByName(conv).unionByName(pages)
    return u.withColumn("review_text", TX.clean_text(F.col("review_text")))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Read a gold dataset written by ``write_gold`` (partition columns restored)."""
    return spark.read.parquet(path)


GOLD_COLUMNS = {"review_text": "string", "aspect": "array<string>", "polarity": "array<string>", "source": "string",
                "domain": "string", "partition": "string", "position": "array<struct<start:int,end:int>>"}


def build_gold(parts: list[DataFrame]) -> DataFrame:
    """Bag union of gold sources (2014, 2015, 2016, MAMS) in one schema; a column that a
    source does not have is null there."""
    def whole(p):
        return p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(kind).alias(c) for c, kind in GOLD_COLUMNS.items()])
    out = whole(parts[0])
    for p in parts[1:]:
        out = out.unionByName(whole(p))
    return out


# Dataset name -> reader of its folder.
READERS = {
    SHOP: lambda spark, folder: read_tagged_reviews(spark, folder),
    HOTELS: lambda spark, folder: read_hotel_reviews(spark, f"{folder}/*.json"),
    APP_STORE: lambda spark, folder: read_app_reviews(spark, f"{folder}/apps.csv", f"{folder}/reviews.csv"),
    GOLD_2014: lambda spark, folder: read_gold_terms(spark, f"{folder}/*.xml", source=GOLD_2014, domain="laptop").drop("position"),
    GOLD_2015: lambda spark, folder: read_gold_opinions(spark, f"{folder}/*.xml", year="2015"),
    GOLD_2016: lambda spark, folder: read_gold_opinions(spark, f"{folder}/*.xml", year="2016"),
    GOLD_MAMS: lambda spark, folder: read_gold_terms(spark, f"{folder}/*.xml", source=GOLD_MAMS),
}


def read_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a registered dataset below ``root``."""
    return READERS[name](spark, source_path(root, name))


def read_gold_sources(spark: SparkSession, root: str) -> DataFrame:
    """The union of the four gold datasets below ``root``."""
    return build_gold([read_dataset(spark, root, n) for n in (GOLD_2014, GOLD_2015, GOLD_2016, GOLD_MAMS)])
