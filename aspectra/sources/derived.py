"""Source files derived from the driver tables, so every reader runs on data that
grows with them.  Files go under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local one."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..plans.tables import gold_items, table
from ..session import ensure_checkpoint_dir
from . import readers as RD


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/aspectra-sources/{name}-{uuid.uuid4().hex[:12]}"


def write_tagged_reviews(spark: SparkSession, sf_dir: str) -> str:
    """pages -> ``<root>/<domain>/{positive,negative}.review`` pseudo-XML records: domain
    from the page language, class by page_id parity, title as review text."""
    root = scratch_path(spark, "tagged")
    p = RD.extract_tags(table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("value")),
                        ["title"])
    lang = F.regexp_extract("url", r"/([a-z]{2})/", 1)
    rec = F.concat(F.lit("<review>\n<unique_id>\n"), F.col("page_id").cast("string"),
                   F.lit("\n</unique_id>\n<product_name>\n"), F.col("url"),
                   F.lit("\n</product_name>\n<rating>\n"), ((F.col("page_id") % 5) + 1).cast("string"),
                   F.lit("\n</rating>\n<review_text>\n"), F.coalesce(F.col("title"), F.lit("")),
                   F.lit("\n</review_text>\n</review>\n"))
    d = p.select(F.when(lang == "", "xx").otherwise(lang).alias("domain"),
                 F.when(F.col("page_id") % 2 == 0, "positive").otherwise("negative").alias("label"),
                 rec.alias("value"))
    for (dom, lab) in [(r.domain, r.label) for r in d.select("domain", "label").distinct().collect()]:
        (d.filter((F.col("domain") == dom) & (F.col("label") == lab)).select("value")
         .write.mode("overwrite").text(f"{root}/{dom}/{lab}.review"))
    return root


def write_gold_xml(spark: SparkSession, sf_dir: str, items=None, root: str | None = None) -> str:
    """benchmark gold (or ``items`` of it) -> ``<root>/{train,test}.xml`` folders of sentence
    records with aspectTerm attributes (term, polarity, from, to)."""
    root = root or scratch_path(spark, "goldxml")
    g = gold_items(spark, sf_dir) if items is None else items
    terms = F.transform(F.arrays_zip("aspect", "polarity"), lambda z: F.struct(
        z["aspect"].alias("_term"), z["polarity"].alias("_polarity"),
        F.instr(F.col("review_text"), z["aspect"]).cast("string").alias("_from"),
        (F.instr(F.col("review_text"), z["aspect"]) + F.length(z["aspect"])).cast("string").alias("_to")))
    x = g.select(F.col("review_id").alias("_id"), F.col("review_text").alias("text"),
                 F.struct(terms.alias("aspectTerm")).alias("aspectTerms"),
                 F.when(F.col("review_id") % 5 == 0, "test").otherwise("train").alias("part"))
    for part in ("train", "test"):
        (x.filter(F.col("part") == part).drop("part").write.mode("overwrite").format("xml")
         .option("rowTag", "sentence").option("rootTag", "sentences").save(f"{root}/{part}.xml"))
    return root


def write_app_csvs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """part -> app metadata CSV (App = name and key, so every app is one row); labelled
    documents -> user-review CSV whose App is the part of ``doc_id % #parts + 1``."""
    root = scratch_path(spark, "apps")
    part = table(spark, sf_dir, "part")
    app = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    apps = part.select(app.alias("App"), "p_partkey", "p_brand")
    n = part.count()
    from ..plans.tables import labelled_reviews
    lr = labelled_reviews(spark, sf_dir)
    rev = (lr.withColumn("p_partkey", (F.col("review_id") % F.lit(n)) + 1)
           .join(part.select("p_partkey", app.alias("App")), "p_partkey")
           .select("App", F.col("review_text").alias("Translated_Review"),
                   F.initcap(F.col("polarity")).alias("Sentiment"),
                   F.when(F.col("polarity") == "positive", 0.5).when(F.col("polarity") == "negative", -0.5)
                   .otherwise(0.0).alias("Sentiment_Polarity"),
                   F.lit(0.5).alias("Sentiment_Subjectivity")))
    opts = dict(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    apps.write.mode("overwrite").options(**opts).csv(f"{root}/apps.csv")
    rev.write.mode("overwrite").options(**opts).csv(f"{root}/reviews.csv")
    return f"{root}/apps.csv", f"{root}/reviews.csv"


def write_gold_opinions_xml(spark: SparkSession, sf_dir: str, items=None, root: str | None = None) -> str:
    """benchmark gold (or ``items`` of it) -> ``<root>/train.xml``: Review records of up to 4 consecutive
    items (review id = item_id // 4), each a sentence with Opinions (none when the item
    has no aspect)."""
    root = root or scratch_path(spark, "goldopinions")
    g = gold_items(spark, sf_dir) if items is None else items
    ops = F.transform(F.arrays_zip("aspect", "polarity"), lambda z: F.struct(
        z["aspect"].alias("_target"), F.lit(None).cast("string").alias("_category"),
        z["polarity"].alias("_polarity"),
        F.instr(F.col("review_text"), z["aspect"]).cast("string").alias("_from"),
        (F.instr(F.col("review_text"), z["aspect"]) + F.length(z["aspect"])).cast("string").alias("_to")))
    sent = F.struct(F.col("review_id").cast("string").alias("_id"), F.col("review_text").alias("text"),
                    F.when(F.size("aspect") > 0, F.struct(ops.alias("Opinion"))).alias("Opinions"))
    rev = (g.select((F.col("review_id") / 4).cast("long").alias("rid"), F.col("review_id").alias("k"),
                    sent.alias("s"))
           .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("k", "s"))).alias("_s")))
    x = rev.select(F.col("rid").cast("string").alias("_rid"),
                   F.struct(F.transform("_s", lambda e: e["s"]).alias("sentence")).alias("sentences"))
    (x.write.mode("overwrite").format("xml").option("rowTag", "Review").option("rootTag", "Reviews")
     .save(f"{root}/train.xml"))
    return root


def write_gold_sources(spark: SparkSession, sf_dir: str) -> str:
    """benchmark gold -> the folders of the four gold datasets: an item belongs to one of
    them, by its id mod 4, in the format of that dataset."""
    root = scratch_path(spark, "goldsources")
    g = gold_items(spark, sf_dir)
    for k, name in enumerate((RD.GOLD_2014, RD.GOLD_2015, RD.GOLD_2016, RD.GOLD_MAMS)):
        write = write_gold_opinions_xml if name in (RD.GOLD_2015, RD.GOLD_2016) else write_gold_xml
        write(spark, sf_dir, g.filter(F.col("review_id") % 4 == k), RD.source_path(root, name))
    return root


def write_gold_csv(spark: SparkSession, sf_dir: str) -> str:
    """benchmark gold -> legacy ';' CSV with stringified lists; of every ten items one list
    has no closing bracket, one text is blank and one row has a field too many."""
    path = scratch_path(spark, "goldcsv")
    g = gold_items(spark, sf_dir)
    k = F.col("review_id") % 10
    items = F.array_join(F.transform("aspect", lambda a: F.concat(F.lit("'"), a, F.lit("'"))), ", ")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.when(k == 1, F.lit(" ")).otherwise(F.col("review_text"))
    listed = F.concat(F.lit("["), items, F.when(k == 0, F.lit("")).otherwise(F.lit("]")))
    line = F.concat(quoted(text), F.lit(";"), quoted(listed), F.when(k == 2, F.lit(";extra")).otherwise(F.lit("")))
    g.select(line.alias("value")).write.text(path)
    return path
