"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (bpe_chunks, cover_tree, exact_dedup, langid, order_minhash, packing, periodic_runs, quality, secret_scan, spelling,
               token_counts, toxicity, warc)
from .common import SPACE_CLASS, documents, held_out, ready, run_folder


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op2_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_secret_scan(spark, sf_dir):
    found = secret_scan.scan(documents(spark, sf_dir))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in secret_scan.BASE],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_warc(spark, sf_dir):
    pages = ready(spark).read.parquet(f"{sf_dir}/pages.parquet")
    index = warc.write_archives(pages, run_folder(spark, "warc"))
    back = warc.read_records(index, with_payload=False)
    return back.select(F.col("record_id").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").try_cast("long").alias("refers_to"))


def op5_byte_bpe(spark, sf_dir):
    return bpe_chunks.encode_round_trip(documents(spark, sf_dir))


def op6_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "class_id", "class_size", "n_words", "kept")


def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir))


def op8_quality_rules(spark, sf_dir):
    led = quality.ledger(documents(spark, sf_dir))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base", 1)).alias("base_failed"), quality.passes("web", 2).alias("kept"), "fail_mask")


def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = langid.train(langid.training_rows(docs))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op10_packing(spark, sf_dir):
    pieces = packing.pack(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op11_cover_tree_top_k(spark, sf_dir):
    vectors = ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return cover_tree.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def letter_runs(docs):
    """Maximal runs of letters (A to Z, U+00C0 to U+00FF; A to Z in lower case) of ``documents``, one row
    per occurrence, with the letter left out that the contract of operator 12 deletes."""
    run = F.col("run")
    lower = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(
        F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                    F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z\\u00C0-\\u00FF]+)"), F.lit(1))).alias("run"))
    d = d.select("id", lower.alias("run"))
    d = d.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    return d.select(F.when(F.col("h") % 97 == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length("run"))))
                    .otherwise(run).alias("run"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.group_variants(spelling.vocabulary(letter_runs(documents(spark, sf_dir)), F.col("run")))


def with_planted_runs(docs):
    """``documents`` with the periodic stretches that the contract of operator 13 plants in
    about a tenth of the texts; a row without an id keeps its text."""
    d = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")))
    d = d.withColumns({"n": F.size("w"), "g": F.floor(F.col("h") / 10)})
    d = d.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    d = d.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    rest = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    changed = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), rest))
    return d.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(with_planted_runs(documents(spark, sf_dir)))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    b = F.col("best")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), b["start"].alias("start"), (-b["less"]).alias("length"),
        b["period"].alias("period"), F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_toxicity, op3_secret_scan, op4_warc, op5_byte_bpe, op6_order_minhash, op7_token_counts,
    op8_quality_rules, op9_language_id, op10_packing, op11_cover_tree_top_k, op12_spelling_variants,
    op13_periodic_runs)}

LLM_ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_warc": r"""
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
        q AS (
          SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id,
                 list_transform(range(0, 8), lambda g: ('0x' || substr(x, (5 * g + 1)::BIGINT, 5))::BIGINT) AS n
          FROM p)
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
               array_to_string(list_transform(n, lambda v: array_to_string(list_transform([15, 10, 5, 0],
                 lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM q
    """,
    "op8_quality_rules": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t,
                 list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
          FROM documents),
        g AS (
          SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM d WHERE len(w) >= 8),
        h AS (
          SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + 7], ' ')) AS n FROM g),
        r AS (
          SELECT doc_id, count(DISTINCT q) AS n_repeat_words
          FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM h WHERE n > 1) GROUP BY doc_id),
        m AS (
          SELECT d.doc_id, len(w) AS n_words,
                 coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                 coalesce(r.n_repeat_words, 0) AS n_repeat_words
          FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
        f AS (
          SELECT *,
            (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
            + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
            + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
            + (CASE WHEN n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
            + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
            + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS fail_mask
          FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               (fail_mask & 3) <> 0 AS base_failed, fail_mask = 0 AS kept, fail_mask::BIGINT AS fail_mask
        FROM f
    """,
    "op11_cover_tree_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, r.vec_id,
                 list_sum(list_transform(list_zip(q.e, r.e), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
        SELECT query_id, row_number() OVER b AS rank, vec_id, score
        FROM s WINDOW b AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 5
    """,
    "op12_spelling_variants": r"""
        WITH RECURSIVE bytes AS (SELECT range(0, 256) AS b),
        shifts AS (
          SELECT list_transform(b, lambda x: list_reduce(list_prepend(x, range(0, 8)),
                   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc FROM bytes),
        runs AS (
          SELECT coalesce(doc_id::VARCHAR, '') AS id,
                 translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
          FROM documents),
        per_doc AS (SELECT id, run, count(*) AS c FROM runs GROUP BY ALL),
        hashed AS (
          SELECT run, c, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, strlen(id || ':' || run) + 1),
                     lambda i: ('0x' || substr(hex(encode(id || ':' || run)), 2 * i - 1, 2))::BIGINT)),
                   lambda s, x: xor(crc[(xor(s, x) & 255) + 1], s >> 8))) AS h
          FROM per_doc, shifts),
        words AS (
          SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
          FROM hashed),
        v AS (SELECT word, sum(c)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
        cut AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
        near AS (
          SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
        best AS (
          SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS other FROM near GROUP BY word),
        forms AS (
          SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN top >= 2 * v.n THEN other END AS form, CASE WHEN top >= 2 * v.n THEN top END AS form_n
          FROM v LEFT JOIN best ON v.word = best.word),
        follow AS (
          SELECT word, word AS last, form AS next FROM forms
          UNION ALL SELECT f.word, f.next, g.form FROM follow f JOIN forms g ON f.next = g.word)
        SELECT forms.word, form, last AS root, n, n_near, form_n
        FROM forms JOIN follow ON forms.word = follow.word AND next IS NULL
    """,
}
