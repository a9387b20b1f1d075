"""The numbered queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

from paperloom.llm import (ball_codes, chunked_tokens, decontamination, jaccard_join, language_id, license_scan, packing, periodic_runs,
                           rotated_codes, suffix_dedup, template_removal, token_files, url_lists)
from paperloom.llm.common import read_table
from paperloom.operators.skew import fits_broadcast


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs)


def op2_suffix_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.find_repeats(docs)
    return found.select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_vector_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_rotated_codes(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rotated_codes.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


def list_events(pages):
    """Dated list entries that the hosts of `pages` give rise to: additions, removals and returns by the host's hash."""
    hosts = pages.select(template_removal.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    h = F.conv(F.substring(F.md5(F.encode("host", "utf-8")), 1, 7), 16, 10).cast("long")
    first = F.lit("2024-01-01").cast("date")
    day = lambda n: F.date_add(first, n.cast("int"))
    parent = F.substring_index("host", ".", -2)
    rows = hosts.withColumn("h", h)
    events = F.array(
        F.when(F.col("h") % 3 == 0, F.struct(F.lit("hosts").alias("list"), F.col("host").alias("pattern"), F.lit("add").alias("action"), day(F.col("h") % 200).alias("day"))),
        F.when(F.col("h") % 3 == 0, F.struct(F.lit("hosts").alias("list"), F.col("host").alias("pattern"), F.lit("remove").alias("action"), day(F.col("h") % 200 + 40).alias("day"))),
        F.when(F.col("h") % 6 == 0, F.struct(F.lit("hosts").alias("list"), F.col("host").alias("pattern"), F.lit("add").alias("action"), day(F.col("h") % 200 + 90).alias("day"))),
        F.when(F.col("h") % 5 == 1, F.struct(F.lit("domains").alias("list"), parent.alias("pattern"), F.lit("add").alias("action"), day(F.col("h") % 150 + 100).alias("day"))),
        F.when(F.col("h") % 4 == 1, F.struct(F.lit("paths").alias("list"), F.concat("host", F.lit("/en")).alias("pattern"), F.lit("add").alias("action"), day(F.col("h") % 300).alias("day"))))
    return rows.select(F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select("e.*")


def op5_url_lists(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(365)).cast("int")))
    out = url_lists.evaluate(captures, url_lists.validity_intervals(list_events(pages)))
    return out.select("page_id", "url", "fetched", "blocked", "n_entries", "list", "pattern", "listed_since")


OP5_SQL = r"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + CAST(((page_id % 365) + 365) % 365 AS INTEGER) AS fetched,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)', 1)) AS host,
    [x FOR x IN string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') IF x <> ''] AS parts FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) AS h FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
e AS (SELECT 'hosts' AS list, host AS pattern, 'add' AS action, DATE '2024-01-01' + CAST(h % 200 AS INTEGER) AS day FROM h WHERE h % 3 = 0
  UNION ALL SELECT 'hosts', host, 'remove', DATE '2024-01-01' + CAST(h % 200 + 40 AS INTEGER) FROM h WHERE h % 3 = 0
  UNION ALL SELECT 'hosts', host, 'add', DATE '2024-01-01' + CAST(h % 200 + 90 AS INTEGER) FROM h WHERE h % 6 = 0
  UNION ALL SELECT 'domains', array_to_string(string_split(host, '.')[-2:], '.'), 'add', DATE '2024-01-01' + CAST(h % 150 + 100 AS INTEGER) FROM h WHERE h % 5 = 1
  UNION ALL SELECT 'paths', host || '/en', 'add', DATE '2024-01-01' + CAST(h % 300 AS INTEGER) FROM h WHERE h % 4 = 1),
d AS (SELECT list, pattern, day, max(action) AS action FROM e GROUP BY ALL),
v AS (SELECT * FROM (SELECT list, pattern, action, day AS since, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM d) WHERE action = 'add'),
k AS (SELECT DISTINCT url, fetched, unnest(list_concat(
    [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
    [host || '/' || array_to_string(parts[1:i], '/') FOR i IN range(1, len(parts) + 1)])) AS key FROM p WHERE host <> ''),
a AS (SELECT url, fetched, list, key AS pattern, since, count(*) OVER w AS n_entries,
    row_number() OVER (PARTITION BY url, fetched ORDER BY length(key) DESC, list, key, since) AS r
    FROM k JOIN v ON key = pattern AND since <= fetched AND (until IS NULL OR fetched < until) WINDOW w AS (PARTITION BY url, fetched))
SELECT p.page_id, p.url, p.fetched, a.url IS NOT NULL AS blocked, coalesce(n_entries, 0) AS n_entries, list, pattern, since AS listed_since
FROM p LEFT JOIN a ON p.url = a.url AND p.fetched = a.fetched AND r = 1
"""


def op6_token_files(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.write_and_read(docs, tokenizer("word_bpe_49k.json")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_template_removal(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return template_removal.main_texts(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_jaccard_join(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.near_duplicate_components(docs)


def op9_decontamination(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontamination.contaminated(docs, items).select("doc_id", "item_id", "window_start", "similarity", "distance")


def held_out():
    """Whether a document's language is not to be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op10_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = language_id.train(docs.where("not held_out").select("lang", "text"))
    return language_id.score(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")


def op11_chunked_tokens(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunked_tokens.encode(docs, tokenizer("byte_bpe_50k.json"), decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def looped(doc_id, words):
    """The words of every tenth id by hash, from some word on a repetition of those that follow it."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a: a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, prepare=looped)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.n")).alias("length"),
        F.col("best.period").alias("period"), F.floor(F.expr("(-best.n * 1000) div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_ball_codes(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = ball_codes.compress(vectors)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = F.broadcast(sums) if fits_broadcast(sums) else sums
    sha = hashlib.sha256(ball_codes.books_text(books).encode()).hexdigest()
    return (coded.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", ball_codes.code_text().alias("code"), "error", "label_error", F.lit(sha).alias("codebooks_sha256")))


def queries():
    made = (op1_license_scan, op2_suffix_dedup, op3_vector_packing, op4_rotated_codes, op5_url_lists, op6_token_files,
            op7_template_removal, op8_jaccard_join, op9_decontamination, op10_language_id, op11_chunked_tokens, op12_periodic_runs, op13_ball_codes)
    return {f.__name__: f for f in made}


def oracle_sql():
    return {"op5_url_lists": OP5_SQL}
