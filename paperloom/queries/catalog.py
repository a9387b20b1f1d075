"""Manifest totals, profiles, categories, filters, paths and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions import fields, paths
from paperloom.operators import aggregates as A, filters, sets, topk
from paperloom.queries.registry import Tables, query
from paperloom.sources import files


def manifest(t: Tables):
    """Orders as archives: price in cents as size, order date as upload time."""
    return t.orders.select(
        F.col("o_orderkey").alias("seq_num"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.date_format("o_orderdate", "yyMM").alias("yymm"),
    )


MANIFEST_SQL = """
  SELECT o_orderkey AS seq_num, CAST(round(o_totalprice * 100) AS BIGINT) AS size,
         CAST(o_orderdate AS TIMESTAMP) AS timestamp, strftime(o_orderdate, '%y%m') AS yymm
  FROM orders"""


@query(f"""
WITH m AS ({MANIFEST_SQL})
SELECT count(*) AS files, round(CAST(sum(size) AS DOUBLE) / 1e9, 2) AS total_gb FROM m""")
def manifest_totals(t):
    return A.size_totals(manifest(t))


@query(f"""
WITH m AS ({MANIFEST_SQL})
SELECT count(*) AS files, CAST(coalesce(sum(size), 0) AS DOUBLE) / 1e9 AS total_gb
FROM m WHERE substr(yymm, 1, 2) = '98'""")
def manifest_year_slice(t):
    return A.year_totals(manifest(t), "98")


@query(f"""
WITH m AS ({MANIFEST_SQL})
SELECT strftime(min(timestamp), '%m/%d/%Y') AS oldest, strftime(max(timestamp), '%m/%d/%Y') AS newest
FROM m""")
def manifest_time_range(t):
    return A.time_range(manifest(t))


@query(f"""
WITH m AS ({MANIFEST_SQL})
SELECT count(*) FILTER (WHERE size > 40000000) AS oversize,
       round(CAST(max(size) AS DOUBLE) / 1e6, 2) AS max_mb FROM m""")
def size_threshold(t):
    return A.oversize_totals(manifest(t), limit=40_000_000)


@query(f"""
WITH m AS ({MANIFEST_SQL})
SELECT seq_num, size FROM m WHERE size > 40000000""")
def oversize_archives(t):
    return filters.oversize(manifest(t), limit=40_000_000).select("seq_num", "size")


@query("""
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS column_name, count(*) FILTER (WHERE doc_id IS NULL) AS nulls FROM j
UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM j
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM j
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM j""")
def null_profile(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return A.null_profile(joined)


def categorised(t: Tables):
    return t.part.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("categories"))


@query("""
SELECT category, count(*) AS cnt
FROM (SELECT unnest(string_split_regex(trim(p_name), '\\s+')) AS category FROM part)
GROUP BY category""")
def category_counts(t):
    return A.category_counts(categorised(t))


@query("""
SELECT split_part(p_name, ' ', 1) AS category, count(*) AS cnt FROM part GROUP BY 1""")
def primary_category_counts(t):
    return A.primary_category_counts(categorised(t))


@query("""
SELECT count(DISTINCT category) AS categories, count(DISTINCT first) AS primary_categories
FROM (SELECT unnest(string_split(p_name, ' ')) AS category, split_part(p_name, ' ', 1) AS first
      FROM part)""")
def distinct_categories(t):
    return A.distinct_categories(categorised(t))


@query("""SELECT count(*) AS cnt FROM part WHERE starts_with(p_name, 'red')""")
def subject_size(t):
    return A.subject_size(categorised(t), "red")


PART_TYPE_CODES = {"ECONOMY": 0, "STANDARD": 1, "SMALL": 2, "MEDIUM": 3, "LARGE": 4}


@query("""
SELECT p_partkey, CAST(CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2
  WHEN 'MEDIUM' THEN 3 WHEN 'LARGE' THEN 4 ELSE 0 END AS INTEGER) AS main_int FROM part""")
def category_code(t):
    return t.part.select(
        "p_partkey", fields.category_code("p_type", PART_TYPE_CODES).alias("main_int")
    )


@query("""
SELECT event_type, count(*) AS cnt FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def value_counts(t):
    return A.value_counts(t.events, "event_type")


@query("""
SELECT md5(text) AS digest, count(*) AS cnt FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicate_keys(t):
    repeated = A.duplicate_keys(t.documents, "text")
    return repeated.select(F.md5("text").alias("digest"), "cnt")


@query("""
SELECT strftime(max(ts), '%Y-%m-%d') AS high_water,
       strftime(CAST(max(ts) AS DATE) + 1, '%Y-%m-%d') AS next_from FROM events""")
def high_water_date(t):
    mark = A.high_water(t.events, "ts")
    return mark.select(
        F.date_format("high_water", "yyyy-MM-dd").alias("high_water"),
        fields.next_day("high_water").alias("next_from"),
    )


@query("""
SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM labels) AS right_rows,
       (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) AS same""")
def same_size(t):
    return A.same_size(t.documents, t.labels)


@query("""
SELECT conv_id, md5(string_agg(text, '' ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id""")
def joined_text(t):
    whole = A.joined_text(t.conversations, "conv_id", "turn", "text")
    return whole.select("conv_id", F.md5("text").alias("digest"))


@query("""
SELECT p_name AS category, count(*) AS cnt FROM part GROUP BY p_name ORDER BY cnt DESC, p_name LIMIT 5""")
def top_categories(t):
    return topk.top_values(t.part.withColumnRenamed("p_name", "category"), "category", 5)


@query("""
WITH top AS (SELECT p_name FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 5)
SELECT p_partkey, p_name FROM part WHERE p_name IN (SELECT p_name FROM top)""")
def rows_of_top_categories(t):
    return topk.keep_top_values(t.part, "p_name", 5).select("p_partkey", "p_name")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS datestamp, event_type AS spec FROM events
WHERE event_type = 'click' AND strftime(ts, '%Y-%m-%d') >= '2024-01-10'""")
def harvest_window(t):
    records = t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("datestamp"),
        F.col("event_type").alias("spec"),
    )
    return filters.harvest_window(records, "click", "2024-01-10")


@query("""SELECT p_partkey, p_brand AS title FROM part WHERE p_brand < 'Brand#2'""")
def titles_before(t):
    listing = t.part.select("p_partkey", F.col("p_brand").alias("title"))
    return filters.titles_relative_to(listing, "Brand#2")


@query("""
WITH inventory AS (
  SELECT 'n' || n_nationkey AS id, n_name AS title, 'r' || n_regionkey AS parent_id, 'folder' AS mime_type,
         false AS trashed FROM nation
  UNION ALL
  SELECT 'c' || c_custkey, c_name, 'n' || c_nationkey, 'file', c_acctbal < 0 FROM customer)
SELECT f.id, f.title FROM inventory f JOIN inventory d ON f.parent_id = d.id
WHERE NOT f.trashed AND d.title = 'NATION_3' AND d.parent_id = 'r3' AND d.mime_type = 'folder'""")
def mirror_listing(t):
    folders = t.nation.select(
        F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("title"),
        F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.lit("folder").alias("mime_type"),
        F.lit(False).alias("trashed"),
    )
    entries = t.customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("title"),
        F.concat(F.lit("n"), "c_nationkey").alias("parent_id"), F.lit("file").alias("mime_type"),
        (F.col("c_acctbal") < 0).alias("trashed"),
    )
    listed = files.mirror_inventory(folders.unionByName(entries), "NATION_3", root="r3", folder_mime="folder")
    return topk.sort_by_title(listed.select("id", "title"))


@query("""
SELECT page_id, regexp_replace(url, '^.*/', '') AS base_name,
       regexp_replace(regexp_replace(url, '^.*/', ''), '^(\\.*[^.].*)\\.[^.]*$', '\\1') AS stem,
       replace(url, '/', '') AS compact_id,
       'xml/' || page_id || '.xml' AS markup_path,
       'https://example.org/e-print/' || page_id AS source_url,
       'latex/' || regexp_replace(regexp_replace(url, '^.*/', ''), '^(\\.*[^.].*)\\.[^.]*$', '\\1')
         AS archive_directory
FROM pages""")
def doc_id_from_path(t):
    page = F.col("page_id").cast("string")
    return t.pages.select(
        "page_id", paths.base_name("url").alias("base_name"), paths.stem("url").alias("stem"),
        paths.compact_id("url").alias("compact_id"), paths.markup_path(page).alias("markup_path"),
        paths.source_url(page).alias("source_url"),
        paths.archive_directory("url").alias("archive_directory"),
    )


@query("""
WITH headers AS (
  SELECT event_id,
    CASE event_type WHEN 'view' THEN 'application/pdf' WHEN 'click' THEN 'application/postscript'
      WHEN 'signup' THEN 'application/x-eprint-tar' WHEN 'purchase' THEN 'application/x-eprint'
      ELSE 'application/x-dvi' END AS ctype,
    CASE WHEN event_id % 2 = 0 THEN 'x-gzip' END AS encoding FROM events)
SELECT event_id, CASE
    WHEN ctype = 'application/pdf' THEN '.pdf'
    WHEN encoding = 'x-gzip' AND ctype = 'application/postscript' THEN '.ps.gz'
    WHEN encoding = 'x-gzip' AND ctype = 'application/x-eprint-tar' THEN '.tar.gz'
    WHEN ctype = 'application/x-eprint' THEN '.tex'
    WHEN encoding = 'x-gzip' AND ctype = 'application/x-dvi' THEN '.dvi.gz' END AS extension,
  CASE WHEN 'e' || event_id || coalesce(encoding, '.pdf') LIKE '%.pdf' THEN 'pdf' ELSE 'other' END AS kind
FROM headers""")
def content_kind(t):
    kind = F.col("event_type")
    headers = t.events.select(
        "event_id",
        F.when(kind == "view", "application/pdf").when(kind == "click", "application/postscript")
        .when(kind == "signup", "application/x-eprint-tar")
        .when(kind == "purchase", "application/x-eprint").otherwise("application/x-dvi").alias("ctype"),
        F.when(F.col("event_id") % 2 == 0, "x-gzip").alias("encoding"),
    )
    named = headers.withColumn(
        "member_name", F.concat(F.lit("e"), "event_id", F.coalesce("encoding", F.lit(".pdf")))
    )
    return filters.route_members(named).select(
        "event_id", paths.content_kind("ctype", "encoding").alias("extension"), "kind"
    )


@query("""
SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS strict_number,
       TRY_CAST(o_orderpriority AS BIGINT) AS lenient_number FROM orders""")
def typed_columns(t):
    return t.orders.select(
        "o_orderkey",
        fields.to_number(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("strict_number"),
        fields.to_number("o_orderpriority", strict=False).alias("lenient_number"),
    )


@query("""
SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props FROM events""")
def append_records(t):
    columns = ["event_id", "user_id", "props"]
    old = t.events.filter(F.col("event_type") != "view").select(*columns)
    new = t.events.filter(F.col("event_type") == "view").select("user_id", "event_id")
    return sets.append_records(old, new)


@query("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def upsert_latest(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    old, new = rows.filter(F.col("event_type") != "view"), rows.filter(F.col("event_type") == "view")
    return sets.upsert(old, new, "user_id", ["ts", "event_id"]).drop("ts")


@query("""
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders""")
def set_difference(t):
    return sets.difference(t.customer, t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("""
SELECT user_id FROM events WHERE user_id NOT IN (SELECT conv_id FROM conversations)""")
def difference_with_repeats(t):
    other = t.conversations.select(F.col("conv_id").alias("user_id"))
    return sets.difference(t.events, other, "user_id", distinct=False)


@query("""SELECT DISTINCT o_custkey FROM orders""")
def distinct_ids(t):
    return sets.distinct_ids(t.orders, "o_custkey")


@query("""
SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels UNION SELECT page_id FROM pages""")
def union_feeds(t):
    feeds = [t.documents.select(F.col("doc_id").alias("id")), t.labels.select(F.col("doc_id").alias("id")),
             t.pages.select(F.col("page_id").alias("id"))]
    return sets.union_feeds(*feeds, once=True)


@query("""
SELECT source, lang, n FROM (
  SELECT source, lang, count(*) AS n,
         row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS rn
  FROM documents GROUP BY source, lang) WHERE rn <= 2""")
def top_languages_per_source(t):
    counts = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    return topk.top_k_per_group(counts, ["source"], [F.desc("n"), F.asc("lang")], 2).drop("rank")


