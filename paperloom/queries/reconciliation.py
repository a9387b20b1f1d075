"""Semi, anti and outer reconciliation, header fill and first-of-group."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators import reconcile as R, topk, windows
from paperloom.queries.registry import Tables, query


def submissions(t: Tables):
    return t.documents.select(
        F.col("doc_id").cast("string").alias("submission_id"), F.col("source").alias("tarfile")
    )


def logged(t: Tables):
    return t.labels.select(F.col("doc_id").cast("string").alias("submission_id"))


def converted(t: Tables):
    return t.labels.filter(F.col("quality") == 1).select(
        F.col("doc_id").cast("string").alias("submission_id")
    )


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, source AS tarfile FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)""")
def member_semi(t):
    return R.known_members(submissions(t), logged(t), id_key="submission_id")


@query("""
SELECT CAST(page_id AS VARCHAR) AS submission_id FROM pages p
WHERE EXISTS (SELECT 1 FROM pages q WHERE contains(q.url, CAST(p.page_id AS VARCHAR)))""")
def member_semi_contains(t):
    members = t.pages.select(F.col("page_id").cast("string").alias("submission_id"))
    return R.contained_members(members, t.pages.withColumnRenamed("url", "filename_parsed"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT conv_id FROM conversations)""")
def pending_anti(t):
    logs = t.conversations.select(F.col("conv_id").cast("string").alias("submission_id"))
    return R.pending(submissions(t), "submission_id", logged(t), logs).select("submission_id")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unconverted(t):
    listed = submissions(t).select(
        F.concat(F.lit("latex/"), "tarfile", F.lit("/"), "submission_id", F.lit(".zip")).alias("path")
    )
    return R.unconverted(listed, converted(t), logged(t)).select("submission_id")


@query("""
SELECT id, CASE WHEN r = 0 THEN 'left' ELSE 'right' END AS side, CAST(l + r AS BIGINT) AS copies
FROM (SELECT id, sum(l) AS l, sum(r) AS r FROM (
        SELECT user_id AS id, 1 AS l, 0 AS r FROM events
        UNION ALL SELECT o_custkey, 0, 1 FROM orders) GROUP BY id)
WHERE l = 0 OR r = 0""")
def reconcile_sides(t):
    left = t.events.select(F.col("user_id").alias("id"))
    return R.reconcile(left, t.orders.select(F.col("o_custkey").alias("id")), "id")


@query("""
SELECT o_orderkey, o_custkey AS id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def missing_rows(t):
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("id"))
    return R.missing_rows(left, t.events.select(F.col("user_id").alias("id")), "id")


@query("""
SELECT DISTINCT o_custkey AS id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def missing_ids(t):
    left = t.orders.select(F.col("o_custkey").alias("id"))
    return R.missing_ids(left, t.events.select(F.col("user_id").alias("id")), "id")


@query("""
SELECT 'src/doc_' || d.doc_id || '.tar' AS path, m.mirror_id,
       CASE WHEN l.doc_id IS NOT NULL THEN 'local' WHEN m.mirror_id IS NOT NULL THEN 'mirror'
            ELSE 'origin' END AS tier
FROM documents d
LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id
LEFT JOIN (SELECT conv_id, max(turn) AS mirror_id FROM conversations GROUP BY conv_id) m
  ON d.doc_id = m.conv_id""")
def source_tier(t):
    def tar(folder, column):
        return F.concat(F.lit(f"{folder}doc_"), F.col(column), F.lit(".tar"))

    keys = t.documents.select(tar("src/", "doc_id").alias("path"))
    local = t.labels.filter(F.col("quality") == 1).select(tar("disk/", "doc_id").alias("path"))
    mirror = t.conversations.select(tar("", "conv_id").alias("title"), F.col("turn").alias("id"))
    return R.source_tier(keys, local, mirror)


@query("""
SELECT CAST(d.doc_id AS VARCHAR) AS submission_id,
       CASE WHEN l.quality = 1 THEN 'converted' WHEN l.doc_id IS NOT NULL THEN 'failed'
            ELSE 'pending' END AS outcome
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def outcome_status(t):
    return R.conversion_outcome(submissions(t), logged(t), converted(t))


@query("""
SELECT DISTINCT source AS tarfile FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)
  AND source IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)""")
def restart_archives(t):
    unpacked = t.documents.join(
        t.labels.filter(F.col("toxic") == 1), "doc_id", "left_semi"
    ).select(F.col("source").alias("tarfile")).distinct()
    return R.restart_archives(submissions(t), converted(t), unpacked)


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, source AS tarfile FROM documents
WHERE doc_id NOT IN (SELECT conv_id FROM conversations)""")
def empty_submissions(t):
    files = t.conversations.select(F.col("conv_id").cast("string").alias("submission_id"))
    return R.empty_submissions(submissions(t), files)


@query("""
SELECT p_partkey AS filename_parsed, p_name AS categories, split_part(p_name, ' ', 1) AS category
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def corpus_categories(t):
    records = t.part.select(F.col("p_partkey").alias("filename_parsed"), F.col("p_name").alias("categories"))
    corpus = t.lineitem.select(F.col("l_partkey").alias("doc_id"))
    return R.corpus_categories(records, corpus)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey AS doc_id, split_part(p_name, ' ', 1) AS category
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def attach_category(t):
    points = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("doc_id"))
    records = t.part.select(F.col("p_partkey").alias("filename_parsed"), F.col("p_name").alias("categories"))
    return R.attach_category(points, records)


@query("""
SELECT conv_id, role, turn, md5(text) AS digest FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY role, turn) AS rn FROM conversations)
WHERE rn = 1""")
def first_per_group(t):
    rows = t.conversations.select("conv_id", "role", "turn", F.md5("text").alias("digest"))
    return windows.first_per_group(rows, ["conv_id"], ["role", "turn"])


def source_files(t: Tables):
    """Conversations as submissions, turns as source files."""
    name = (
        F.when(F.col("role") == "system", "ms.tex").when(F.col("turn") % 5 == 2, "main.tex")
        .otherwise("body.tex")
    )
    marker = F.when(F.length("text") % 3 == 0, r"\documentclass{a} ").otherwise("")
    return t.conversations.select(
        F.col("conv_id").alias("submission_id"),
        F.concat(F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit("/"), name).alias("inner_path"),
        F.concat(marker, "text").alias("content"),
    )


SOURCE_FILES_SQL = r"""
  SELECT conv_id AS submission_id,
         lpad(CAST(turn AS VARCHAR), 4, '0') || '/' || CASE WHEN role = 'system' THEN 'ms.tex'
           WHEN turn % 5 = 2 THEN 'main.tex' ELSE 'body.tex' END AS path,
         length(text) % 3 = 0 OR contains(text, '\documentclass') OR contains(text, '\documentstyle')
           AS preamble
  FROM conversations"""

MAIN_SQL = f"""
  SELECT submission_id, n AS files,
         CASE WHEN n = 1 THEN path WHEN priority IS NULL THEN NULL ELSE path END AS main_path
  FROM (SELECT *, count(*) OVER (PARTITION BY submission_id) AS n,
               row_number() OVER (PARTITION BY submission_id
                                  ORDER BY priority NULLS LAST, path) AS rn
        FROM (SELECT *, CASE WHEN path LIKE '%/ms.tex' THEN 0 WHEN path LIKE '%/main.tex' THEN 1
                             WHEN preamble THEN 2 END AS priority FROM ({SOURCE_FILES_SQL})))
  WHERE rn = 1"""


@query(MAIN_SQL)
def main_file(t):
    return topk.main_files(source_files(t))


@query(f"""
WITH main AS ({MAIN_SQL}),
status AS (
  SELECT d.doc_id AS submission_id, coalesce(files, 0) AS files,
         CASE WHEN files IS NULL THEN 'empty' WHEN main_path IS NULL THEN 'corrupt'
              ELSE 'preprint' END AS status
  FROM documents d LEFT JOIN main m ON d.doc_id = m.submission_id)
SELECT CAST(sum(files) AS BIGINT) AS tex_files, count(*) AS submissions,
       count(*) FILTER (WHERE status = 'preprint') AS preprints,
       count(*) FILTER (WHERE status = 'empty') AS empty,
       count(*) FILTER (WHERE status = 'corrupt') AS corrupt FROM status""")
def submission_counters(t):
    all_ = t.documents.select(F.col("doc_id").alias("submission_id"))
    return topk.submission_counters(topk.submission_status(topk.main_files(source_files(t)), all_))


@query("""
SELECT conv_id, turn, md5(last_value(CASE WHEN role <> 'assistant' THEN text END IGNORE NULLS) OVER (
         PARTITION BY conv_id % 4 ORDER BY conv_id, turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS header
FROM conversations""")
def header_fill(t):
    lines = t.conversations.select(
        "conv_id", "turn", (F.col("conv_id") % 4).alias("file"),
        (F.col("conv_id") * 100000 + F.col("turn")).alias("line"),
        F.when(F.col("role") != "assistant", F.md5("text")).alias("mark"),
    )
    filled = windows.fill_forward(
        lines, ["file"], F.floor(F.col("line") / 2_000_000), "line", "mark", "header"
    )
    return filled.select("conv_id", "turn", "header")
