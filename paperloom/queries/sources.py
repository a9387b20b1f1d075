"""Scans and sinks.

The formats the scans read are not among the given tables, so each query first
lets Spark write its table in that format (or build it as a column) and then
reads it back through the public reader.
"""

from __future__ import annotations

import gzip
import io
import tarfile

import pandas as pd
from pyspark.sql import functions as F

from paperloom.memory import released
from paperloom.operators.aggregates import harvest_progress
from paperloom.queries.markup import escaped
from paperloom.queries.reconciliation import logged
from paperloom.queries.registry import Tables, query
from paperloom.session import scratch_path, staged
from paperloom.sources import archives as A, files, ranges, sinks, submission_files, tables, xml_records as X


def record_xml(t: Tables):
    """Documents as harvest records; every third lacks a doi, every fifth its authors."""
    n = F.col("doc_id")
    number = n.cast("string")
    authors = F.when(n % 5 == 0, "<authors></authors>").otherwise(F.concat(
        F.lit("<authors><author><keyname> Doe </keyname><forenames>J.</forenames></author><author><keyname>Only"
              "</keyname></author><author><keyname>"), F.col("source"),
        F.lit("</keyname><forenames></forenames></author></authors>"),
    ))
    doi = F.when(n % 3 == 0, "").otherwise(F.concat(F.lit("<doi>10.1/"), number, F.lit("</doi>")))
    xml = F.concat(
        F.lit("<record><header><identifier>oai:"), number, F.lit("</identifier><datestamp>2018-01-02</datestamp>"
              "<setSpec>physics:"), F.col("lang"), F.lit("</setSpec></header><metadata><paper><id>"),
        F.col("source"), F.lit("/"), number, F.lit("</id><created>2017-05-06</created><updated>2017-06-01</updated>"
              "<updated>2017-07-01</updated>"), authors, F.lit("<title> T"), number,
        F.lit("</title><categories>"), F.col("lang"), F.lit(" x.Y</categories><comments>c</comments>"), doi,
        F.lit("<abstract>"), escaped("text"), F.lit("</abstract></paper></metadata></record>"),
    )
    return t.documents.select("doc_id", xml.alias("xml"))


RECORDS_SQL = """
  SELECT 'oai:' || doc_id AS identifier, source || '/' || doc_id AS filename, 'physics:' || lang AS spec,
         ' T' || doc_id AS title, '2018-01-02' AS datestamp, '2017-05-06' AS created, '2017-06-01' AS updated,
         CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'J. Doe,  ' || source END AS authors,
         lang || ' x.Y' AS categories, CAST(NULL AS VARCHAR) AS journal,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '10.1/' || doc_id END AS doi,
         md5(text) AS abstract, 'c' AS comments, source || doc_id AS filename_parsed FROM documents"""


@query(RECORDS_SQL)
def harvest_records(t):
    structs = record_xml(t).select(X.harvest_struct(F.col("xml")).alias("r")).select("r.*")
    records = X.stamp_records(X.project_records(structs), F.lit(None).cast("timestamp"))
    return records.withColumn("abstract", F.md5("abstract")).drop("date_retrieved")


def landed_pages(t: Tables):
    """Harvest pages as XML files, one record to a page."""
    path = scratch_path(t.spark, "pages")
    total = t.documents.agg(F.count("*")).scalar()
    marker = F.struct(
        F.when(F.col("doc_id") % 7 == 0, "").otherwise("next").alias("_VALUE"),
        F.col("doc_id").alias("_cursor"), F.col("total").alias("_completeListSize"),
    )
    parsed = record_xml(t).select("doc_id", X.harvest_struct(F.col("xml")).alias("record"))
    pages = parsed.withColumn("total", total).select(
        F.lit("2018-02-03T00:00:00Z").alias("responseDate"),
        F.struct("record", marker.alias("resumptionToken")).alias("ListRecords"),
    )
    writer = pages.write.format("xml").option("rootTag", "pages").option("rowTag", "OAI-PMH")
    writer.save(path)
    return path


@query(RECORDS_SQL)
def harvest_pages(t):
    records = X.read_records(t.spark, landed_pages(t))
    return records.withColumn("abstract", F.md5("abstract")).drop("date_retrieved")


@query("""
SELECT count(*) AS obtained, count(*) AS announced, true AS complete,
       (SELECT count(*) FROM documents WHERE doc_id % 7 <> 0) AS continued FROM documents""")
def harvest_completeness(t):
    path = landed_pages(t)
    marks = X.read_harvest_tokens(t.spark, path)
    progress = harvest_progress(X.read_records(t.spark, path), marks)
    return progress.withColumn("continued", marks.agg(F.count("token")).scalar())


@query("SELECT '2018-02-03T00:00:00Z' AS response_date, count(*) AS pages FROM documents")
def response_dates(t):
    dates = X.read_response_dates(t.spark, landed_pages(t))
    return dates.groupBy("response_date").agg(F.count("*").alias("pages"))


@query("SELECT source AS \"setSpec\", count(*) AS n FROM documents GROUP BY source")
def set_listing(t):
    path = scratch_path(t.spark, "sets")
    listed = t.documents.select(F.col("source").alias("setSpec"), F.lit("n").alias("setName"))
    listed.write.format("xml").option("rootTag", "ListSets").option("rowTag", "set").save(path)
    return X.read_sets(t.spark, path).groupBy("setSpec").agg(F.count("*").alias("n"))


@query("""
SELECT 'http://x/' || doc_id AS id, 'u' AS updated, 'p' AS published, 'T' AS title, md5(text) AS summary,
       'A B, ' || source AS authors, CASE WHEN doc_id % 2 = 0 THEN '10.1/' || doc_id END AS doi,
       CASE WHEN doc_id % 2 = 0 THEN 'http://doi/' || doc_id END AS doi_link, CAST(NULL AS VARCHAR) AS journal,
       'http://pdf/' || doc_id AS pdf_link, lang AS category, CAST(NULL AS VARCHAR) AS comment FROM documents""")
def feed_entries(t):
    number = F.col("doc_id").cast("string")
    even = F.col("doc_id") % 2 == 0
    xml = F.concat(
        F.lit("<entry><id>http://x/"), number, F.lit("</id><updated>u</updated><published>p</published><title>T"
              "</title><summary>"), escaped("text"), F.lit("</summary><author><name>A B</name></author><author>"
              "<name>"), F.col("source"), F.lit('</name></author><link href="http://old" title="pdf"/>'
              '<link href="http://page" rel="alternate"/><link title="pdf" href="http://pdf/'), number, F.lit('"/>'),
        F.when(even, F.concat(F.lit('<link title="doi" href="http://doi/'), number, F.lit('"/><ext:doi>10.1/'),
                              number, F.lit("</ext:doi>"))).otherwise(""),
        F.lit('<ext:primary_category term="'), F.col("lang"), F.lit('"/></entry>'),
    )
    structs = t.documents.select(X.feed_struct(xml).alias("e")).select("e.*")
    return X.project_feed(structs).withColumn("summary", F.md5("summary"))


@query("""
SELECT o_orderkey || '.tar' AS filename, CAST(round(o_totalprice * 100) AS BIGINT) AS size,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS uploaded, strftime(o_orderdate, '%y%m') AS yymm,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'm' || o_orderkey END AS md5sum, '2018-06-09' AS edited
FROM orders""")
def manifest_file(t):
    path = scratch_path(t.spark, "manifest")
    number = F.col("o_orderkey").cast("string")
    files_ = t.orders.select(
        F.concat(number, F.lit(".tar")).alias("filename"),
        F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("m"), number)).alias("md5sum"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.date_format("o_orderdate", "yyMM").alias("yymm"),
    )
    files_.write.format("xml").option("rootTag", "files").option("rowTag", "file").save(f"{path}/files")
    head = t.orders.agg(F.lit("<manifest><timestamp>2018-06-09</timestamp></manifest>").alias("value"))
    head.write.text(f"{path}/head")
    edited = X.read_manifest_header(t.spark, f"{path}/head").agg(F.max("timestamp")).scalar()
    manifest = X.typed_manifest(X.read_manifest(t.spark, f"{path}/files"))
    return manifest.select(
        "filename", "size", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("uploaded"), "yymm",
        "md5sum", edited.alias("edited"),
    )


@query("""
SELECT source || doc_id AS filename_parsed, md5(text) AS abstract, '0001' AS filename,
       CAST(NULL AS VARCHAR) AS doi FROM documents""")
def records_csv(t):
    """Abstracts with newlines and quotes survive the round trip."""
    path = scratch_path(t.spark, "csv")
    records = t.documents.select(
        F.lit("0001").alias("filename"), F.col("text").alias("abstract"),
        F.lit("2018-01-02 03:04:05").cast("timestamp").alias("date_retrieved"),
        F.concat("source", F.col("doc_id").cast("string")).alias("filename_parsed"),
    )
    even = F.col("filename_parsed").endswith("0")
    sinks.write_records(records.filter(even), path, "csv")
    other = records.filter(~even).select("filename_parsed", "date_retrieved", "abstract", "filename")  # another column order
    other.write.mode("append").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").options(**tables.CSV_OPTIONS).csv(path)
    back = tables.read_records_csv(t.spark, path)
    return back.select("filename_parsed", F.md5("abstract").alias("abstract"), "filename", "doi")


@query("SELECT source || doc_id AS filename_parsed FROM documents")
def identifier_scan(t):
    path = scratch_path(t.spark, "ids")
    named = F.concat("source", F.col("doc_id").cast("string"))
    t.documents.select(named.alias("filename_parsed"), "text").write.parquet(path)
    return tables.read_identifiers(t.spark, path, "parquet")


@query("""
SELECT CAST(p_size AS INTEGER) AS length, CAST(p_partkey AS VARCHAR) AS submission_id, p_type AS main,
       p_name AS categories FROM part""")
def subject_scan(t):
    path = scratch_path(t.spark, "subjects")
    t.part.select("p_size", "p_partkey", "p_type", "p_name").write.option("header", True).csv(path)
    return tables.read_subjects(t.spark, path)


@query("""
SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings""")
def layout_scan(t):
    path = scratch_path(t.spark, "layout")
    xy = t.embeddings.select(
        F.col("embedding")[0].cast("double").alias("500"), F.col("embedding")[1].cast("double").alias("2")
    )
    xy.write.option("sep", " ").option("header", True).csv(path)
    return tables.read_layout(t.spark, path)


@query("SELECT DISTINCT p_name AS word FROM part")
def word_list_scan(t):
    path = scratch_path(t.spark, "words")
    lists = t.part.groupBy("p_brand").agg(F.to_json(F.collect_list("p_name")).alias("value"))
    lists.repartition("p_brand").write.partitionBy("p_brand").text(path)  # one array per file
    return tables.read_word_list(t.spark, path)


@query("SELECT md5(replace(text, chr(10), ' ')) AS digest, count(*) AS n FROM documents GROUP BY 1")
def line_corpus(t):
    path = scratch_path(t.spark, "lines")
    t.documents.select(F.replace("text", F.lit("\n"), F.lit(" "))).write.text(path)
    lines = files.read_line_corpus(t.spark, path)
    return lines.groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("n"))


@query("""
SELECT source AS tarfile, CAST(doc_id AS VARCHAR) || s AS submission_id
FROM documents, (VALUES ('a'), ('b')) v(s)""")
def submission_log(t):
    path = scratch_path(t.spark, "log")
    number = F.col("doc_id").cast("string")
    lines = F.concat(
        F.lit("TARFILE: "), "source", F.lit(".tar\n"), number, F.lit("a\n\n"), number, F.lit("b")
    )
    t.documents.select(lines.alias("value")).write.text(path)
    return files.read_submission_log(t.spark, path)


@query("SELECT o_orderkey AS doc, o_custkey AS term_id, CAST(1 AS BIGINT) AS cnt FROM orders")
def matrix_market(t):
    path = scratch_path(t.spark, "mm")
    counts = t.orders.select(F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("term_id"), F.lit(1).alias("cnt"))
    top = counts.agg(F.max("doc").alias("doc"), F.max("term_id").alias("term_id")).first()
    sinks.write_matrix_market(counts, path, top.doc + 1, top.term_id + 1)
    return tables.read_matrix_market(t.spark, f"{path}/body", sized=False)


@query("""
SELECT '%%MatrixMarket matrix coordinate real general' AS line UNION ALL
SELECT (max(o_orderkey) + 1) || ' ' || (max(o_custkey) + 1) || ' ' || count(*) FROM orders""")
def matrix_market_header(t):
    path = scratch_path(t.spark, "mm")
    counts = t.orders.select(F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("term_id"), F.lit(1).alias("cnt"))
    top = counts.agg(F.max("doc").alias("doc"), F.max("term_id").alias("term_id")).first()
    sinks.write_matrix_market(counts, path, top.doc + 1, top.term_id + 1)
    return t.spark.read.text(f"{path}/header").select(F.col("value").alias("line"))


def _pack(frames):
    """Batches of documents -> one tar per batch: a pdf, plain gz and tar.gz members."""
    for frame in frames:
        outer = io.BytesIO()
        with tarfile.open(fileobj=outer, mode="w") as tar:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                body = text.encode()
                if doc_id % 4 == 0:
                    name, data = f"d/{doc_id}.pdf", b"%PDF"
                elif doc_id % 4 == 1:
                    name, data = f"d/{doc_id}.gz", gzip.compress(body)
                else:
                    inner = io.BytesIO()
                    with tarfile.open(fileobj=inner, mode="w:gz") as pack:
                        folder = tarfile.TarInfo("figs")
                        folder.type = tarfile.DIRTYPE
                        pack.addfile(folder)
                        for part, content in (("ms.tex", body), ("figs/a.eps", b"eps")):
                            info = tarfile.TarInfo(part)
                            info.size = len(content)
                            pack.addfile(info, io.BytesIO(content))
                    name, data = f"d/{doc_id}.gz", inner.getvalue()
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        yield pd.DataFrame({"path": [f"src/{frame['doc_id'].iloc[0]}.tar"], "content": [outer.getvalue()]})


def packed(t: Tables, condition="true"):
    return t.documents.where(condition).select("doc_id", "text").mapInPandas(released(_pack), "path string, content binary")


def land(archives, root: str, group: str) -> None:
    """Put archives (path, content) into a landing folder as files `root/<group>/...`, over files of the same names."""
    archives.sparkSession.dataSource.register(submission_files.SubmissionFiles)
    name = F.concat(F.lit(f"{group}-"), F.regexp_extract("path", "([0-9]+)[.]tar$", 1))
    archives.select(F.lit(group).alias("archive"), F.lit("tars").alias("submission_id"), F.concat(name, F.lit(".tar")).alias("inner_path"),
                    "content").write.format(submission_files.FORMAT).mode("append").save(root)


ARCHIVE_FILES_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS submission_id, CASE WHEN doc_id % 4 = 1 THEN doc_id || '.tex' ELSE path END
         AS inner_path,
       CASE WHEN doc_id % 4 <> 1 AND path = 'figs/a.eps' THEN md5('eps') ELSE md5(text) END AS digest
FROM documents, (VALUES ('ms.tex'), ('figs/a.eps')) v(path)
WHERE doc_id % 4 <> 0 AND NOT (doc_id % 4 = 1 AND path = 'figs/a.eps')"""


def label_ids(t: Tables):
    return logged(t).withColumnRenamed("submission_id", "filename_parsed")


@query(f"{ARCHIVE_FILES_SQL} AND doc_id IN (SELECT doc_id FROM labels)")
def archive_files(t):
    inner = A.explode_archives(packed(t), label_ids(t))
    return inner.select("submission_id", "inner_path", F.md5("content").alias("digest"))


@query(f"{ARCHIVE_FILES_SQL} AND doc_id IN (SELECT doc_id FROM labels)")
def split_archives(t):
    """Archives as files, each read by several tasks through an index of its members."""
    root = scratch_path(t.spark, "landing")
    land(packed(t), root, "all")
    inner = ranges.explode_split_archives(t.spark, root, label_ids(t), split_bytes=1 << 18)
    return inner.select("submission_id", "inner_path", F.md5("content").alias("digest"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, CASE WHEN doc_id % 4 = 1 THEN doc_id || '.tex' ELSE 'ms.tex' END AS inner_path,
       md5(text) AS digest FROM documents WHERE doc_id % 4 <> 0""")
def submission_tree_files(t):
    """Extracted sources written one file each and found again in the tree."""
    root = scratch_path(t.spark, "submissions")
    submission_files.write_submission_files(A.tex_files(A.inner_files(A.spread_members(A.tar_members(packed(t))))), root)
    tree = files.read_submission_tree(t.spark, root)
    return tree.select("submission_id", "inner_path", F.md5("content").alias("digest"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, CASE WHEN doc_id % 4 = 0 THEN 'pdf' ELSE 'gz' END AS kind
FROM documents""")
def archive_members(t):
    return A.tar_members(packed(t), with_content=False).select("submission_id", "kind")


@query("""
SELECT CAST(count(*) FILTER (WHERE doc_id % 4 <> 0) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE doc_id % 4 <> 0) AS BIGINT) AS extracted,
       count(*) FILTER (WHERE doc_id % 4 = 0) AS pdf_only FROM documents""")
def extraction_counters(t):
    members = staged(A.tar_members(packed(t)), "members")  # sliced once, read three times
    counters = A.extraction_counters(members, A.tex_files(A.inner_files(members)))
    pdfs = A.pdf_only(members).agg(F.count("*")).scalar()
    return counters.agg(F.sum("matched").alias("matched"), F.sum("extracted").alias("extracted")).withColumn(
        "pdf_only", pdfs
    )


@query("""
SELECT doc_id, CAST(count(*) AS BIGINT) AS files FROM documents, (VALUES (1), (2)) v(i)
WHERE doc_id % 4 <> 0 AND NOT (doc_id % 4 = 1 AND i = 2) GROUP BY doc_id""")
def archive_table_function(t):
    A.register_archive_function(t.spark)
    A.tar_members(packed(t), (".gz",)).createOrReplaceTempView("paperloom_members")
    return t.spark.sql("""
        SELECT CAST(submission_id AS BIGINT) AS doc_id, count(*) AS files
        FROM paperloom_members, LATERAL explode_archive(member_name, content) GROUP BY submission_id""")


@query("""
SELECT doc_id, 'x' AS note FROM documents
UNION ALL SELECT doc_id, 'y' FROM labels""")
def snapshot_table(t):
    """A table rewritten from its own current version."""
    root = scratch_path(t.spark, "snapshots")
    sinks.write_snapshot(t.documents.select("doc_id", F.lit("x").alias("note")), root)
    new = t.labels.select("doc_id", F.lit("y").alias("note"))
    sinks.update_snapshot(t.spark, root, lambda old: old.unionByName(new))
    return sinks.read_snapshot(t.spark, root)


@query("""
SELECT doc_id, 'documents' AS note, CAST(2 AS BIGINT) AS version FROM documents
UNION ALL SELECT doc_id, 'labels', 2 FROM labels""")
def two_writers(t):
    """Two writers start from the same version; the slower one makes its table again, and both are in it."""
    root = scratch_path(t.spark, "snapshots")
    slow, fast = ((frame.select("doc_id", F.lit(name).alias("note"))) for name, frame in (("documents", t.documents), ("labels", t.labels)))
    grown = lambda old, new: new if old is None else old.unionByName(new)

    def make(old):
        if old is None:  # meanwhile the other one publishes
            sinks.update_snapshot(t.spark, root, lambda now: grown(now, fast))
        return grown(old, slow)

    version = sinks.update_snapshot(t.spark, root, make)
    return sinks.read_snapshot(t.spark, root).withColumn("version", F.lit(version).cast("long"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, CASE WHEN doc_id % 2 = 0 THEN 'even.tar' ELSE 'odd.tar' END AS tarfile
FROM documents WHERE doc_id % 4 <> 0""")
def written_submission_log(t):
    path = scratch_path(t.spark, "sublog")
    for name, condition in (("even", "doc_id % 2 = 0"), ("odd", "doc_id % 2 = 1")):
        archives = packed(t, condition).withColumn("path", F.lit(f"src/{name}.tar"))
        sinks.write_submission_log(A.tar_members(archives, with_content=False), path)
    return t.spark.read.parquet(path).select("submission_id", "tarfile")


