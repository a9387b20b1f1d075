"""Listings, trees, stored tables, failure reports and flows that read back what they wrote."""

from __future__ import annotations

import gzip
import io
import tarfile

import pandas as pd
from pyspark.sql import functions as F

from paperloom.functions import fields, text as T
from paperloom.functions.markup import register_markup_function
from paperloom.operators import filters, lemmas as L, topk
from paperloom.operators.word_codes import word_counts
from paperloom.plans.parse import parse_corpus
from paperloom.queries.markup import PAPER_TEXT_SQL, papers
from paperloom.queries.reconciliation import logged
from paperloom.queries.registry import Tables, query
from paperloom.queries.sources import RECORDS_SQL, packed, record_xml
from paperloom.queries.terms import stored_tokens
from paperloom.queries.texts import TOKENS_SQL, digest, token_table
from paperloom.session import scratch_path, staged, staged_by
from paperloom.sources import archives as A, files, sinks, submission_files, tables, xml_records as X

# The folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@query("SELECT DISTINCT p_brand AS brand FROM part")
def object_listing(t):
    """Objects below a prefix, by path alone."""
    path = scratch_path(t.spark, "objects")
    t.part.select("p_brand", "p_name").write.partitionBy("p_brand").text(path)
    listed = files.list_objects(t.spark, path, ".txt")
    return listed.select(F.url_decode(F.regexp_extract("path", "/p_brand=([^/]*)/", 1)).alias("brand")).distinct()


@query("SELECT event_id FROM events WHERE event_id % 3 = 0")
def tar_listing(t):
    name = F.concat(F.lit("e"), "event_id", F.when(F.col("event_id") % 3 == 0, ".tar").otherwise(".gz"))
    return filters.tar_objects(t.events.select("event_id", name.alias("path"))).select("event_id")


@query("SELECT md5(string_agg(CAST(c_custkey AS VARCHAR), chr(10) ORDER BY c_custkey) || chr(10)) AS digest "
       "FROM customer GROUP BY c_nationkey")
def whole_files(t):
    """One file of sorted lines per nation, read back as one text each."""
    path = scratch_path(t.spark, "texts")
    rows = t.customer.select("c_nationkey", F.col("c_custkey").alias("k"))
    lines = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "k").select("c_nationkey", F.col("k").cast("string"))
    lines.write.partitionBy("c_nationkey").text(path)
    return files.read_documents(t.spark, path).select(F.md5("text").alias("digest"))


def _supplier_files(t, suffix, content):
    """One file for each supplier, below one folder."""
    path = scratch_path(t.spark, "files")
    t.spark.dataSource.register(submission_files.SubmissionFiles)
    number = F.col("s_suppkey").cast("string")
    t.supplier.select(F.lit("suppliers").alias("archive"), F.lit("all").alias("submission_id"), F.concat(number, F.lit(suffix)).alias("inner_path"),
                      F.encode(content, "utf-8").alias("content")).write.format(submission_files.FORMAT).mode("append").save(path)
    return path


@query("SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, '<one><name>' || s_name || '</name></one>' AS xml FROM supplier")
def markup_files(t):
    path = _supplier_files(t, ".xml", F.concat(F.lit("<one><name>"), "s_name", F.lit("</name></one>")))
    return files.read_markup(t.spark, path)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS submission_id FROM supplier")
def written_outputs(t):
    return files.output_inventory(t.spark, _supplier_files(t, ".zip", F.col("s_name")), ".zip")


@query("SELECT 'n=' || s_nationkey AS archive, 's=' || s_suppkey AS submission_id, md5(s_name || chr(10)) AS digest FROM supplier")
def submission_tree(t):
    path = scratch_path(t.spark, "tree")
    folder = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)))
    lines = t.supplier.groupBy(folder("n", "s_nationkey").alias("archive"), folder("s", "s_suppkey").alias("submission_id")).agg(
        F.array_join(F.collect_list(F.coalesce("s_name", F.lit(""))), "\n").alias("lines"))
    # a number of its own, as rows this short would all be merged into one task; tasks commit their files themselves
    dealt = lines.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "archive", "submission_id")
    t.spark.dataSource.register(submission_files.SubmissionFiles)
    dealt.select("archive", "submission_id", F.lit("lines.txt").alias("inner_path"), F.concat("lines", F.lit("\n")).cast("binary").alias(
        "content")).write.format(submission_files.FORMAT).mode("append").save(path)
    tree = files.read_submission_tree(t.spark, path, ".txt")
    return tree.select("archive", "submission_id", F.md5("content").alias("digest"))


@query(f"SELECT doc_id, tokens FROM ({TOKENS_SQL}) WHERE doc_id = 7")
def token_document(t):
    path = scratch_path(t.spark, "tokens")
    sinks.write_tokens(token_table(t), path)
    return tables.read_token_document(t.spark, path, 7).select("doc_id", "tokens")


@query(f"SELECT identifier, '2018-06-09 01:02:03' AS retrieved FROM ({RECORDS_SQL})")
def stamped_records(t):
    structs = record_xml(t).select(X.harvest_struct(F.col("xml")).alias("r")).select("r.*")
    records = X.stamp_records(X.project_records(structs), F.lit("2018-06-09 01:02:03").cast("timestamp"))
    return records.select("identifier", F.date_format("date_retrieved", "yyyy-MM-dd HH:mm:ss").alias("retrieved"))


@query("SELECT c_custkey, c_nationkey FROM customer ORDER BY c_nationkey, c_custkey LIMIT 25")
def first_of_listing(t):
    return topk.first_rows(t.customer.select("c_custkey", "c_nationkey").orderBy("c_nationkey", "c_custkey"), 25)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS utc FROM orders")
def utc_times(t):
    shown = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return t.orders.select("o_orderkey", F.date_format(fields.as_utc(shown), "yyyy-MM-dd'T'HH:mm:ss").alias("utc"))


@query(f"SELECT doc_id, md5(body) AS digest FROM ({PAPER_TEXT_SQL})")
def markup_function(t):
    register_markup_function(t.spark)
    papers(t).createOrReplaceTempView("paperloom_papers")
    return t.spark.sql("SELECT doc_id, md5(markup_text(xml)) AS digest FROM paperloom_papers")


@query("SELECT CAST(doc_id AS VARCHAR) AS submission_id FROM documents WHERE doc_id % 4 <> 0 AND CAST(doc_id AS VARCHAR) LIKE '%1%'")
def archives_by_name_part(t):
    return A.explode_archives(packed(t), name_part="1").select("submission_id").distinct()


def _tar(entries, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, data in entries:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def _nested(frames):
    """Each document as a tar in a tar.gz in an archive of its own."""
    for frame in frames:
        rows = [(f"src/{i}.tar", _tar([(f"{i}.gz", _tar([("in.tar", _tar([("a.tex", x.encode())]))], "w:gz"))]))
                for i, x in zip(frame["doc_id"], frame["text"])]
        yield pd.DataFrame(rows, columns=["path", "content"])


@query("SELECT doc_id || '.tar' AS tar_name, 'in.tar/a.tex' AS inner_path, md5(text) AS digest FROM documents")
def nested_archives(t):
    source = t.documents.select("doc_id", "text").mapInPandas(_nested, "path string, content binary")
    inner = A.explode_archives(source, recursive=True)
    return inner.select("tar_name", "inner_path", F.md5("content").alias("digest"))


def _faulty(frames):
    """By document number: no tar at all, a tar that breaks off, an empty file, a member that is no gzip, a good one."""
    for frame in frames:
        rows = []
        for i, x in zip(frame["doc_id"], frame["text"]):
            good = _tar([(f"{i}.gz", gzip.compress(x.encode()))])
            broken = _tar([("z.gz", b"0" * 4000)])[:1500]
            kinds = (b"junk", broken, b"", _tar([(f"{i}.gz", b"junk")]), good)
            rows.append((f"src/{i}.tar", kinds[i % 5]))
        yield pd.DataFrame(rows, columns=["path", "content"])


FAILURES_SQL = """
SELECT doc_id || '.tar' AS tar_name, CASE WHEN doc_id % 5 IN (0, 2) THEN 'not_tar' ELSE 'error' END AS kind
FROM documents WHERE doc_id % 5 IN (0, 2) OR doc_id % 5 IN (1, 3) AND doc_id IN (SELECT doc_id FROM labels)
   OR doc_id % 5 = 1"""


@query(FAILURES_SQL)
def archive_failures(t):
    """Junk, truncated and empty archives and bad members stay visible, and are logged."""
    ids = logged(t).withColumnRenamed("submission_id", "filename_parsed")
    source = t.documents.select("doc_id", "text").mapInPandas(_faulty, "path string, content binary")
    inner = A.explode_archives(source, ids)
    log = scratch_path(t.spark, "failures")
    sinks.append_failures(inner.filter(F.col("kind").isin(*A.FAILURE_KINDS)).select("tar_name", "kind", "error"), log)
    return t.spark.read.parquet(log).select("tar_name", "kind").distinct()


@query("""
SELECT CAST(doc_id AS VARCHAR) AS submission_id,
       CASE WHEN doc_id % 4 = 1 THEN doc_id || '.tex' ELSE 'figs/a.eps ms.tex' END AS paths,
       CASE WHEN doc_id % 4 = 1 THEN md5(text) ELSE md5('eps') || md5(text) END AS digests
FROM documents WHERE doc_id % 4 <> 0""")
def regrouped_submissions(t):
    stored = scratch_path(t.spark, "files")
    A.explode_archives(packed(t)).write.parquet(stored)
    grouped = sinks.regroup_submissions(t.spark.read.parquet(stored))
    return grouped.select(
        "submission_id", F.array_join(F.transform("files", lambda f: f["inner_path"]), " ").alias("paths"),
        F.array_join(F.transform("files", lambda f: F.md5(f["content"])), "").alias("digests"))


@query(f"""
SELECT doc_id, 'tokens' AS state, CAST(len(tokens) AS BIGINT) AS words FROM (
  SELECT doc_id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+') AS tokens FROM ({PAPER_TEXT_SQL}))
WHERE doc_id % 7 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'failed', NULL FROM documents WHERE doc_id % 7 = 0 AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def parse_flow(t):
    """Documents already done are skipped, unreadable ones land in the failure table."""
    out, failures = scratch_path(t.spark, "parsed"), scratch_path(t.spark, "failures")
    raw = papers(t).withColumn("xml", F.when(F.col("doc_id") % 7 == 0, F.concat("xml", F.lit("<broken"))).otherwise(F.col("xml")))
    parse_corpus(raw, out, failures, t.labels.select("doc_id"))
    done = t.spark.read.parquet(out).select("doc_id", F.lit("tokens").alias("state"), F.size("tokens").cast("long").alias("words"))
    failed = t.spark.read.parquet(failures).select("doc_id", F.lit("failed").alias("state"), F.lit(None).cast("long").alias("words"))
    return done.unionByName(failed)


STOP = ("the", "la", "de", "und", "et", "of")
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
_ASCII = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
NORMALISED_SQL = f"""
WITH kept AS (SELECT doc_id, array_to_string([w FOR w IN string_split_regex(lower(text), '{_SPACE}')
                 IF w <> '' AND w NOT IN ({_STOP_SQL})], ' ') AS line FROM documents),
plain AS (SELECT doc_id, [w FOR w IN string_split_regex(translate(line, '{_ASCII}', ''), '{_SPACE}') IF w <> ''] AS tokens FROM kept),
words AS (SELECT DISTINCT unnest(tokens) AS word FROM plain),
forms AS (
  SELECT word, word AS lemma, 0 AS at_ FROM words
  UNION ALL SELECT word, left(word, length(word) - 1), 1 FROM words WHERE ends_with(word, 's')
  UNION ALL SELECT word, left(word, length(word) - 3) || 's', 2 FROM words WHERE ends_with(word, 'ses')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'f', 3 FROM words WHERE ends_with(word, 'ves')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'x', 4 FROM words WHERE ends_with(word, 'xes')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'z', 5 FROM words WHERE ends_with(word, 'zes')
  UNION ALL SELECT word, left(word, length(word) - 4) || 'ch', 6 FROM words WHERE ends_with(word, 'ches')
  UNION ALL SELECT word, left(word, length(word) - 4) || 'sh', 7 FROM words WHERE ends_with(word, 'shes')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'man', 8 FROM words WHERE ends_with(word, 'men')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'y', 9 FROM words WHERE ends_with(word, 'ies')),
best AS (SELECT word, lemma FROM (
    SELECT word, lemma, row_number() OVER (PARTITION BY word ORDER BY length(lemma), at_) AS rn
    FROM forms WHERE lemma IN (SELECT word FROM words)) WHERE rn = 1 AND lemma <> word),
each AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM plain)
SELECT doc_id, count(*) AS words, md5(string_agg(coalesce(lemma, token), chr(1) ORDER BY pos)) AS digest
FROM each LEFT JOIN best ON token = word GROUP BY doc_id"""


@query(NORMALISED_SQL)
def normalised_words(t):
    """Stop list, punctuation, lemma, split; the corpus's own words serve as the lexicon."""
    tokens = staged_by(t.documents.select("doc_id", T.stop_free_words("text", STOP).alias("tokens")), "doc_id", "tokens")
    words = staged(word_counts(tokens).select(F.col("token").alias("word")), "words")
    lemmas = staged(L.lemma_table(words, words), "lemmas")
    found = L.lemmatise(tokens, lemmas)
    return found.filter(F.size("tokens") > 0).select("doc_id", *digest(F.col("tokens")))


@query(f"SELECT doc_id, count(*) AS words FROM (SELECT doc_id, unnest(tokens) AS w FROM ({TOKENS_SQL})) "
       "WHERE w NOT IN (SELECT DISTINCT lower(p_name) FROM part) AND length(w) > 2 GROUP BY doc_id")
def words_of_no_list(t):
    """A stop list as a table: the short words of the corpus and the names of parts."""
    tokens = stored_tokens(t)
    short = tokens.select(F.explode("tokens").alias("word")).filter(F.length("word") <= 2)
    listed = staged(short.unionByName(t.part.select(F.lower("p_name").alias("word"))).distinct(), "stop")
    kept = filters.without_words(tokens, listed)
    return kept.filter(F.size("tokens") > 0).select("doc_id", F.size("tokens").cast("long").alias("words"))


def _integers(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), F.transform(
        "embedding", lambda x: F.round(x.cast("double") * 1000).cast("long")).alias("vector"))


@query("""
SELECT count(*) || chr(9) || max(len(embedding)) AS line, 'header' AS part FROM embeddings UNION ALL
SELECT array_to_string([CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT) FOR x IN embedding], chr(9)), 'body' FROM embeddings""")
def vector_export(t):
    """The whole export, header and body, as it stands in the files."""
    path = scratch_path(t.spark, "export")
    sinks.write_vectors_tsv(_integers(t), path)
    read = [t.spark.read.text(f"{path}/{part}").select(F.col("value").alias("line"), F.lit(part).alias("part")) for part in ("header", "body")]
    return read[0].unionByName(read[1])
