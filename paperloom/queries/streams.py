"""Incremental flows run to the end of what has landed."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from paperloom.queries.registry import query
from paperloom.queries.sources import ARCHIVE_FILES_SQL, RECORDS_SQL, label_ids, land, landed_pages, packed
from paperloom.session import scratch_path
from paperloom.streaming import incremental as I, landing as L


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def incremental_records(t):
    """Events land as files by type, are read in several batches, and the latest per user is kept."""
    root = scratch_path(t.spark, "events")
    landing = t.events.select("event_id", "ts", "user_id", "event_type")
    landing.repartition(6, "event_type").write.parquet(f"{root}/landing")
    stream = I.table_stream(t.spark, f"{root}/landing", landing.schema, files_per_batch=2)
    I.run_available(stream, I.batch_writer(f"{root}/table"), f"{root}/checkpoint")
    view = I.latest_view(t.spark, f"{root}/table", "user_id", ["ts", "event_id"])
    return view.select("user_id", "event_id", "event_type")


@query(f"SELECT identifier, filename_parsed, abstract FROM ({RECORDS_SQL})")
def incremental_harvest(t):
    """Landed pages are read once; a second run of the same query adds nothing."""
    root = scratch_path(t.spark, "harvest")
    pages = landed_pages(t)
    for _ in range(2):
        I.ingest_records(t.spark, pages, f"{root}/table", f"{root}/checkpoint")
    rows = t.spark.read.option("basePath", f"{root}/table").parquet(f"{root}/table/batch=*")
    return rows.select("identifier", "filename_parsed", F.md5("abstract").alias("abstract"))


def _dies(batch_id):
    raise RuntimeError(f"lost after batch {batch_id} was written")


def _files(t, table):
    return L.landed_files(t.spark, table).filter("kind = 'file'").select(
        "submission_id", "inner_path", F.md5("content").alias("digest"), "attempt")


@query(f"""
SELECT *, 1 AS attempt FROM ({ARCHIVE_FILES_SQL} AND doc_id IN (SELECT doc_id FROM labels))""")
def archive_stream(t):
    """Archives land twice.  The first batch dies before it is committed; every archive is in the table once all the same."""
    root = scratch_path(t.spark, "archives")
    land(packed(t, "doc_id % 2 = 0"), f"{root}/landing", "even")
    run = lambda end=None: L.ingest_landed(t.spark, f"{root}/landing", label_ids(t), f"{root}/table", f"{root}/state", before_commit=end)
    try:
        run(_dies)
    except StreamingQueryException:
        land(packed(t, "doc_id % 2 = 1"), f"{root}/landing", "odd")
    for _ in range(2):
        run()
    return _files(t, f"{root}/table")


@query(f"SELECT submission_id, inner_path, digest, CAST(submission_id AS BIGINT) % 2 + 1 AS attempt FROM ({ARCHIVE_FILES_SQL})")
def archive_retry(t):
    """Half of the archives land cut off, are reported, and are read again once they are whole."""
    root = scratch_path(t.spark, "archives")
    odd = packed(t, "doc_id % 2 = 1")
    land(packed(t, "doc_id % 2 = 0"), f"{root}/landing", "even")
    land(odd.withColumn("content", F.expr("substring(content, 1, length(content) * 2 div 3)")), f"{root}/landing", "odd")
    for _ in range(2):
        L.ingest_landed(t.spark, f"{root}/landing", None, f"{root}/table", f"{root}/state", split_bytes=1 << 18)
        land(odd, f"{root}/landing", "odd")
    return _files(t, f"{root}/table").withColumn("attempt", F.col("attempt").cast("long"))
