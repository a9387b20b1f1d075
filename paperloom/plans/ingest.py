"""Ingest: records and archives in, unpacked submissions of the wanted set out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.operators.filters import harvest_window
from paperloom.operators.reconcile import conversion_outcome, known_members, pending, source_tier
from paperloom.operators.sets import append_records, upsert
from paperloom.sources import archives as A, files, sinks, xml_records


def refresh_records(spark: SparkSession, pages: str, table: str, spec: str | None = None,
                    once_per_record: bool = False) -> int:
    """Read landed harvest pages and publish a new version of the record table.

    New rows are appended; `once_per_record` keeps the latest row of each.  The
    table is rewritten, as suits a catalogue of records; where that is too much,
    `paperloom.streaming.incremental.ingest_records` adds only what is new.
    """
    new = harvest_window(xml_records.read_records(spark, pages), spec=spec)

    def merged(old):
        if old is None:
            return new
        return upsert(old, new) if once_per_record else append_records(old, new)

    return sinks.update_snapshot(spark, table, merged)


@dataclass
class IngestTables:
    """Output tables of an ingest run."""

    submissions: str
    log: str
    pdf_only: str
    failures: str


def archives_to_do(listing: DataFrame, log: DataFrame | None) -> DataFrame:
    """Archives no log entry exists for, by full name."""
    keyed = listing.withColumn("tarfile", F.substring_index("path", "/", -1))
    return keyed if log is None else pending(keyed, "tarfile", log)


def ingest_archives(archives: DataFrame, identifiers: DataFrame, out: IngestTables,
                    suffixes=None) -> None:
    """Unpack the known submissions of (path, content) archives into tables.

    Members are written once, compressed as they came, and read again for the
    steps below: an archive is sliced by one task, but everything after that is
    spread over the cluster and nothing is sliced twice.
    """
    spark = archives.sparkSession
    from paperloom.session import scratch_path

    stage = scratch_path(spark, "members")
    members = A.tar_members(archives)
    ids = identifiers.select("filename_parsed")
    kept = members.filter(F.col("kind") == "gz").transform(known_members, ids).unionByName(
        members.filter(F.col("kind") != "gz")
    )
    kept.write.parquet(stage)
    members = spark.read.parquet(stage)

    sinks.write_submission_log(members, out.log)
    A.pdf_only(members).write.mode("append").parquet(out.pdf_only)
    files_ = A.inner_files(A.spread_members(members), suffixes)
    unpacked = scratch_path(spark, "files")
    files_.write.parquet(unpacked)
    files_ = spark.read.parquet(unpacked)
    sinks.write_submissions(files_, out.submissions)
    bad = files_.filter(F.col("kind").isin(*A.FAILURE_KINDS)).select("tar_name", "member_name", "kind", "error")
    sinks.append_failures(bad, out.failures)


def plan_sources(spark: SparkSession, origin: DataFrame, local_prefix: str | None,
                 mirror: DataFrame) -> DataFrame:
    """Where each archive of the origin listing is to be read from."""
    local = (
        files.list_objects(spark, local_prefix) if local_prefix
        else origin.limit(0).select("path")
    )
    return source_tier(origin, local, mirror)
