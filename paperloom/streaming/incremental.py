"""Incremental flows: each landed file is handled once, then the job ends.

The checkpoint of a query replaces a high-water date and the test for an
existing output.  A batch writes to a directory named after its batch id, so a
batch that failed half-way is written over when it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom import constants as C, schemas as S
from paperloom.functions.paths import base_name
from paperloom.operators.sets import latest
from paperloom.sources import archives as A
from paperloom.sources.files import read_archives
from paperloom.sources.xml_records import XML_OPTIONS, project_records, stamp_records


def batch_writer(path: str, transform=None):
    """A foreachBatch function that writes batch n to `path/batch=n`, replacing it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_available(stream: DataFrame, write, checkpoint: str, name: str | None = None):
    """Handle everything that is there, then stop."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def harvest_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None,
                   body_tag: str = C.HARVEST_FORMAT) -> DataFrame:
    """New harvest pages of a landing directory as `records`."""
    reader = (
        spark.readStream.format("xml").options(**XML_OPTIONS)
        .option("rowTag", C.HARVEST_ROW).schema(S.harvest_record(body_tag))
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stamp_records(project_records(reader.load(landing), body_tag=body_tag))


def ingest_records(spark: SparkSession, landing: str, table: str, checkpoint: str,
                   files_per_batch: int | None = None, body_tag: str = C.HARVEST_FORMAT):
    """Append the records of pages that have not been read yet."""
    stream = harvest_stream(spark, landing, files_per_batch, body_tag)
    return run_available(stream, batch_writer(table), checkpoint)


def archive_stream(spark: SparkSession, landing: str, archives_per_batch: int = 64) -> DataFrame:
    """New archives of a landing directory with their bytes."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", archives_per_batch)
        .load(landing).select("path", "content")
    )


def ingest_archives(spark: SparkSession, landing: str, identifiers: DataFrame, table: str,
                    checkpoint: str, suffixes=None, archives_per_batch: int = 64):
    """Unpack the known submissions of every archive not seen before, once.

    Archives and members that cannot be read are rows of kind `not_tar` or
    `error` of the same table; see `failed_archives` and `retry_archives`.
    """
    def unpack(batch: DataFrame) -> DataFrame:
        return A.explode_archives(batch, identifiers, suffixes)

    stream = archive_stream(spark, landing, archives_per_batch)
    return run_available(stream, batch_writer(table, unpack), checkpoint)


def failed_archives(spark: SparkSession, table: str) -> DataFrame:
    """(tar_name, failures) of the archives whose last try left failures.

    Batches are numbered upwards and so are retries, which come after all of
    them; an archive is judged by its last one.
    """
    rows = spark.read.option("basePath", table).parquet(f"{table}/batch=*").select("tar_name", "kind", "batch")
    last = rows.groupBy("tar_name", "batch").agg(
        F.count_if(F.col("kind").isin(*A.FAILURE_KINDS)).alias("failures"))
    latest_try = last.groupBy("tar_name").agg(F.max_by("failures", "batch").alias("failures"))
    return latest_try.filter(F.col("failures") > 0)


def retry_archives(spark: SparkSession, landing: str, identifiers: DataFrame, table: str, suffixes=None) -> int:
    """Read the failed archives of `table` again, as a batch after the last; returns its number."""
    tried = spark.read.option("basePath", table).parquet(f"{table}/batch=*")
    number = tried.agg(F.max("batch")).first()[0] + 1
    failed = failed_archives(spark, table).select("tar_name")
    again = (
        read_archives(spark, landing).withColumn("tar_name", base_name("path"))
        .join(failed, "tar_name", "left_semi").select("path", "content")
    )
    batch_writer(table, lambda rows: A.explode_archives(rows, identifiers, suffixes))(again, number)
    return number


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a landing directory."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def latest_view(spark: SparkSession, table: str, key: str = "identifier",
                recency=("date_retrieved", "datestamp")) -> DataFrame:
    """One row per record over all batches.

    Re-issued records are resolved when read, so a batch costs as much as its
    own rows however large the table has become; see `compact`.
    """
    rows = spark.read.option("basePath", table).parquet(f"{table}/batch=*")
    order = [*recency, "batch"]
    return latest(rows, key, order).drop("batch")


def compact(spark: SparkSession, table: str, out: str, key: str = "identifier",
            recency=("date_retrieved", "datestamp")) -> None:
    """Write the resolved view as a table of its own."""
    latest_view(spark, table, key, recency).write.mode("overwrite").parquet(out)
