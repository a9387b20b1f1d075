"""Sinks: tables, tokens, logs, vectors."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.session import discard
from paperloom.sources.storage import create_once, list_names, read_bytes
from paperloom.sources.tables import CSV_OPTIONS


def write_records(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a metadata table.  Must not be the path the frame is read from."""
    writer = records.write.mode("overwrite")
    if fmt == "csv":
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


class SnapshotConflict(RuntimeError):
    """Another writer has published the version that this one meant to."""


def update_snapshot(spark: SparkSession, root: str, make, tries: int = 20) -> int:
    """Publish `make(current table or None)` as the next version below `root`; returns its number.

    Writers compare and set: a version's entry is created only if there is none, by one writer.  The loser drops what it has
    written and makes its table again, from the version that won, so no writer's rows are lost.  Data go to a folder of
    the writer's own first; a job that dies leaves the current version as it is.
    """
    for _ in range(tries):
        version = current_version(spark, root)
        df = make(None if version is None else read_snapshot(spark, root, version))
        try:
            return write_snapshot(df, root, version or 0)
        except SnapshotConflict:
            continue
    raise SnapshotConflict(f"{tries} other writers were faster below {root}")


def write_snapshot(df: DataFrame, root: str, base: int | None = None) -> int:
    """Write a new version of a table below `root` and publish it; returns its number.

    `base` is the version that `df` derives from (0 for none): if another one has been published since, nothing is published
    and SnapshotConflict is raised.  Without it the table replaces whatever version is there by then.
    """
    spark = df.sparkSession
    folder = os.urandom(8).hex()
    data = f"{root}/data/{folder}"
    df.write.parquet(data)
    while True:
        version = (current_version(spark, root) or 0 if base is None else base) + 1
        if create_once(spark, f"{root}/versions/{version:012d}", folder.encode()):
            return version
        if base is not None:
            discard(spark, data)
            raise SnapshotConflict(f"version {version} below {root} is another writer's")


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the published version, None where there is no table yet."""
    names = [name for name in list_names(spark, f"{root}/versions") if name.isdigit()]
    return int(max(names)) if names else None


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The published version of a table, or an earlier one."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version below {root}")
    return spark.read.parquet(f"{root}/data/{read_bytes(spark, f'{root}/versions/{version:012d}').decode()}")


def write_tokens(tokens: DataFrame, path: str, mode: str = "append") -> None:
    """(doc_id, tokens) as Parquet: one array per document, few large files."""
    tokens.select("doc_id", "tokens").write.mode(mode).parquet(path)


def write_submission_log(members: DataFrame, path: str, mode: str = "append") -> None:
    """Which submissions each archive holds.

    One column names the archive rather than one directory each: archives are
    many and their logs are small.
    """
    log = members.filter(F.col("kind") == "gz").select(
        F.col("tar_name").alias("tarfile"), "submission_id"
    )
    log.write.mode(mode).parquet(path)


def write_submissions(files: DataFrame, path: str, mode: str = "append") -> None:
    """Extracted files as (submission_id, inner_path, content) rows."""
    kept = files.filter(F.col("kind") == "file")
    kept.select("tar_name", "submission_id", "inner_path", "content").write.mode(mode).parquet(path)


def append_failures(failures: DataFrame, path: str) -> None:
    """Failures are appended, never overwritten."""
    stamped = failures.withColumn("logged_at", F.current_timestamp())
    stamped.write.mode("append").parquet(path)


def vector_lines(vectors: DataFrame, vector: str = "vector", order: str | None = None) -> DataFrame:
    """Tab-separated text of vectors below a `rows<TAB>width` header line."""
    sizes = vectors.agg(
        F.concat_ws("\t", F.count("*"), F.coalesce(F.max(F.size(vector)), F.lit(0))).alias("value")
    )
    key = F.col(order).cast("string") if order else F.lit(None).cast("string")
    body = vectors.select(
        F.lit(1).alias("part"), key.alias("key"), F.array_join(vector, "\t").alias("value")
    )
    head = sizes.select(F.lit(0).alias("part"), F.lit(None).cast("string").alias("key"), "value")
    return head.unionByName(body)


def write_vectors_tsv(vectors: DataFrame, path: str, vector: str = "vector",
                      order: str | None = None) -> None:
    """Export vectors for an external layout program: `path/header` and `path/body`.

    The body is written by all tasks, sorted only if `order` asks for it; the
    header's file, then the body's files in name order, are the whole export.
    """
    lines = vector_lines(vectors, vector, order)
    head, body = lines.filter("part = 0"), lines.filter("part = 1")
    if order:
        body = body.orderBy("key")
    head.select("value").write.mode("overwrite").text(f"{path}/header")
    body.select("value").write.mode("overwrite").text(f"{path}/body")


def regroup_submissions(files: DataFrame) -> DataFrame:
    """(submission_id, files): the extracted files of each submission, in path order.

    A submission is what one author sent in, so its files fit a row together.
    """
    kept = files.filter(F.col("kind") == "file")
    return kept.groupBy("submission_id").agg(
        F.array_sort(F.collect_list(F.struct("inner_path", "tar_name", "content"))).alias("files"))


def write_matrix_market(counts: DataFrame, path: str, documents: int, terms: int) -> None:
    """(doc, term_id, cnt), 0-based, as coordinate text: `path/header` and `path/body`.

    The header has the format line and the size line; the body is written by all tasks.
    """
    sizes = counts.agg(F.concat_ws(" ", F.lit(documents), F.lit(terms), F.count("*")).alias("value"))
    head = sizes.select(F.explode(F.array(
        F.lit("%%MatrixMarket matrix coordinate real general"), F.col("value"))).alias("value"))
    head.write.mode("overwrite").text(f"{path}/header")
    counts.select(F.concat_ws(" ", F.col("doc") + 1, F.col("term_id") + 1, "cnt")).write.mode("overwrite").text(f"{path}/body")
