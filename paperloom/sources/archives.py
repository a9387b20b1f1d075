"""Archives in archives: tar -> compressed members -> inner files.

The work is split in two so that one large archive does not keep one task busy:

1. `tar_members` slices an archive into its members without decompressing them;
2. the members are filtered by id and spread over the cluster;
3. `inner_files` decompresses one member at a time.

Rows carry bytes, so both generators yield small batches.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paperloom import schemas as S
from paperloom.functions.paths import base_name, ends_with_any, member_kind, stem
from paperloom.memory import released

BATCH_BYTES = 8 << 20
# Kinds of rows that report an archive or a member that could not be read.
FAILURE_KINDS = ("not_tar", "error")
_UNREADABLE = (tarfile.TarError, OSError, EOFError, zlib.error)


def _batches(rows, names) -> Iterator[pd.DataFrame]:
    """Group row tuples into frames bounded by the size of their last field."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= BATCH_BYTES:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


_SLICED = "path string, member_name string, kind string, error string, content binary"


def tar_members(
    archives: DataFrame, suffixes=(".gz", ".pdf"), name_part: str | None = None,
    with_content: bool = True,
) -> DataFrame:
    """(path, content) of tar files -> one row per wanted member.

    Directories and other suffixes are skipped before their bytes are read; pdf
    members are listed without content.  A file that is no tar gives one row of
    kind `not_tar`; one that breaks off gives what was readable and one row of
    kind `error`.
    """
    wanted = tuple(suffixes)

    def slice_members(frames):
        def rows():
            for frame in frames:
                for path, content in zip(frame["path"], frame["content"]):
                    yield from members_of(path, content)
        yield from _batches(rows(), ["path", "member_name", "kind", "error", "content"])

    def members_of(path, content):
        opened = False
        try:
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                opened = True
                for item in tar:
                    name = item.name
                    if not item.isfile() or not name.endswith(wanted):
                        continue
                    if name_part is not None and name_part not in name:
                        continue
                    body = None
                    if with_content and not name.endswith(".pdf"):
                        body = tar.extractfile(item).read()
                    yield path, name, None, None, body
        except _UNREADABLE as problem:
            yield path, None, "error" if opened else "not_tar", str(problem), None

    sliced = archives.select("path", "content").mapInPandas(released(slice_members), _SLICED)
    return sliced.select(
        base_name("path").alias("tar_name"),
        "member_name",
        stem("member_name").alias("submission_id"),
        F.coalesce("kind", member_kind("member_name")).alias("kind"),
        "error",
        "content",
    )


def pdf_only(members: DataFrame) -> DataFrame:
    """Side output: ids present only as a pdf."""
    return members.filter(F.col("kind") == "pdf").select("tar_name", "submission_id")


def wanted_members(members: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Members of the known submissions, and the rows that report failures.

    Failures have no submission id; they pass the join on a marker of their own,
    so an archive is sliced once.
    """
    failed = F.col("kind").isin(*FAILURE_KINDS)
    marker = "\x00failure"
    keyed = members.withColumn("_known", F.when(failed, F.lit(marker)).otherwise(F.col("submission_id")))
    ids = identifiers.select(F.col("filename_parsed").alias("_known")).unionByName(
        identifiers.sparkSession.range(1).select(F.lit(marker).alias("_known"))
    )
    return keyed.join(ids, "_known", "left_semi").select(*members.columns)


def spread_members(members: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rebalance members after the filter, as one archive is one scan task."""
    keys = [F.col("tar_name"), F.col("member_name")]
    return members.repartition(partitions, *keys) if partitions else members.repartition(*keys)


def unpack_member(name: str, content: bytes, recursive: bool = False):
    """Files in one compressed member, as (inner_path, bytes, error) tuples.

    A member that is no tar is a single compressed text, named after the member
    with the suffix `.tex`.
    """
    try:
        inner = tarfile.open(fileobj=io.BytesIO(content), mode="r:*")
    except _UNREADABLE:
        try:
            text = gzip.decompress(content)
        except _UNREADABLE as problem:
            yield None, None, str(problem)
            return
        last = name.rsplit("/", 1)[-1]
        yield (last[:-3] if last.endswith(".gz") else last) + ".tex", text, None
        return
    try:
        with inner:
            for item in inner:
                if not item.isfile():
                    continue
                body = inner.extractfile(item).read()
                if recursive and item.name.endswith((".tar", ".gz", ".tgz")):
                    for path, deeper, problem in unpack_member(item.name, body, True):
                        yield f"{item.name}/{path}" if path else item.name, deeper, problem
                else:
                    yield item.name, body, None
    except _UNREADABLE as problem:
        yield None, None, str(problem)


def inner_files(members: DataFrame, suffixes=None, recursive: bool = False) -> DataFrame:
    """Decompress members: one row per inner file.

    `suffixes` keeps only such files.  Rows that report a failed archive are
    passed on as they are.  A member that cannot be read gives a row of kind `error` and does not stop the job; a member without a wanted file
    gives no row.  Rows that report a failure of an archive are passed on.
    """
    wanted = tuple(suffixes) if suffixes else None

    def unpack(frames):
        def rows():
            for frame in frames:
                for tar_name, member, submission, kind, error, content in zip(
                    frame["tar_name"], frame["member_name"], frame["submission_id"], frame["kind"], frame["error"],
                    frame["content"],
                ):
                    if kind in FAILURE_KINDS:
                        yield tar_name, member, submission, None, kind, error, None
                        continue
                    for path, body, problem in unpack_member(member, content, recursive):
                        if problem is not None:
                            yield tar_name, member, submission, path, "error", problem, None
                        elif wanted is None or path.endswith(wanted):
                            yield tar_name, member, submission, path, "file", None, body
        yield from _batches(rows(), S.INNER_FILES.names)

    packed = members.filter(
        ((F.col("kind") == "gz") & F.col("content").isNotNull()) | F.col("kind").isin(*FAILURE_KINDS)
    )
    return packed.select(
        "tar_name", "member_name", "submission_id", "kind", "error", "content"
    ).mapInPandas(released(unpack), S.INNER_FILES)


def tex_files(files: DataFrame, suffixes=(".tex", ".ltx")) -> DataFrame:
    """Only source text; error rows stay visible."""
    return files.filter(F.col("kind").isin(*FAILURE_KINDS) | ends_with_any("inner_path", suffixes))


def explode_archives(
    archives: DataFrame, identifiers: DataFrame | None = None, suffixes=None,
    recursive: bool = False, name_part: str | None = None,
) -> DataFrame:
    """Archives -> inner files of the known submissions.

    An archive that is no tar, or that breaks off, is reported by a row of kind
    `not_tar` or `error`, whatever the identifiers.
    """
    members = tar_members(archives, suffixes=(".gz",), name_part=name_part)
    if identifiers is not None:
        members = wanted_members(members, identifiers)
    return inner_files(spread_members(members), suffixes, recursive)


def extraction_counters(members: DataFrame, files: DataFrame) -> DataFrame:
    """Matched and extracted submissions per archive.

    Both inputs are reduced to one row per submission before they meet, so no
    bytes are shuffled for the count.
    """
    matched = members.filter(F.col("kind") == "gz").groupBy("tar_name").agg(
        F.count("*").alias("matched")
    )
    extracted = (
        files.filter(F.col("kind") == "file")
        .select("tar_name", "member_name").distinct()
        .groupBy("tar_name").agg(F.count("*").alias("extracted"))
    )
    return matched.join(extracted, "tar_name", "left").select(
        "tar_name", "matched", F.coalesce("extracted", F.lit(0)).alias("extracted")
    )


def register_archive_function(spark, name: str = "explode_archive"):
    """Register the member unpacker as a SQL table function.

    `SELECT * FROM t, LATERAL explode_archive(member_name, content)`
    """
    from pyspark.sql.functions import udtf

    class ExplodeArchive:
        def eval(self, member_name: str, content: bytes):
            if content is None:
                return
            for path, body, problem in unpack_member(member_name, bytes(content)):
                yield path, body, problem

    table_function = udtf(
        ExplodeArchive, returnType="inner_path string, content binary, error string"
    )
    spark.udtf.register(name, table_function)
    return table_function
