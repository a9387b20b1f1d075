"""Archives read in parallel: an index of members first, then their byte ranges.

`tar_members` of `paperloom.sources.archives` takes an archive as one row of bytes, so one task holds it and 2 GB are its limit.
Here no row and no task holds an archive:

1. `index_archives` walks the headers of each archive, seeking past the members' bytes: 512 bytes are read for a member;
2. `member_ranges` cuts an archive's members into stretches of about `split_bytes`, by an aggregate over the index;
3. `read_ranges` deals the stretches over the cluster and reads each one's members, in batches bounded by bytes.

A member is one row, however long.  Files are opened through Arrow's file systems, so they may be on a mounted folder or in
a store that Arrow knows.  An archive that is no tar gives a row of kind `not_tar`, one that breaks off what was readable and
a row of kind `error`, as with `tar_members`.
"""

from __future__ import annotations

import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions.paths import base_name, member_kind, stem
from paperloom.memory import released
from paperloom.sources.archives import _UNREADABLE, BATCH_BYTES, inner_files, wanted_members
from paperloom.sources.files import list_objects
from paperloom.sources.storage import file_system

SPLIT_BYTES = 64 << 20
INDEX_ROWS = 4096
_INDEX = "path string, member_name string, header bigint, ending bigint, kind string, error string"
_MEMBERS = pa.schema([("path", pa.string()), ("member_name", pa.string()), ("kind", pa.string()), ("error", pa.string()), ("content", pa.binary())])


class _Opened:
    """A tar file from some header on; members are not remembered, so a long archive takes no memory."""

    def __init__(self, path: str, start: int = 0):
        system, where = file_system(path)
        self.file = system.open_input_file(where)
        try:
            self.file.seek(start)
            self.tar = tarfile.open(fileobj=self.file, mode="r:")
        except BaseException:
            self.file.close()
            raise

    def __iter__(self):
        while (item := self.tar.next()) is not None:
            self.tar.members = []
            yield item

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.tar.close()
        self.file.close()


def _walk(path, wanted, name_part):
    """(path, member, header place, end, kind, error) of the wanted members of an archive."""
    opened = False
    try:
        with _Opened(path) as archive:
            opened = True
            size = archive.file.size()
            for item in archive:
                if not item.isfile() or not item.name.endswith(wanted) or (name_part is not None and name_part not in item.name):
                    continue
                if item.offset_data + item.size > size:
                    raise tarfile.ReadError("unexpected end of data")
                yield path, item.name, item.offset, item.offset_data + item.size, None, None
            # A header that is cut off looks like the end to the reader; the end has a block of zeros.
            archive.file.seek(min(archive.tar.offset, size))
            if archive.file.read(512) != bytes(512):
                raise tarfile.ReadError("unexpected end of data")
    except _UNREADABLE as problem:
        yield path, None, None, None, "error" if opened else "not_tar", str(problem)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows that name work, dealt to as many tasks as shuffles have.

    The number is given on purpose: the rows are short whatever lies behind them, so without it adaptive execution would
    merge them all into one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def index_archives(listing: DataFrame, suffixes=(".gz", ".pdf"), name_part: str | None = None) -> DataFrame:
    """(path) of archives -> (path, member_name, header, ending, kind, error), a row for each wanted member.

    `header` and `ending` are the places of a member's header and of the end of its bytes.
    """
    wanted = tuple(suffixes)

    def run(batches):
        names, rows = ["path", "member_name", "header", "ending", "kind", "error"], []

        def batch():
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                for row in _walk(path, wanted, name_part):
                    rows.append(row)
                    if len(rows) >= INDEX_ROWS:
                        yield batch()
                        rows.clear()
        if rows:
            yield batch()

    return _dealt(listing.select("path"), "path").mapInArrow(released(run), _INDEX)


def member_ranges(index: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, ending, members): stretches of an archive, by the split that a member's header lies in."""
    return index.filter(F.col("header").isNotNull()).groupBy(
        "path", F.floor(F.col("header") / split_bytes).alias("split")
    ).agg(F.min("header").alias("start"), F.max("header").alias("last"), F.max("ending").alias("ending"), F.count("*").alias("members"))


def read_ranges(ranges: DataFrame, suffixes=(".gz", ".pdf"), name_part: str | None = None, with_content: bool = True) -> DataFrame:
    """(path, start, last) -> (path, member_name, kind, error, content) of the wanted members of each stretch."""
    wanted = tuple(suffixes)

    def rows_of(path, start, last):
        try:
            with _Opened(path, start) as archive:
                for item in archive:
                    if item.offset > last:
                        return
                    name = item.name
                    if item.isfile() and name.endswith(wanted) and (name_part is None or name_part in name):
                        body = archive.tar.extractfile(item).read() if with_content and not name.endswith(".pdf") else None
                        yield path, name, None, None, body
        except _UNREADABLE as problem:
            yield path, None, "error", str(problem), None

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for stretch in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for row in rows_of(*stretch):
                    held.append(row)
                    size += len(row[-1] or b"") + 200
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _MEMBERS)], schema=_MEMBERS)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _MEMBERS)], schema=_MEMBERS)

    return _dealt(ranges.select("path", "start", "last"), "path", "start").mapInArrow(released(run), "path string, member_name string, kind string, error string, content binary")


def split_members(spark: SparkSession, listing: DataFrame, suffixes=(".gz", ".pdf"), name_part: str | None = None,
                  with_content: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path) of archives -> the rows of `tar_members`, read by many tasks.  The index is stored, as it is used twice."""
    from paperloom.session import staged

    index = staged(index_archives(listing, suffixes, name_part), "archive-index")
    failures = index.filter(F.col("kind").isNotNull()).select(
        "path", "member_name", "kind", "error", F.lit(None).cast("binary").alias("content"))
    read = read_ranges(member_ranges(index, split_bytes), suffixes, name_part, with_content)
    return read.unionByName(failures).select(
        base_name("path").alias("tar_name"), "member_name", stem("member_name").alias("submission_id"),
        F.coalesce("kind", member_kind("member_name")).alias("kind"), "error", "content")


def explode_split_archives(spark: SparkSession, path: str, identifiers: DataFrame | None = None, suffixes=None,
                           recursive: bool = False, name_part: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Archives below a path -> inner files of the known submissions; as `explode_archives`, whatever an archive's size."""
    members = split_members(spark, list_objects(spark, path), (".gz",), name_part, split_bytes=split_bytes)
    if identifiers is not None:
        members = wanted_members(members, identifiers)
    return inner_files(members, suffixes, recursive)
