"""A stream over a landing folder of archives in which a failed archive comes again, as a later offset.

The source keeps a log beside the stream's checkpoint.  An entry is (path, bytes, attempt); entries are only ever added, in
segments that appear whole or not at all, and an offset is a number of entries.  So a batch that is run again after a crash
reads the very entries that it had, whatever has landed since.

An archive gets its first entry when it is found, and another one when a batch has reported it as failed, up to `attempts`.
Rows are only what is to be done, no bytes: batches read the archives themselves, as many tasks (`paperloom.sources.ranges`).
"""

from __future__ import annotations

import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from paperloom.functions.paths import base_name
from paperloom.sources import archives as A, ranges as R
from paperloom.sources.storage import file_system, files_below

FORMAT = "landed_archives"
_SCHEMA = "path string, bytes bigint, attempt int, entry bigint"
ENTRIES_PER_TASK = 1000


class LandedArchives(DataSource):
    """Options: path (the landing folder), log, failures, suffix, attempts."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return _SCHEMA

    def streamReader(self, schema):
        return _Reader(self.options)


class _Log:
    """Segments of entries, named by the number of their first entry."""

    def __init__(self, folder: str):
        self.folder, self.entries, self.read_ = folder, [], set()
        self.last: dict[str, int] = {}

    def refresh(self):
        system, _ = file_system(self.folder)
        for path, _, _ in files_below(self.folder, ".json"):
            if path not in self.read_:
                with system.open_input_stream(file_system(path)[1]) as file:
                    self._take(json.loads(file.read()))
                self.read_.add(path)

    def _take(self, entries):
        self.entries += [tuple(e) for e in entries]
        self.last.update((path, attempt) for path, _, attempt in entries)

    def add(self, entries):
        if not entries:
            return
        system, root = file_system(self.folder)
        system.create_dir(root, recursive=True)
        name = f"{len(self.entries):015d}.json"
        hidden = f"{root}/.{name}-{os.urandom(4).hex()}"
        with system.open_output_stream(hidden) as out:
            out.write(json.dumps(entries).encode())
        system.move(hidden, f"{root}/{name}")
        self.read_.add(next(p for p, _, _ in files_below(self.folder, name)))
        self._take(entries)


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.suffix = options["path"], options.get("suffix", ".tar")
        self.failures = options.get("failures")
        self.attempts = int(options.get("attempts", 3))
        self.log = _Log(options["log"])

    def initialOffset(self):
        return {"entry": 0}

    def latestOffset(self):
        self.log.refresh()
        found = [(path, size, 1) for path, size, _ in files_below(self.path, self.suffix) if path not in self.log.last]
        again = {}
        for path, attempt in self._failed():
            if attempt == self.log.last.get(path) and attempt < self.attempts:
                again[path] = attempt + 1
        sizes = {path: size for path, size, _ in files_below(self.path, self.suffix)} if again else {}
        self.log.add([*found, *((p, sizes[p], a) for p, a in sorted(again.items()) if p in sizes)])
        return {"entry": len(self.log.entries)}

    def _failed(self):
        if not self.failures:
            return
        system, _ = file_system(self.failures)
        for path, _, _ in files_below(self.failures, ".json"):
            with system.open_input_stream(file_system(path)[1]) as file:
                for line in file.read().decode().splitlines():
                    row = json.loads(line)
                    yield row["path"], row["attempt"]

    def partitions(self, start, end):
        self.log.refresh()
        own = [(*e, k) for k, e in enumerate(self.log.entries[start["entry"]: end["entry"]], start["entry"])]
        return [InputPartition(own[k: k + ENTRIES_PER_TASK]) for k in range(0, len(own), ENTRIES_PER_TASK)]

    def read(self, partition):
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
        names = ["path", "bytes", "attempt", "entry"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*partition.value), kinds)], names)

    def commit(self, end):
        pass


def landed_stream(spark: SparkSession, landing: str, state: str, suffix: str = ".tar", attempts: int = 3) -> DataFrame:
    """What is to be read of a landing folder; the log and the failures that batches report are kept below `state`."""
    spark.dataSource.register(LandedArchives)
    return (spark.readStream.format(FORMAT).option("path", landing).option("log", f"{state}/log")
            .option("failures", f"{state}/failures").option("suffix", suffix).option("attempts", attempts).load())


def unpack_batch(spark: SparkSession, batch: DataFrame, identifiers: DataFrame | None, suffixes=None,
                 split_bytes: int = R.SPLIT_BYTES) -> DataFrame:
    """Inner files of a batch's archives with the attempt that read them, and rows for what could not be read."""
    members = R.split_members(spark, batch.select("path"), (".gz",), split_bytes=split_bytes)
    if identifiers is not None:
        members = A.wanted_members(members, identifiers)
    files = A.inner_files(members, suffixes)
    tries = batch.select(base_name("path").alias("tar_name"), "path", "attempt")
    return files.join(tries, "tar_name")


def ingest_landed(spark: SparkSession, landing: str, identifiers: DataFrame | None, table: str, state: str, suffixes=None,
                  attempts: int = 3, split_bytes: int = R.SPLIT_BYTES, before_commit=None):
    """Unpack every landed archive not read yet, and again those whose last attempt failed; then end.

    A batch writes its files to `table/batch=n` and names the failed archives in `state/failures/batch=n`, both over what an
    earlier run of the same batch left there.  Archives are told apart by name.  `before_commit(batch_id)` is called last.
    """
    from paperloom.streaming.incremental import run_available

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{table}/batch={batch_id}"
        unpack_batch(spark, batch, identifiers, suffixes, split_bytes).write.mode("overwrite").parquet(place)
        bad = spark.read.parquet(place).filter(F.col("kind").isin(*A.FAILURE_KINDS))
        bad.select("path", "attempt").distinct().write.mode("overwrite").json(f"{state}/failures/batch={batch_id}")
        if before_commit is not None:
            before_commit(batch_id)

    return run_available(landed_stream(spark, landing, state, attempts=attempts), write, f"{state}/checkpoint")


def landed_files(spark: SparkSession, table: str) -> DataFrame:
    """Files of each archive as its last attempt read them."""
    rows = spark.read.option("basePath", table).parquet(f"{table}/batch=*")
    last = rows.groupBy("tar_name").agg(F.max("attempt").alias("attempt"))
    return rows.join(last, ["tar_name", "attempt"], "left_semi")
