"""File scans: listings, whole texts, lines, logs and submission trees."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom import constants as C
from paperloom.functions.paths import stem
from paperloom.memory import released
from paperloom.sources.storage import file_system

# Names or files in a batch, and bytes of these.
LISTED, BATCH_BYTES = 1000, 8 << 20
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_objects(spark: SparkSession, prefix: str, suffix: str | None = ".tar") -> DataFrame:
    """Objects below a prefix: path, length, modification time.

    Content is never selected, so no object is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = reader.load(prefix).select("path", "length", "modificationTime")
    return listing if suffix is None else listing.filter(F.col("path").endswith(suffix))


def read_archives(spark: SparkSession, prefix: str, suffix: str = ".tar") -> DataFrame:
    """Archives with their bytes, for `paperloom.sources.archives`."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(prefix)
        .select("path", "content")
    )


def read_documents(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """One row per file: id from the file name, whole text."""
    scan = (
        spark.read.option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", True)
        .text(path, wholetext=True)
    )
    return scan.select(stem(F.col("_metadata.file_name")).alias("doc_id"), F.col("value").alias("text"))


def read_markup(spark: SparkSession, path: str) -> DataFrame:
    """One row per XML file."""
    return read_documents(spark, path, ".xml").withColumnRenamed("text", "xml")


def read_line_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One document per line."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a position that orders them within their file.

    A long file is read in splits.  `block` is the start of the split, `line`
    grows within it, so (block, line) is the order in the file while each block
    is handled by a task of its own.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def read_submission_log(spark: SparkSession, path: str) -> DataFrame:
    """Log of `TARFILE:` headers, each followed by ids -> (tarfile, submission_id).

    Ids before the first header of a file have a null tarfile.
    """
    from paperloom.operators.windows import fill_forward

    lines = read_log_lines(spark, path)
    header = F.nullif(F.regexp_extract("value", C.LOG_HEADER, 1), F.lit(""))
    marked = lines.withColumn("header", header)
    filled = fill_forward(
        marked, keys=["file"], chunk=F.col("block"), order="line", value="header", out="tarfile"
    )
    return filled.filter(F.col("header").isNull() & (F.trim("value") != "")).select(
        "tarfile", F.trim("value").alias("submission_id")
    )


def _hidden(name: str) -> bool:
    """Names that Spark's own scans leave out."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def _entries(system, folder: str):
    from pyarrow import fs

    return [e for e in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if not _hidden(e.base_name)]


def _folders(root: str):
    """(folder) below `root` -> (folder, name) of each folder in it; the folder '' is `root` itself."""
    def run(batches):
        system, top = file_system(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [e.base_name for e in _entries(system, f"{top}/{folder}") if not e.is_file]
                for k in range(0, len(found), LISTED):
                    part = found[k:k + LISTED]
                    yield pa.RecordBatch.from_pydict({"folder": [folder] * len(part), "name": part})

    return released(run)


def _contents(root: str, suffix: str):
    """(archive, submission_id) -> (archive, submission_id, inner_path, content) of the files in that folder and below."""
    def files(system, folder, inner=""):
        for e in _entries(system, folder):
            if not e.is_file:
                yield from files(system, e.path, f"{inner}{e.base_name}/")
            elif e.base_name.endswith(suffix) and e.size != 0:  # Spark's scans have no row of an empty file
                with system.open_input_stream(e.path) as file:
                    yield inner + e.base_name, file.read()

    def run(batches):
        system, top = file_system(root)
        names = ["archive", "submission_id", "inner_path", "content"]
        held, size = [], 0
        for batch in batches:
            for archive, submission in zip(*(c.to_pylist() for c in batch.columns)):
                for inner, content in files(system, f"{top}/{archive}/{submission}"):
                    held.append((archive, submission, inner, content))
                    size += len(content)
                    if size >= BATCH_BYTES or len(held) >= LISTED:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)

    return released(run)


def _tree_of_spark(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """`read_submission_tree` by Spark's own scan, for stores that only Spark reads; the driver holds the names of all files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    # folders are listed when the scan is made: by as many tasks as shuffles have, not by one for each folder
    held = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        scan = reader.load(root)
    finally:
        spark.conf.set(LISTING_TASKS, held)
    cleaned = root.rstrip("/").rsplit("/", 1)[-1]
    inside = F.regexp_extract("path", rf"/{_quoted(cleaned)}/([^/]+)/([^/]+)/(.+)$", 3)
    return scan.select(
        F.regexp_extract("path", rf"/{_quoted(cleaned)}/([^/]+)/([^/]+)/.+$", 1).alias("archive"),
        F.regexp_extract("path", rf"/{_quoted(cleaned)}/([^/]+)/([^/]+)/.+$", 2).alias("submission_id"),
        inside.alias("inner_path"),
        F.col("content").cast("string").alias("content"),
    ).filter(F.col("inner_path") != "")


def _listed_by_tasks(root: str, suffix: str) -> bool:
    """True for a plain folder in a store that tasks can read by themselves."""
    from pyarrow import fs

    if any(c in root + suffix for c in "*?[]{}\\"):
        return False
    try:
        system, top = file_system(root)
        return system.get_file_info(top).type == fs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False


def read_submission_tree(spark: SparkSession, root: str, suffix: str = ".tex") -> DataFrame:
    """Every source file of `root/<archive>/<submission>/**`.

    Files that lie directly in an archive directory belong to no submission and are left out.  Folders are listed by
    tasks, level by level, and a submission's files by the task that reads them, so nothing holds the names of all files.
    """
    root = root.rstrip("/")
    if not _listed_by_tasks(root, suffix):
        return _tree_of_spark(spark, root, suffix)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = "folder string, name string"
    archives = spark.range(0, 1, 1, 1).select(F.lit("").alias("folder")).mapInArrow(_folders(root), listed)
    found = archives.select("name").repartition(tasks, "name").mapInArrow(_folders(root), listed)
    found = found.toDF("archive", "submission_id").repartition(tasks, "archive", "submission_id")
    read = found.mapInArrow(_contents(root, suffix), "archive string, submission_id string, inner_path string, content binary")
    return read.withColumn("content", F.col("content").cast("string"))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def output_inventory(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Ids of the files present in an output directory."""
    listing = list_objects(spark, path, suffix)
    return listing.select(stem("path").alias("submission_id"))


def mirror_inventory(
    inventory: DataFrame, folder: str, root: str = "root", folder_mime: str = C.FOLDER_MIME
) -> DataFrame:
    """Files of one named top-level folder of a landed listing, trashed ones left out.

    `inventory` has id, title, parent_id, mime_type, trashed.
    """
    live = inventory.filter(~F.col("trashed"))
    folders = live.filter(
        (F.col("parent_id") == root)
        & (F.col("title") == folder)
        & (F.col("mime_type") == folder_mime)
    ).select(F.col("id").alias("parent_id"))
    return live.join(folders, "parent_id", "left_semi")
