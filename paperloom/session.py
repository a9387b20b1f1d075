"""Session defaults and reliable checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Defaults a session gets unless the caller names other values.  Partition
# counts are left to adaptive execution: start from many small shuffle
# partitions and let it merge them to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents and archive members vary from bytes to hundreds of megabytes,
    # so an Arrow batch is bounded by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def build_session(app_name="paperloom", master=None, shuffle_partitions=None, conf=None):
    """A SparkSession with the defaults above; `conf` entries win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    A machine-local folder is used only where the setting is absent and the
    session itself is local; on a cluster an absent setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="paperloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a stage table below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{os.urandom(6).hex()}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context.

    Needed where it is not installed on the executors, like --py-files.
    """
    context = spark.sparkContext
    if getattr(context, "_paperloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="paperloom-package-"), "paperloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._paperloom_shipped = True


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once below the shared folder and read it back.

    For tables used several times: the lineage is cut, columns are pruned at
    each use, and the file sizes let Spark choose joins by what is really there.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def staged_by(df: DataFrame, key: str, name: str = "stage", buckets: int | None = None) -> DataFrame:
    """`staged`, dealt into buckets by `key` and sorted in them, so that what is grouped by the key later meets these rows in place.

    For tables with wide rows, such as token arrays: they are shuffled once, when they are stored, or not at all if they are
    dealt by the key already.  There are as many buckets as shuffle partitions unless `buckets` says otherwise.  The table
    is external, in the session's catalogue under a name of its own.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = os.path.basename(path).replace("-", "_")
    df.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def run_tasks(df: DataFrame) -> None:
    """Run tasks that leave files of their own; their rows go nowhere."""
    df.write.format("noop").mode("overwrite").save()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stage table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
