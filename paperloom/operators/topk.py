"""Sorted reports and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom import constants as C
from paperloom.functions.fields import has_preamble
from paperloom.functions.paths import base_name
from paperloom.operators.windows import first_per_group


def sort_by_title(listing: DataFrame, title: str = "title") -> DataFrame:
    return listing.orderBy(title)


def by_count(counts: DataFrame, key: str, count: str = "cnt") -> DataFrame:
    """Most frequent first, ties by key."""
    return counts.orderBy(F.desc(count), F.asc(key))


def first_rows(df: DataFrame, n: int = 1) -> DataFrame:
    return df.limit(n)


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The n most frequent values, ties by value; nulls are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc(column)).limit(n)


def keep_top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """Rows whose value is among the n most frequent; at most n rows are broadcast."""
    return df.join(F.broadcast(top_values(df, column, n).select(column)), column, "left_semi")


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The k first rows of each group with their rank, a total order assumed.

    Spark cuts each map output to k rows per group ahead of the shuffle as long
    as k is below spark.sql.optimizer.windowGroupLimitThreshold.  Beyond it the
    same cut is made here per (group, salt), so large groups are still spread.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        pre = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_pre", F.row_number().over(pre))
            .filter(F.col("_pre") <= k).drop("_pre", "_salt")
        )
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def main_files(
    files: DataFrame, key: str = "submission_id", path: str = "inner_path",
    content: str = "content", strict: bool = False,
) -> DataFrame:
    """Main source file of each submission, null path where none qualifies.

    A single file is the main file.  Otherwise the preferred names win in their
    order, then the first file (by path) with a preamble.  Content is reduced to
    one flag in the scan stage, so it is not shuffled.
    """
    names = C.MAIN_FILE_NAMES
    priority = F.lit(None).cast("int")
    priority = F.when(has_preamble(content, strict), F.lit(len(names))).otherwise(priority)
    for rank, wanted in reversed(list(enumerate(names))):
        priority = F.when(base_name(path) == wanted, F.lit(rank)).otherwise(priority)
    flagged = files.select(key, F.col(path).alias("path"), priority.alias("priority"))
    best = F.min(F.when(F.col("priority").isNotNull(), F.struct("priority", "path")))
    grouped = flagged.groupBy(key).agg(
        F.count("*").alias("files"), best.alias("best"), F.min("path").alias("only")
    )
    return grouped.select(
        key, "files",
        F.when(F.col("files") == 1, F.col("only")).otherwise(F.col("best.path")).alias("main_path"),
    )


def submission_status(main: DataFrame, submissions: DataFrame, key: str = "submission_id") -> DataFrame:
    """Status of every submission: `preprint`, `corrupt` (no main file) or `empty`."""
    return submissions.select(key).distinct().join(main, key, "left").select(
        key,
        F.coalesce("files", F.lit(0)).alias("files"),
        "main_path",
        F.when(F.col("files").isNull(), "empty")
        .when(F.col("main_path").isNull(), "corrupt")
        .otherwise("preprint").alias("status"),
    )


def submission_counters(status: DataFrame) -> DataFrame:
    """One row: source files, submissions, preprints, empty and corrupt ones."""
    return status.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("tex_files"),
        F.count("*").alias("submissions"),
        F.count_if(F.col("status") == "preprint").alias("preprints"),
        F.count_if(F.col("status") == "empty").alias("empty"),
        F.count_if(F.col("status") == "corrupt").alias("corrupt"),
    )


__all__ = [
    "by_count", "first_per_group", "first_rows", "keep_top_values", "main_files",
    "sort_by_title", "submission_counters", "submission_status", "top_k_per_group", "top_values",
]
