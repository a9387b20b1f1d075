"""Counts, totals, ranges and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom import constants as C
from paperloom.functions.fields import category_list, first_category, gigabytes, megabytes
from paperloom.operators.filters import in_year, of_subject


def size_totals(manifest: DataFrame, size: str = "size") -> DataFrame:
    """Number of files and their total in GB."""
    return manifest.agg(
        F.count("*").alias("files"), gigabytes(F.sum(size)).alias("total_gb")
    )


def year_totals(manifest: DataFrame, year: str, yymm: str = "yymm", size: str = "size") -> DataFrame:
    """Number of files of one two-digit year and their unrounded total in GB."""
    return in_year(manifest, year, yymm).agg(
        F.count("*").alias("files"),
        gigabytes(F.coalesce(F.sum(size), F.lit(0)), None).alias("total_gb"),
    )


def time_range(manifest: DataFrame, ts: str = "timestamp", pattern: str = "MM/dd/yyyy") -> DataFrame:
    """Oldest and newest time, formatted."""
    return manifest.agg(
        F.date_format(F.min(ts), pattern).alias("oldest"),
        F.date_format(F.max(ts), pattern).alias("newest"),
    )


def oversize_totals(manifest: DataFrame, size: str = "size", limit: int = C.OVERSIZE_BYTES) -> DataFrame:
    """Number of files above the limit, and the largest size in MB."""
    return manifest.agg(
        F.count_if(F.col(size) > limit).alias("oversize"),
        megabytes(F.max(size)).alias("max_mb"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def high_water(records: DataFrame, column: str = "date_retrieved") -> DataFrame:
    """Latest retrieval time: where an incremental harvest goes on."""
    return records.agg(F.max(column).alias("high_water"))


def category_counts(records: DataFrame, categories: str = "categories") -> DataFrame:
    """Records per category, counting every category of a record."""
    each = records.select(F.explode(category_list(categories)).alias("category"))
    return each.groupBy("category").agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "category"
    )


def primary_category_counts(records: DataFrame, categories: str = "categories") -> DataFrame:
    """Records per first category."""
    first = records.select(first_category(categories).alias("category"))
    return first.groupBy("category").agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "category"
    )


def distinct_categories(records: DataFrame, categories: str = "categories") -> DataFrame:
    """Number of different categories, over all and over first ones."""
    each = records.select(
        F.explode(category_list(categories)).alias("category"),
        first_category(categories).alias("first"),
    )
    return each.agg(
        F.count_distinct("category").alias("categories"),
        F.count_distinct("first").alias("primary_categories"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    kept = df.filter(F.col(column).isNotNull())
    return kept.groupBy(column).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), column)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row."""
    return df.groupBy(key).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def subject_size(records: DataFrame, prefix: str, categories: str = "categories") -> DataFrame:
    """Number of records of one subject."""
    return of_subject(records, prefix, categories).agg(F.count("*").alias("cnt"))


def harvest_progress(records: DataFrame, tokens: DataFrame) -> DataFrame:
    """Records obtained against the announced list size."""
    announced = tokens.agg(F.max("complete_list_size")).scalar()
    return records.agg(F.count("*").alias("obtained")).select(
        "obtained",
        announced.alias("announced"),
        (F.col("obtained") == announced).alias("complete"),
    )


def same_size(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two tables and whether they agree."""
    other = right.agg(F.count("*")).scalar()
    return left.agg(F.count("*").alias("left_rows")).select(
        "left_rows", other.alias("right_rows"), (F.col("left_rows") == other).alias("same")
    )


def joined_text(parts: DataFrame, key: str, position: str, text: str, separator: str = "") -> DataFrame:
    """Text pieces of each document, put together in order of their position."""
    ordered = F.array_sort(F.collect_list(F.struct(position, text)))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda p: p[text]), separator).alias("text")
    )
