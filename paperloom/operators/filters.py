"""Row filters; each is a plain predicate, so it reaches the scan where the format allows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom import constants as C
from paperloom.functions.fields import category_in, two_digit_year
from paperloom.functions.paths import member_kind
from paperloom.operators.skew import lookup


def tar_objects(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.filter(F.col(path).endswith(".tar"))


def route_members(members: DataFrame, name: str = "member_name") -> DataFrame:
    """Add `kind`: `pdf` to the side output, `gz` to unpack, `other` to ignore."""
    return members.withColumn("kind", member_kind(name))


def in_year(manifest: DataFrame, year: str, yymm: str = "yymm") -> DataFrame:
    return manifest.filter(two_digit_year(yymm, year))


def oversize(manifest: DataFrame, size: str = "size", limit: int = C.OVERSIZE_BYTES) -> DataFrame:
    return manifest.filter(F.col(size) > limit)


def of_subject(records: DataFrame, prefix: str, categories: str = "categories") -> DataFrame:
    """Records whose category string starts with the prefix."""
    return records.filter(category_in(categories, prefix))


def titles_relative_to(listing: DataFrame, target: str, direction: str = "before",
                       title: str = "title") -> DataFrame:
    """Titles strictly before or after a target in byte order."""
    if direction not in ("before", "after"):
        raise ValueError("direction is 'before' or 'after'")
    column = F.col(title)
    return listing.filter(column < target if direction == "before" else column > target)


def without_words(tokens: DataFrame, words: DataFrame, key: str = "doc_id", column: str = "tokens") -> DataFrame:
    """Remove the words of a table from token arrays, keeping repeats and order of the others.

    `words` (word) should be a stored table, as its size is looked at; it may be
    of any size.  Only distinct words of a document travel.
    """
    each = tokens.select(key, F.explode_outer(F.array_distinct(column)).alias("word")).filter(F.col("word").isNotNull())
    found = lookup(each, words.select("word").distinct(), "word", [key])
    listed = found.groupBy(key).agg(F.collect_set("word").alias("_listed"))
    kept = F.filter(column, lambda w: ~F.array_contains("_listed", w))
    return tokens.join(listed, key, "left").withColumn(
        column, F.when(F.col("_listed").isNull(), F.col(column)).otherwise(kept)).drop("_listed")


def harvest_window(records: DataFrame, spec: str | None = None, since: str | None = None) -> DataFrame:
    """Records of one set that changed on or after a day (`yyyy-MM-dd`)."""
    if spec is not None:
        records = records.filter(F.col("spec") == spec)
    if since is not None:
        records = records.filter(F.col("datestamp") >= since)
    return records
