"""Union, difference, append and upsert of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.operators.windows import first_per_group


def append_records(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name, absent ones null, nothing removed."""
    return existing.unionByName(new, allowMissingColumns=True)


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def difference(left: DataFrame, right: DataFrame, key: str, distinct: bool = True) -> DataFrame:
    """Ids of `left` that `right` does not have, as a set or with their repeats."""
    a, b = left.select(key), right.select(key)
    return a.subtract(b) if distinct else a.join(b, key, "left_anti")


def union_feeds(first: DataFrame, *others: DataFrame, once: bool = False) -> DataFrame:
    """Results of several category queries; `once` keeps one row per id."""
    whole = first
    for other in others:
        whole = whole.unionByName(other)
    return whole.dropDuplicates(["id"]) if once else whole


def latest(df: DataFrame, key: str, recency: list[str]) -> DataFrame:
    """One row per key: the most recent by `recency`, most significant first.

    Nulls count as oldest.  Rows are reduced ahead of the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*recency)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*").select(*df.columns)


def upsert(existing: DataFrame, new: DataFrame, key: str = "identifier",
           recency=("date_retrieved", "datestamp")) -> DataFrame:
    """Append, then keep the latest row of each record."""
    return latest(append_records(existing, new), key, list(recency))


__all__ = [
    "append_records", "difference", "distinct_ids", "first_per_group", "latest", "union_feeds",
    "upsert",
]
