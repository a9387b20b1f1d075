"""Tabular scans: metadata and subject CSV, layouts, word lists, stored models."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom import schemas as S
from paperloom.sources.csv_splits import csv_records

# Abstracts hold newlines and quotes: fields are quoted, quotes are doubled.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_records_csv(spark: SparkSession, path: str, split: bool = True) -> DataFrame:
    """Metadata CSV with every id a string and a parsed retrieval time.

    Columns are matched by name, file by file, so a folder may hold several column orders.  A file is read by many tasks,
    line ends in its fields notwithstanding (`paperloom.sources.csv_splits`); with `split=False` by one, which also takes
    quotes inside fields that are not quoted.
    """
    if not split:
        return _read_whole(spark, path)
    records = csv_records(spark, path)
    headers = [r.header for r in records.select("header").distinct().collect()]  # no more than there are column orders
    if not headers:
        return spark.createDataFrame([], S.RECORDS)
    row = reduce(lambda other, h: F.when(F.col("header") == h, _fields(h)).otherwise(other), headers, F.lit(None))
    return records.select(row.alias("r")).select(
        *(F.col("r")[f.name].cast(f.dataType).alias(f.name) for f in S.RECORDS))


def _fields(header: str):
    """The record fields of a text below a header, as a struct of strings."""
    names = next(csv.reader([header]))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("text", schema, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    # inside a lambda the text is parsed once for all fields
    return F.transform(F.array(parsed), lambda r: F.struct(
        *((r[f.name] if f.name in names else F.lit(None).cast("string")).alias(f.name) for f in S.RECORDS)))[0]


def _read_whole(spark: SparkSession, path: str) -> DataFrame:
    """Files one by one, in groups of equal header lines."""
    heads = (
        spark.read.option("wholetext", False).text(path)
        .filter(F.col("_metadata.file_block_start") == 0)
        .select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"), "value")
        .groupBy("file").agg(F.min_by("value", "line").alias("header"))
        .groupBy("header").agg(F.collect_list("file").alias("files"))
    )
    groups = heads.collect()  # a listing of the files, as Spark itself keeps one
    if not groups:
        return spark.createDataFrame([], S.RECORDS)
    return reduce(DataFrame.unionByName, [_records_of(spark, g["files"]) for g in groups])


def _records_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one column order."""
    raw = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(paths)
    have = set(raw.columns)
    return raw.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.RECORDS
    ])


def read_identifiers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Only the compact ids; other columns are pruned in the scan."""
    records = read_records_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return records.select("filename_parsed")


def read_subjects(spark: SparkSession, path: str) -> DataFrame:
    """Subject CSV: text length, submission id, main subject, all subjects."""
    return (
        spark.read.schema(S.SUBJECTS).option("header", True).option("enforceSchema", True).csv(path)
    )


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated coordinates below one header row that is skipped."""
    return (
        spark.read.schema(S.LAYOUT)
        .options(sep=" ", header="true", enforceSchema="true")
        .csv(path)
    )


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of strings -> one word per row."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>")).alias("word")).distinct()


def load_stopwords(spark: SparkSession, path: str) -> list[str]:
    """A stop list as literals for `drop_stopwords`.

    For a list too long to be part of an expression, pass `read_word_list` to
    `paperloom.operators.filters.without_words`.
    """
    return sorted(row.word for row in read_word_list(spark, path).collect())


def read_token_document(spark: SparkSession, path: str, doc_id: str) -> DataFrame:
    """Tokens of one document; the id filter reaches the Parquet scan."""
    return spark.read.parquet(path).filter(F.col("doc_id") == doc_id)


def read_matrix_market(spark: SparkSession, path: str, sized: bool = True) -> DataFrame:
    """Coordinate text of a document-term matrix -> (doc, term_id, cnt), 0-based.

    The `body` folder of `write_matrix_market` has no size line: `sized=False`.
    Comment lines start with `%`.  The size line is told from the entries by
    being the first line of the file that is not a comment: it is the only one
    at the lowest position, found by an aggregate and not by a driver-side read.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("value"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("at"),
        )
        .filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
    )
    parts = F.split(F.trim("value"), r"\s+")
    if sized:
        lines = lines.filter(F.col("at") > lines.agg(F.min("at")).scalar())
    return lines.select(
        (parts[0].cast("bigint") - 1).alias("doc"),
        (parts[1].cast("bigint") - 1).alias("term_id"),
        parts[2].cast("double").cast("bigint").alias("cnt"),
    )
