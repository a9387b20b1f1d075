"""CSV whose quoted fields hold line ends, read by many tasks.

Whether a line end lies in a quoted field depends on the quotes before it, in the whole file.  Quotes are counted for each
split of a file first; the parity of all earlier splits, a running sum over one row per split, then tells every task
whether its split begins inside a field.  Each task puts its lines together to records.  Only the record that crosses the
border of a split is cut in pieces; these few are joined by their place.

A quote stands only at the ends of a quoted field, or doubled inside one, as the writers of this package and RFC 4180 have it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paperloom.session import staged

ROWS = 2000


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def open_splits(lines: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin inside a quoted field."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return odd.withColumn("before", before).filter("before % 2 = 1").select("file", "block")


def csv_pieces(spark: SparkSession, path) -> DataFrame:
    """(file, block, kind, text): whole records and, at the borders of splits, pieces of them.

    Kinds: `header` is the first record of a file, `record` a whole one; `tail` begins in its split and goes on, `head` ends one
    that began earlier, `middle` does neither.
    """
    lines = _lines(spark, path)
    inside = {(r.file, r.block) for r in open_splits(lines).collect()}  # no more than the splits of the scan

    def run(batches):
        names, out = ["file", "block", "kind", "text"], []
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

        def piece(kind):
            out.append((*place, kind, "\n".join(held)))
            held.clear()

        place, held, quoted, begun, first = None, [], False, True, False
        for batch in batches:
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, block) != place:
                    if held:
                        piece("tail" if begun else "middle")
                    place, quoted = (file, block), (file, block) in inside
                    begun, first = not quoted, block == 0
                held.append(value)
                quoted ^= value.count('"') % 2 == 1
                if not quoted:
                    if held == [""] or held == ["\r"]:
                        held.clear()
                        continue
                    piece("head" if not begun else "header" if first else "record")
                    begun, first = True, False
                if len(out) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out.clear()
        if held:
            piece("tail" if begun else "middle")
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return lines.mapInArrow(run, "file bigint, block bigint, kind string, text string")


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(file, header, text): the records of CSV files below `path`, each with the header record of its file."""
    pieces = staged(csv_pieces(spark, path), "csv")
    cut = pieces.filter(F.col("kind").isin("tail", "middle", "head"))
    # Pieces come by split, the end of one record ahead of the beginning of the next: a record's pieces begin with a tail.
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == "tail")
    numbered = cut.withColumn("at", F.row_number().over(order)).withColumn("record", F.count_if(F.col("kind") == "tail").over(order))
    joined = numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "\n").alias("text"))
    whole = pieces.filter("kind = 'record'").select("file", "text").unionByName(joined.select("file", "text"))
    heads = pieces.filter("kind = 'header'").select("file", _ended("text").alias("header"))
    return whole.join(heads, "file").select("file", "header", _ended("text").alias("text"))


def _ended(text):
    """A record without the first half of a two-character line end."""
    return F.regexp_replace(text, "\r$", "")
