"""Dense integer ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paperloom.session import staged

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number here


def dense_index(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Number the rows start, start+1, ... in `order`, which must be unique.

    Rows are range partitioned and sorted; each is written with its partition
    and its place there, so these no longer change if a task is run again.  The
    offset of a partition comes from one count per partition, the only thing
    broadcast.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ordered.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"),
    ), "index")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(start))
        .drop("_part", "_row", "_offset")
    )
