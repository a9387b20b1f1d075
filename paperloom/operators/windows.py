"""Order-dependent operators: carried headers, first of a group, equalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def fill_forward(
    df: DataFrame, keys: list[str], chunk: Column, order: str, value: str, out: str
) -> DataFrame:
    """Carry the last non-null `value` down to the rows below it, per `keys`.

    `chunk` cuts each group into consecutive pieces: it must not decrease along
    the order, and rows are ordered by (chunk, order).  Pieces are filled side
    by side; only one row per piece takes part in the step that carries values
    from piece to piece, so a group of any size is spread over many tasks.
    """
    cut = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    piece_last = cut.groupBy(*keys, "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = piece_last.select(
        *keys, "_chunk", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    filled = cut.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    return (
        filled.join(carried, [*keys, "_chunk"], "left")
        .withColumn(out, F.coalesce("_own", "_carried"))
        .drop("_own", "_carried", "_chunk")
    )


def first_per_group(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group in `order`.

    An aggregate, not a window: candidates are reduced before the shuffle, so a
    large group never meets in one task.  `order` should be unique in a group.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o if isinstance(o, Column) else F.col(o) for o in order])
    chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return chosen.select(*keys, "_row.*")


def equalise(grid: DataFrame, count: str = "cnt", out: str = "shade") -> DataFrame:
    """Histogram equalisation: share of cells with a count at most this one.

    Cells are first reduced to the distinct counts, which are far fewer than the
    cells of the bounded canvas; the running sum goes over those only.
    """
    levels = grid.groupBy(count).agg(F.count("*").alias("_cells"))
    total = grid.agg(F.count("*")).scalar()
    upto = Window.orderBy(count).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shades = levels.select(count, (F.sum("_cells").over(upto) / total).alias(out))
    return grid.join(shades, count)


def linear_shade(grid: DataFrame, count: str = "cnt", out: str = "shade") -> DataFrame:
    """Counts scaled linearly to 0..1; a flat grid gives 0."""
    low, high = grid.agg(F.min(count)).scalar(), grid.agg(F.max(count)).scalar()
    span = (high - low).cast("double")
    return grid.withColumn(
        out, F.when(span == 0, F.lit(0.0)).otherwise((F.col(count) - low) / span)
    )
