"""Points binned into a pixel grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.operators.topk import keep_top_values
from paperloom.operators.windows import equalise, linear_shade

WIDTH = HEIGHT = 500


def _pixel(value: str, low: Column, high: Column, pixels: int) -> Column:
    span = high - low
    at = F.floor((F.col(value) - low) / span * pixels)
    return F.when(span == 0, F.lit(0)).otherwise(F.least(at, F.lit(pixels - 1))).cast("int")


def pixels(points: DataFrame, x: str = "x", y: str = "y", width: int = WIDTH,
           height: int = HEIGHT) -> DataFrame:
    """Points with their pixel (px, py) on a canvas from the least to the largest value.

    The largest value falls in the last pixel.  Points without both coordinates
    are left out.
    """
    whole = points.filter(
        F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    )
    box = whole.agg(
        F.struct(
            F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
        )
    ).scalar()
    return whole.withColumn("_box", box).withColumns({
        "px": _pixel(x, F.col("_box.x0"), F.col("_box.x1"), width),
        "py": _pixel(y, F.col("_box.y0"), F.col("_box.y1"), height),
    }).drop("_box")


def grid_counts(points: DataFrame, width: int = WIDTH, height: int = HEIGHT, x: str = "x",
                y: str = "y") -> DataFrame:
    """(px, py, cnt) of the pixels that hold points."""
    return pixels(points, x, y, width, height).groupBy("px", "py").agg(F.count("*").alias("cnt"))


def grid_by_category(points: DataFrame, category: str = "category", top: int | None = None,
                     width: int = WIDTH, height: int = HEIGHT, x: str = "x", y: str = "y") -> DataFrame:
    """(px, py, category, cnt), optionally for the most frequent categories only.

    Restricting comes first, so the canvas spans the points that are left.
    """
    kept = points if top is None else keep_top_values(points, category, top)
    binned = pixels(kept, x, y, width, height)
    return binned.groupBy("px", "py", category).agg(F.count("*").alias("cnt"))


def category_index(points: DataFrame, category: str = "category") -> DataFrame:
    """Sorted distinct categories numbered from 0, one per colour."""
    from paperloom.operators.indexing import dense_index

    distinct = points.select(category).filter(F.col(category).isNotNull()).distinct()
    return dense_index(distinct, [category], "category_index")


__all__ = [
    "category_index", "equalise", "grid_by_category", "grid_counts", "linear_shade", "pixels",
]
