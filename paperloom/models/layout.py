"""2-D layouts of vectors."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F


def fit_layout(vectors: DataFrame, vector: str = "vector") -> PCAModel:
    """Principal axes of the vectors; the covariance is width x width, whatever the row count."""
    dense = vectors.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return PCA(k=2, inputCol="features", outputCol="xy").fit(dense)


def layout(vectors: DataFrame, key: str = "doc_id", vector: str = "vector",
           model: PCAModel | None = None) -> DataFrame:
    """(key, x, y): vectors projected on their two principal axes."""
    fitted = model or fit_layout(vectors, vector)
    dense = vectors.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    xy = vector_to_array("xy")
    return fitted.transform(dense).select(key, xy[0].alias("x"), xy[1].alias("y"))
