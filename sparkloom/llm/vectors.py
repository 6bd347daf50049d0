"""Rows of vectors: which take part, and arrays of them in one binary value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def id_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Only usable rows with an id: vec_id (long), vector (doubles), width."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("width", F.size("vector"))
