"""Vector columns as rows of numbers: which ones count, and dense matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def finite_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows whose vector is there and all finite."""
    plain = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return plain.where(F.col("vector").isNotNull() & good)


def dense(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A matrix with a row per list of ``column``; entries a list doesn't have are 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    most = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == most).all():
        return flat.reshape(len(lengths), most)
    matrix = np.zeros((len(lengths), most), flat.dtype)
    matrix[np.arange(most) < lengths[:, None]] = flat
    return matrix
