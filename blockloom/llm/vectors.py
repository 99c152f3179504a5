"""Rows of vectors that operators can compute on, as matrices in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(vectors: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """`columns` and embedding of the rows whose vector is present, with all components present and finite, and the length
    of these vectors. Vectors of another length than most can't be compared with the rest and are left out (of equally
    frequent lengths the shorter counts)."""
    wide = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = vectors.select(*columns, F.col("embedding").cast(f"array<{wide}>").alias("embedding")).where("embedding is not null")
    fine = v.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    most = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()  # one row a length
    d = most["d"] if most else 0
    return fine.where(F.size("embedding") == d), d


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A batch of vectors as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)
