"""Vector columns: which rows count, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has entries and none of them is null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def commonest_length(df: DataFrame, column: str) -> int:
    """The length that most vectors of ``column`` have, the larger of two as common; 0 for no rows."""
    sizes = df.groupBy(F.size(column).alias("length")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("length")).limit(1).first()
    return first["length"] if first else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, each of ``width`` doubles, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def blocks(rows: int, width: int, cells: int = 1 << 19):
    """(begin, end) of runs of rows that hold about ``cells`` numbers each."""
    step = max(1, cells // max(1, width))
    return ((a, min(a + step, rows)) for a in range(0, rows, step))
