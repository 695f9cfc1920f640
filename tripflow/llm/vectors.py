"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def doubles(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("array<double>"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """An Arrow column of equally long vectors as rows of doubles."""
    return np.array(column.to_pylist(), float).reshape(len(column), -1)
