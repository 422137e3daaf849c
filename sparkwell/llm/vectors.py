"""What the two vector operators share: which vectors take part, and one row for each different vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null, not zero and holds no null or non-finite component."""
    value = F.col(vector)
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(value.isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists(value, lambda x: x != 0))


def digest(vector: str) -> F.Column:
    """A key for a vector's values; -0.0 counts as 0.0."""
    return F.unhex(F.md5(F.array_join(F.transform(F.col(vector), lambda x: (x + F.lit(0.0)).cast("string")), ",")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of vectors of one length, as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
