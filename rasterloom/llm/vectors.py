"""What the two embedding operators share: which vectors count, and their arrays in a task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor empty nor all zeros and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    """The rows of a column of equally long vectors, in double precision."""
    return np.stack(vectors.to_list()).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
