"""Python tasks that hold few rows at a time and give memory back at their end."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

AT_ONCE = 256


def let_go() -> None:
    """Gives a Python worker's unused memory back at the end of a task, as workers stay for other work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_slices(df: DataFrame, of: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = AT_ONCE) -> DataFrame:
    """df.mapInPandas(of, schema), with frames of at most ``rows`` rows: Arrow's batches, of 10,000 wide rows, are never frames."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(k, rows).to_pandas() for b in batches for k in range(0, b.num_rows, rows))
        for frame in of(slices):
            yield pa.RecordBatch.from_pandas(frame, schema=out, preserve_index=False)
        let_go()

    return df.mapInArrow(run, schema)
