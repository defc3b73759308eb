"""Arrow helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows handed to a Python loop at a time; texts differ in length by a factor of 10,000.
SLICE_ROWS = 256
# Bytes of an Arrow batch: the default row limit alone lets a batch of long texts fill a worker.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, its session with Arrow batches of ``BATCH_BYTES``, unless the session has a limit of its own."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterable[tuple]]]) -> DataFrame:
    """``mapInArrow`` for functions from a batch to tuples.

    ``make`` is called once in each task, for caches and tables that go with the task.
    Batches are cut to ``SLICE_ROWS`` rows, so what one call builds stays small.
    """
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        batch = rows = columns = None
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = list(fn(batch.slice(start, SLICE_ROWS)))
                if rows:
                    columns = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                    )
        del fn, batch, rows, columns
        give_back()

    return bound_batches(df).mapInArrow(run, schema)


def text_struct(text: Column, schema: str, make: Callable[[], Callable[[str], tuple]]) -> Column:
    """A struct column from each text, made in Arrow batches; null text as empty."""
    kind = T._parse_datatype_string(schema)
    names = kind.names

    @F.pandas_udf(kind)
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fn = make()
        for s in series:
            yield pd.DataFrame([fn(t or "") for t in s], columns=names)
        give_back()

    return run(text)
