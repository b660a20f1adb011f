"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortloom.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """A text column without nulls: null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not hold, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """mapInArrow with this package importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, size: int
) -> Iterator[pa.RecordBatch]:
    """Cut record batches where the bytes of a text column pass `size`.

    A row is never cut, so one long text makes a slice of its own.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(column))
        lengths = np.asarray(lengths.fill_null(0), dtype=np.int64)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a well mixed 64-bit value for each input value."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))
