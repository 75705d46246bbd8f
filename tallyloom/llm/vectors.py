"""What the operators on vectors share: which rows take part, and blocks of rows as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""

    def sound(x: Column) -> Column:
        number = x.cast("double")
        return x.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))

    return F.coalesce(F.forall(vector, sound), F.lit(False))


def dimension(rows: DataFrame, vector: str) -> int:
    """The number of components most rows have; of several such numbers the smallest, 0 without rows."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return 0 if first is None else int(first["size"])


def matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind=np.float64) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dim)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined, and cut, into tables of ``rows`` rows; the last may be shorter."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - size)
            batch = batch.slice(part.num_rows)
            held.append(part)
            size += part.num_rows
            if size == rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def sampled(rows: DataFrame, total: int, size: int) -> DataFrame:
    """At most ``size`` of about ``total`` rows, by ``order``, an even hash that differs from row to row.

    Rows are thinned out before they are ordered, so that no task sees many more than ``size``.
    """
    share = min(1.0, 1.25 * size / max(total, 1) + 1e-6)
    few = rows.where(F.pmod("order", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return few.orderBy("order").limit(size)
