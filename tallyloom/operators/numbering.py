"""Dense row numbers over a whole table, without one task sorting it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import freeze
from tallyloom.spec import quoted

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def number_rows(df: DataFrame, order: Sequence[str], out: str, start: int = 0) -> DataFrame:
    """Number rows ``start``, ``start + 1``, .. in the order of ``order``.

    Rows are range-partitioned and sorted within their partition, which gives
    each its place there; the place of the partition is the sum of the sizes
    before it, from one small row per partition. Range bounds are sampled, so
    places are frozen in a table before the sizes are taken. Name a unique
    column last in ``order``: it lets a heavy value of the first one be split.
    """
    cols = [F.col(quoted(c)) for c in order]
    placed = freeze(
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("__place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("__place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # One row per shuffle partition: the size is bounded by the partition count.
    joined = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = (F.col("__offset") + row + F.lit(start)).cast("bigint")
    return joined.withColumn(out, number).drop("__part", "__place", "__offset")


def assign_batches(
    df: DataFrame, order: Sequence[str], size: int, out: str = "batch_id"
) -> DataFrame:
    """Cut rows, in order, into batches of ``size``; only the last may be shorter."""
    numbered = number_rows(df, order, "__row")
    return numbered.withColumn(out, F.expr(f"__row div {size}")).drop("__row")


def assign_serials(df: DataFrame, column: str, order: Sequence[str], after: int) -> DataFrame:
    """Give rows the next serial numbers after ``after``, in order."""
    base = df.drop(column) if column in df.columns else df
    return number_rows(base, order, column, start=after + 1)
