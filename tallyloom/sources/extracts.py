"""Text extracts and what is done before they are conformed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_extract(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    multiline: bool = True,
) -> DataFrame:
    """CSV with a header, every column text.

    The files of one call must agree on their header (checked per file); read
    fragments with different headers one by one and use ``union_fragments``.
    Quoted line breaks need ``multiline``, which makes a file one task: land
    large extracts as many files, or turn it off where cells hold no breaks.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("inferSchema", False)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )


def union_fragments(fragments: Sequence[DataFrame]) -> DataFrame:
    """Append fragments by column name; a column a fragment lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fragments)


def lookback_start(as_of: datetime, days: int) -> date:
    """First day of a rolling pull: whole days before the day of ``as_of``."""
    return (as_of - timedelta(days=days)).date()


def lookback(df: DataFrame, ts_col: str, days: int, as_of: datetime) -> DataFrame:
    """Rows of the last ``days`` days. The bound is a literal, so it reaches the scan."""
    start = datetime.combine(lookback_start(as_of, days), datetime.min.time())
    return df.filter(F.col(ts_col) >= _typed(df, ts_col, start))


def _typed(df: DataFrame, column: str, value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[column].dataType)


def has_rows(df: DataFrame) -> bool:
    """An empty extract leaves its core table as it is."""
    return not df.isEmpty()


def report_table(df: DataFrame, ts_col: str, since: str) -> DataFrame:
    """Rows after ``since``, newest first, blanks for missing texts."""
    bound = F.lit(since).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) > bound).orderBy(F.col(ts_col).desc()).fillna("")
