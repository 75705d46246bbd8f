"""Counts joined back, and new members of reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.lookup import lookup
from tallyloom.operators.upsert import lacking
from tallyloom.spec import quoted


def count_fill(
    df: DataFrame,
    facts: DataFrame,
    key: str,
    out: str,
    when: Column,
    row_key: Sequence[str] = (),
) -> DataFrame:
    """Number of ``facts`` per key, 0 where there are none, on rows that pass ``when``.

    Facts are counted before they are shuffled or joined.
    """
    counts = facts.groupBy(F.col(quoted(key)).alias(key)).agg(F.count(F.lit(1)).alias("__n"))
    kind = df.schema[out].dataType if out in df.columns else "bigint"
    zeroed = F.when(when, F.lit(0).cast(kind)).otherwise(
        F.col(quoted(out)) if out in df.columns else F.lit(None)
    )
    return lookup(
        df.withColumn(out, zeroed), counts, {key: key}, {out: "__n"}, when=when, row_key=row_key
    )


def new_members(
    dim: DataFrame, sources: Sequence[DataFrame], key: str, set: Mapping[str, str]
) -> DataFrame:
    """``dim`` plus one row for each value of ``key`` that it lacks.

    ``set`` maps columns of ``dim`` to source columns determined by the key.
    Sources that would be inserted one after the other, each seeing the previous
    insert, are the same as their distinct union.
    """
    cols = [F.col(quoted(src)).alias(dst) for dst, src in set.items()]
    given = [s.filter(F.col(quoted(key)).isNotNull()).select(*cols) for s in sources]
    found = reduce(DataFrame.unionAll, given).distinct()
    target = next(dst for dst, src in set.items() if src == key)
    return dim.unionByName(lacking(found, target, dim, target), allowMissingColumns=True)


def new_member_pairs(
    dim: DataFrame, sources: Sequence[DataFrame], key: str, columns: Sequence[str]
) -> DataFrame:
    """``dim`` plus distinct rows of ``columns`` whose ``key`` alone it lacks.

    A new key that comes with two partners adds two rows. Sources are inserted one
    after the other, so of several that bring a new key the first one counts.
    """
    if not sources:
        return dim
    given = [
        s.filter(F.col(quoted(key)).isNotNull()).select(
            *[F.col(quoted(c)) for c in columns], F.lit(number).alias("__source")
        )
        for number, s in enumerate(sources)
    ]
    # distinct before the window, so a key holds its partners and not its rows
    rows = reduce(DataFrame.unionAll, given).distinct()
    earliest = F.min("__source").over(Window.partitionBy(F.col(quoted(key))))
    found = rows.withColumn("__first", earliest).where("__source = __first").drop("__source", "__first")
    return dim.unionByName(lacking(found, key, dim, key), allowMissingColumns=True)
