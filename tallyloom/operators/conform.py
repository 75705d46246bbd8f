"""From provider columns to the canonical schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import cells
from tallyloom.spec import Field, Provider, quoted


def source_column(headers: Sequence[str], source: str) -> Column | None:
    """Expression of a mapped source: a header, ``a+b`` or ``a|b``; None if absent.

    A header that arrives as it is written wins over its reading as a join. A
    join with a missing part fails, since half a value would overwrite a whole one.
    """
    if source in headers:
        return F.col(quoted(source))
    for mark, sep in (("+", " "), ("|", "")):
        if mark in source:
            parts = source.split(mark)
            missing = [p for p in parts if p not in headers]
            if missing:
                raise ValueError(f"source {source!r} lacks {missing}")
            return cells.concat_cols([F.col(quoted(p)) for p in parts], sep)
    return None


def project_mapping(
    df: DataFrame, fields: Sequence[Field], provider: str, geo_parity: bool = False
) -> DataFrame:
    """Rename, join and pick the mapped columns that arrived, in one ``select``.

    One source may feed several targets; unmapped columns fall away.
    """
    headers = df.columns
    out = []
    for f in fields:
        c = source_column(headers, f.sources[provider])
        if c is None:
            continue
        if f.type == "GEOGRAPHY":
            c = cells.lnglat_text(c, geo_parity)
        out.append(c.alias(f.name))
    return df.select(*out)


def stamp_source(df: DataFrame, provider: Provider) -> DataFrame:
    return df.withColumns(
        {
            "external_sys": F.lit(provider.name),
            "organization": F.lit(provider.organization),
            "country": F.lit(provider.country),
        }
    )


def filled_columns(df: DataFrame) -> list[str]:
    """Columns with at least one value: one aggregate, one row back."""
    names = df.columns
    counts = df.agg(*[F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in names]).head()
    return [c for c, n in zip(names, counts) if n > 0]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[quoted(c) for c in filled_columns(df)])


def typed(f: Field, strict: bool = True) -> Column:
    """Cast a staged text to the declared type; ``strict`` fails on a bad value."""
    c = F.col(quoted(f.name))
    if f.type == "TEXT":
        return c
    if f.type == "GEOGRAPHY":
        return (cells.point(c) if strict else cells.try_point(c)).alias(f.name)
    if f.type == "BOOLEAN":
        return cells.boolean_text(c, strict).alias(f.name)
    cast = "cast" if strict else "try_cast"
    return F.expr(f"{cast}({quoted(f.name)} AS {f.spark_type}) AS {quoted(f.name)}")


def typed_select(df: DataFrame, fields: Sequence[Field], strict: bool = True) -> DataFrame:
    """The staged columns the mapping knows, with their declared types."""
    known = {f.name: f for f in fields}
    return df.select(*[typed(known[c], strict) for c in df.columns if c in known])


def bad_casts(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Staged rows with a value that its declared type refuses, for quarantine."""
    known = [f for f in fields if f.name in df.columns and f.type != "TEXT"]
    refused = [F.col(quoted(f.name)).isNotNull() & _untyped(f).isNull() for f in known]
    return df.filter(reduce(Column.__or__, refused, F.lit(False)))


REFUSED = "__refused"


def refused_cells(df: DataFrame, fields: Sequence[Field]) -> Column:
    """Cells of a staged row that their declared type refuses, as array<struct<column, value, type>>.

    Null where there are none, so that rows can be told apart by the column alone.
    """
    kind = "array<struct<column:string,value:string,type:string>>"
    cells_ = [
        F.when(
            F.col(quoted(f.name)).isNotNull() & _untyped(f).isNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(quoted(f.name)).alias("value"), F.lit(f.type).alias("type")),
        )
        for f in fields
        if f.name in df.columns and f.type != "TEXT"
    ]
    if not cells_:
        return F.lit(None).cast(kind)
    found = F.array_compact(F.array(*cells_)).cast(kind)
    return F.when(F.size(found) > 0, found)


def _untyped(f: Field) -> Column:
    """The value of a staged text, or null where a strict cast would fail."""
    c = F.col(quoted(f.name))
    if f.type == "GEOGRAPHY":
        return cells.try_point(c)
    return cells.boolean_text(c, strict=False) if f.type == "BOOLEAN" else c.try_cast(f.spark_type)


def delivered_columns(
    columns: Sequence[str], fields: Sequence[Field], remote_id: str = "remote_id"
) -> list[str]:
    """Delivered columns as SQL: instants without zone, the remote identifier as ``ID``."""
    out = []
    for f in fields:
        if f.name not in columns:
            continue
        c = quoted(f.name)
        value = f"cast({c} AS timestamp_ntz)" if f.type == "TIMESTAMPTZ" else c
        out.append(f"{value} AS {'ID' if f.name == remote_id else c}")
    return out


def outbound_select(
    df: DataFrame, fields: Sequence[Field], remote_id: str = "remote_id"
) -> DataFrame:
    return df.selectExpr(*delivered_columns(df.columns, fields, remote_id))
