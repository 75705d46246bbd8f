"""Whole-frame cleaning: one ``select`` over all columns per step."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.functions import cells
from tallyloom.spec import quoted


def each_text(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Apply a cell expression to every text column."""
    out = []
    for f in df.schema.fields:
        name = quoted(f.name)
        out.append(f"{fn(name)} AS {name}" if isinstance(f.dataType, T.StringType) else name)
    return df.selectExpr(*out)


def null_tokens(df: DataFrame, tokens: Sequence[str] = cells.NULL_TOKENS) -> DataFrame:
    return each_text(df, lambda c: cells.null_token(c, tokens))


def strip_chars(df: DataFrame, chars: str = cells.STRIPPED_CHARS) -> DataFrame:
    return each_text(df, lambda c: cells.strip_chars(c, chars))


def strip_literal(df: DataFrame, text: str = cells.STRIPPED_LITERAL) -> DataFrame:
    return each_text(df, lambda c: cells.strip_literal(c, text))


def clean_extract(df: DataFrame) -> DataFrame:
    """Null tokens, then deleted characters, then the deleted text, per cell."""
    return each_text(df, cells.clean_cell)
