"""JSON reports of the remote system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.spec import quoted

# Texts that mark a failed report, in any case.
ERROR_MARKERS = ("errorlist", "no such view")


def is_error(text: Column) -> Column:
    low = F.lower(text)
    marks = [F.contains(low, F.lit(m)) for m in ERROR_MARKERS]
    return marks[0] | marks[1]


def report_errors(df: DataFrame, col: str) -> DataFrame:
    """Reports that came back as an error."""
    return df.filter(is_error(F.col(quoted(col))))


def infer_report_type(df: DataFrame, col: str) -> T.StructType:
    """Schema that fits all reports, found by one distributed aggregate."""
    ddl = df.agg(F.schema_of_variant_agg(F.parse_json(F.col(quoted(col)))).alias("s")).head()["s"]
    return T.DataType.fromDDL(ddl.replace("OBJECT<", "STRUCT<"))


def flatten_columns(schema: T.StructType, at: str = "", name: str = "") -> list[Column]:
    """Leaves of nested objects, named by their dotted path; arrays stay arrays."""
    out: list[Column] = []
    for f in schema.fields:
        path = f"{at}.{quoted(f.name)}" if at else quoted(f.name)
        dotted = f"{name}.{f.name}" if name else f.name
        if isinstance(f.dataType, T.StructType):
            out += flatten_columns(f.dataType, path, dotted)
        else:
            out.append(F.col(path).alias(dotted))
    return out


def flatten_report(
    df: DataFrame,
    col: str,
    key: str,
    record: T.StructType | str | None = None,
    keep: tuple[str, ...] = (),
    strict: bool = True,
) -> DataFrame:
    """One row per record of the array under ``key``, nested objects flattened.

    ``record`` is the schema of one record; without it the schema is inferred
    in a pass of its own. A report with an error marker fails the job, or with
    ``strict=False`` is left out (see ``report_errors``).
    """
    text = F.col(quoted(col))
    if isinstance(record, str):
        record = T.StructType.fromDDL(record)
    if record is None:
        clean = df.filter(~F.coalesce(is_error(text), F.lit(False)))
        record = infer_report_type(clean, col)[key].dataType.elementType
    if strict:
        failed = F.raise_error(F.concat(F.lit("report failed: "), text)).cast("string")
        text = F.when(is_error(text), failed).otherwise(text)
    else:
        df = df.filter(~is_error(text))
    body = T.StructType([T.StructField(key, T.ArrayType(record))])
    rows = df.select(
        *[F.col(quoted(k)) for k in keep],
        F.explode(F.from_json(text, body)[key]).alias("__record"),
    )
    return rows.select(*[F.col(quoted(k)) for k in keep], *flatten_columns(record, "__record"))
