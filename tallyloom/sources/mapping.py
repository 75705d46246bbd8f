"""The mapping file: one row per canonical column."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyloom.spec import Field, Mapping

MAX_ROWS = 100_000


def read_mapping(
    spark: SparkSession,
    path: str,
    canonical: str = "canonical",
    outbound: str = "outbound",
    surrogate: str = "pk",
    business_key: str = "update_on",
) -> Mapping:
    """Read a mapping CSV into the driver-side spec.

    Columns: ``table``, the canonical name, ``type``, one column per provider
    (the remaining ones) and the three flags. The header names of the canonical
    column and of the flags are parameters. A mapping is configuration: a file
    beyond ``MAX_ROWS`` rows is refused rather than pulled to the driver.
    """
    rows = spark.read.option("header", True).csv(path).limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"{path} has more than {MAX_ROWS} rows: not a mapping")
    if not rows:
        raise ValueError(f"{path} is empty")
    known = {"table", canonical, "type", outbound, surrogate, business_key}
    providers = [c for c in rows[0].asDict() if c not in known]

    def flag(row, name: str) -> bool:
        return bool(row[name]) and float(row[name]) == 1

    return Mapping(
        tuple(
            Field(
                table=row["table"].strip(),
                name=row[canonical].strip(),
                type=row["type"].strip(),
                sources={p: row[p].strip() for p in providers if row[p] and row[p].strip()},
                business_key=flag(row, business_key),
                outbound=flag(row, outbound),
                surrogate=flag(row, surrogate),
            )
            for row in rows
        )
    )
