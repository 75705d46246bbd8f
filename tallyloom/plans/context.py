"""What rules read besides their own table, and what core tables look like."""

from __future__ import annotations

from collections.abc import Callable, Mapping as MappingType
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.spec import Mapping, quoted

REMOTE_ID = "remote_id"

# Columns of core tables that no provider feeds and the mapping does not list.
COMMON_EXTRAS = {"archived": "boolean", "change_timestamp": "timestamp", "country_id": "int"}
EXTRAS = {
    "accounts": {
        "stock_id": "int",
        "days_since_registration": "double",
        "expected_paid": "decimal(18,8)",
        "amount_in_arrears": "decimal(18,8)",
        "cumulative_days_disabled": "double",
        "days_to_cutoff": "double",
    },
}
# Reference tables that have no mapping.
REFERENCE = {
    "columnmaps": "col string, val string, target string",
    "country": "country_id int, country_name string",
    "products": "product string, product_external_name string",
    "pricing_groups": "product string, pricing_group string",
}


def core_schema(mapping: Mapping, table: str, remote_id: str = REMOTE_ID) -> T.StructType:
    """Declared columns of a core table, in mapping order, then the extra ones."""
    if table in REFERENCE:
        return T.StructType.fromDDL(REFERENCE[table])
    kinds = {f.name: f.spark_type for f in mapping.resolve(table, system=True, core=True)}
    kinds.setdefault(remote_id, "bigint")
    for name, kind in {**COMMON_EXTRAS, **EXTRAS.get(table, {})}.items():
        kinds.setdefault(name, kind)
    return T.StructType([T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items()])


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with all columns of ``schema``: those it lacks are null."""
    have = df.columns
    if have[: len(schema.names)] == schema.names:
        return df
    declared = [
        quoted(f.name)
        if f.name in have
        else f"cast(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in schema.fields
    ]
    return df.selectExpr(*declared, *[quoted(c) for c in have if c not in schema.names])


def instant(as_of: datetime) -> Column:
    """A literal instant; a time without zone is taken as UTC."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(UTC).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ") + "+00:00").cast("timestamp")


@dataclass(frozen=True)
class Context:
    """Inputs of a rule: other tables at their last committed snapshot, and the time."""

    table: Callable[[str], DataFrame]
    as_of: Column
    remote_id: str = REMOTE_ID
    geo_parity: bool = False
    hot: MappingType[str, list] = field(default_factory=dict)

    def heavy(self, column: str) -> list:
        """Values of a key column known to hold a large share of the rows."""
        return list(self.hot.get(column, []))


Rule = Callable[[DataFrame, Context], DataFrame]
