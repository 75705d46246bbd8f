"""What the caller declares: the column mapping, providers and deliveries."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field

# Declared type name -> Spark type. Unconstrained numerics get an explicit
# scale: a bare DECIMAL would be decimal(10,0), and the product of two (18,8)
# values still fits 38 digits.
SPARK_TYPES = {
    "TEXT": "string",
    "INT": "int",
    "BIGINT": "bigint",
    "DECIMAL": "decimal(18,8)",
    "BOOLEAN": "boolean",
    "TIMESTAMPTZ": "timestamp",
    "GEOGRAPHY": "struct<lng:double,lat:double>",
}

SYSTEM_ROWS = "all"


def quoted(name: str) -> str:
    """Source headers hold dots (``client.profile.firstName``)."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Field:
    """One mapped column of one core table."""

    table: str
    name: str
    type: str
    sources: MappingType[str, str] = field(default_factory=dict)
    business_key: bool = False
    outbound: bool = False
    surrogate: bool = False

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class Mapping:
    """All mapped columns, of all tables."""

    fields: tuple[Field, ...]

    def resolve(
        self,
        table: str,
        provider: str | None = None,
        system: bool = False,
        core: bool = False,
        outbound: bool = False,
    ) -> list[Field]:
        """Columns of ``table``, narrowed the way one step needs them.

        ``system`` adds the columns shared by all tables. ``outbound`` keeps the
        columns that are delivered; otherwise, unless ``core`` asks for the
        whole table, only columns the provider supplies are kept.
        """
        tables = {table, SYSTEM_ROWS} if system else {table}
        rows = [f for f in self.fields if f.table in tables]
        if outbound:
            return [f for f in rows if f.outbound]
        if core:
            return rows
        return [f for f in rows if f.sources.get(provider)]

    def tables(self) -> list[str]:
        return list(dict.fromkeys(f.table for f in self.fields if f.table != SYSTEM_ROWS))

    def business_key(self, table: str) -> str:
        return self._flagged(table, "business_key")

    def surrogate(self, table: str) -> str:
        return self._flagged(table, "surrogate")

    def _flagged(self, table: str, flag: str) -> str:
        names = [f.name for f in self.resolve(table, core=True) if getattr(f, flag)]
        if not names:
            raise ValueError(f"mapping of {table} marks no {flag}")
        return names[0]


@dataclass(frozen=True)
class TableFeed:
    """How one provider feeds one core table."""

    filter: str | None = None  # SQL predicate on staged columns, plain or as a.<column>
    prep: str | None = None  # "core" or "users"
    rules: str | None = None  # name of the rules run after the upsert
    order_by: tuple[str, ...] = ()  # which of several staged rows of a key wins
    geo_parity: bool = False
    set_aside: bool = False  # rows with a cell of another type, instead of failing the run


@dataclass(frozen=True)
class Provider:
    name: str
    organization: str
    country: str
    sep: str = ","
    tables: MappingType[str, TableFeed] = field(default_factory=dict)


@dataclass(frozen=True)
class Delivery:
    """How one core table is delivered to the remote system."""

    table: str
    form: str
    slice_length: int
    update: bool = True
    update_sql: str | None = None  # overrides the selection of known records


def delivery_passes(spec: Delivery, insert_only: bool = False) -> list[bool]:
    """Passes of one delivery run: False = new records, True = known records."""
    return [False] if insert_only or not spec.update else [False, True]
