"""Reconciling staged rows into a core table.

Staged columns overwrite core columns, nulls included; columns that are not
staged are left alone; rows whose key is missing are inserted. Two choices make
the result deterministic: staged rows without a key are set aside, and of
several staged rows of one key the last one in a stated order is taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import fits_broadcast
from tallyloom.spec import quoted

CHANGED = "change_timestamp"


def null_keys(staging: DataFrame, key: str) -> DataFrame:
    """Staged rows set aside because they have no business key."""
    return staging.filter(F.col(quoted(key)).isNull())


def one_per_key(staging: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``order_by``, then by all other columns.

    ``max`` of a struct combines before the shuffle, so a key that holds a large
    share of the rows arrives as one row per input partition.
    """
    names = staging.columns
    payload = [c for c in names if c != key]
    ranked = [*order_by, *[c for c in payload if c not in order_by]]
    k, cells = quoted(key), ", ".join(quoted(c) for c in ranked)
    rows = staging.filter(f"{k} IS NOT NULL")
    if not payload:
        return rows.distinct()
    best = rows.groupBy(k).agg(F.expr(f"max(struct({cells})) AS __row"))
    return best.selectExpr(*[quoted(c) if c == key else f"__row.{quoted(c)}" for c in names])


def _prepared(
    staging: DataFrame,
    key: str,
    where: str | Column | None,
    order_by: Sequence[str],
    unique: bool,
) -> DataFrame:
    if where is not None:
        staging = staging.alias("a").filter(where)
    if unique:
        return staging.filter(F.col(quoted(key)).isNotNull())
    return one_per_key(staging, key, order_by)


def _changed_at(core: DataFrame, as_of: datetime | Column) -> Column:
    kind = core.schema[CHANGED].dataType if CHANGED in core.columns else "timestamp"
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(kind)


def lacking(
    rows: DataFrame, key: str, core: DataFrame, core_key: str, small: bool | None = None
) -> DataFrame:
    """The ``rows`` whose key ``core`` lacks.

    ``left_anti`` on keys that are not null: ``NOT IN`` would broadcast all core
    keys, and one null among them would block every row. When ``rows`` are few
    (``small``, by default found from their size) the core keys are first cut to
    those among them, so that no core key is shuffled.
    """
    known = core.selectExpr(f"{quoted(core_key)} AS __known").filter("__known IS NOT NULL")
    if fits_broadcast(rows) if small is None else small:
        wanted = rows.selectExpr(f"{quoted(key)} AS __wanted")
        known = known.join(wanted, F.expr("__known = __wanted"), "left_semi")
    return rows.join(known, F.expr(f"{quoted(key)} = __known"), "left_anti")


def insert_missing(
    staging: DataFrame,
    core: DataFrame,
    key: str,
    where: str | Column | None = None,
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Core plus the staged rows whose key it lacks."""
    rows = _prepared(staging, key, where, order_by, unique)
    return core.unionByName(lacking(rows, key, core, key), allowMissingColumns=True)


def update_matched(
    core: DataFrame,
    staging: DataFrame,
    key: str,
    as_of: datetime | Column,
    where: str | Column | None = None,
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Core with staged columns written over the rows whose key is staged."""
    return _merge(core, _prepared(staging, key, where, order_by, unique), key, as_of, "left_outer")


def upsert(
    core: DataFrame,
    staging: DataFrame,
    key: str,
    as_of: datetime | Column,
    where: str | Column | None = None,
    order_by: Sequence[str] = (),
    unique: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Insert what is missing and update what matches.

    Inserted rows count as matched, so they carry ``change_timestamp`` as well.
    ``where`` is a predicate on staged columns, plain or as ``a.<column>``: rows
    that fail it do neither.

    Where the staged rows are within the broadcast limit (``small``, by default
    found from their size), the core is updated in place of a scan and never
    shuffled. Otherwise both steps are one full outer join on the key.
    """
    rows = _prepared(staging, key, where, order_by, unique)
    if not (fits_broadcast(rows) if small is None else small):
        return _merge(core, rows, key, as_of, "full_outer")
    updated = _merge(core, rows, key, as_of, "left_outer", around=False)
    new = lacking(rows, key, core, key, small=True)
    stamped = new.withColumn(CHANGED, _changed_at(core, as_of))
    return updated.unionByName(stamped, allowMissingColumns=True)


def _merge(
    core: DataFrame,
    rows: DataFrame,
    key: str,
    as_of: datetime | Column,
    how: str,
    around: bool = True,
) -> DataFrame:
    """Join on the key alone, so that both sides keep a partitioning they already have.

    Core rows without a key can match nothing and would all meet in one task of a
    shuffle: they go ``around`` the join.
    """
    old_names, new_names = core.columns, rows.columns
    key_sql = quoted(key)
    held = core.filter(f"{key_sql} IS NOT NULL") if around else core
    held = held.toDF(*[f"__core_{c}" for c in old_names])
    staged = rows.toDF(*[f"__staged_{c}" for c in new_names])
    staged_key = quoted(f"__staged_{key}")
    both = held.join(staged, F.expr(f"{quoted(f'__core_{key}')} = {staged_key}"), how)

    names = list(dict.fromkeys([*old_names, *new_names, CHANGED]))
    out = []
    for c in names:
        old = quoted(f"__core_{c}") if c in old_names else "NULL"
        new = quoted(f"__staged_{c}") if c in new_names else "__as_of" if c == CHANGED else None
        value = f"CASE WHEN {staged_key} IS NOT NULL THEN {new} ELSE {old} END" if new else old
        out.append(f"{value} AS {quoted(c)}")
    merged = both.withColumn("__as_of", _changed_at(core, as_of)).selectExpr(*out)
    if not around:
        return merged
    keyless = core.filter(f"{key_sql} IS NULL")
    return merged.unionByName(keyless, allowMissingColumns=True)
