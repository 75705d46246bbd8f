"""Reconciliation: orders are the core, line items the staged rows.

Staged keys are twice the order key, so some meet the core and some do not;
lines of position 7 have no key, and most keys are staged several times.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyloom.operators import upsert

KEY = "number"

CORE_SQL = """core AS (SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
        ELSE o_orderkey END AS number, o_custkey AS custkey, o_orderdate AS shipped,
        o_orderstatus AS status, o_totalprice AS price, CAST(NULL AS TIMESTAMP) AS change_timestamp
    FROM orders)"""
RAW_SQL = """raw AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey * 2 END AS number,
        l_shipdate AS shipped, l_linestatus AS status,
        CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price FROM lineitem{where})"""
STAGED_SQL = """staged AS (SELECT number, shipped, status, price FROM (SELECT *, row_number() OVER
        (PARTITION BY number ORDER BY shipped DESC, status DESC NULLS LAST, price DESC NULLS LAST)
        AS rn FROM raw WHERE number IS NOT NULL) WHERE rn = 1)"""
STAMP = "TIMESTAMP '2024-01-20 10:30:00'"


def ctes(where: str = "") -> str:
    return f"WITH {CORE_SQL}, {RAW_SQL.format(where=where)}, {STAGED_SQL}"


def core(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL "
        "ELSE o_orderkey END AS number",
        "o_custkey AS custkey",
        "o_orderdate AS shipped",
        "o_orderstatus AS status",
        "o_totalprice AS price",
        "cast(NULL AS timestamp_ntz) AS change_timestamp",
    )


def staged(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber <> 7 THEN l_orderkey * 2 END AS number",
        "l_shipdate AS shipped",
        "l_linestatus AS status",
        "CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price",
    )


def as_of():
    return F.lit("2024-01-20 10:30:00").cast("timestamp_ntz")


_NEW = """SELECT s.number, CAST(NULL AS BIGINT) AS custkey, s.shipped, s.status, s.price, {stamp}
    AS change_timestamp FROM staged s WHERE s.number NOT IN
    (SELECT number FROM core WHERE number IS NOT NULL)"""
_MATCHED = f"""SELECT c.number, c.custkey,
        CASE WHEN s.number IS NOT NULL THEN s.shipped ELSE c.shipped END AS shipped,
        CASE WHEN s.number IS NOT NULL THEN s.status ELSE c.status END AS status,
        CASE WHEN s.number IS NOT NULL THEN s.price ELSE c.price END AS price,
        CASE WHEN s.number IS NOT NULL THEN {STAMP} ELSE c.change_timestamp END AS change_timestamp
    FROM core c LEFT JOIN staged s ON c.number = s.number"""


_PRICED = " WHERE l_returnflag <> 'R' AND l_extendedprice >= 20000"


@check(
    "insert_missing",
    f"{ctes()} SELECT * FROM core UNION ALL {_NEW.format(stamp='CAST(NULL AS TIMESTAMP)')}",
)
def insert_missing(spark, sf):
    return upsert.insert_missing(staged(spark, sf), core(spark, sf), KEY, order_by=["shipped"])


@check("update_matched", f"{ctes()} {_MATCHED}")
def update_matched(spark, sf):
    return upsert.update_matched(
        core(spark, sf), staged(spark, sf), KEY, as_of(), order_by=["shipped"]
    )


@check("upsert", f"{ctes()} {_MATCHED} UNION ALL {_NEW.format(stamp=STAMP)}")
def upsert_all(spark, sf):
    return upsert.upsert(core(spark, sf), staged(spark, sf), KEY, as_of(), order_by=["shipped"])


@check("upsert_shuffled", f"{ctes()} {_MATCHED} UNION ALL {_NEW.format(stamp=STAMP)}")
def upsert_shuffled(spark, sf):
    """The same by the join that serves staged rows of any size."""
    return upsert.upsert(
        core(spark, sf), staged(spark, sf), KEY, as_of(), order_by=["shipped"], small=False
    )


@check(
    "upsert_filtered",
    f"{ctes(_PRICED)} {_MATCHED} UNION ALL {_NEW.format(stamp=STAMP)}",
)
def upsert_filtered(spark, sf):
    return upsert.upsert(
        core(spark, sf),
        staged(spark, sf),
        KEY,
        as_of(),
        where="price >= 20000",
        order_by=["shipped"],
    )


@check(
    "sparse_update",
    f"""WITH {CORE_SQL}, {RAW_SQL.format(where="")}, staged AS (SELECT number, max(status) AS status
        FROM raw WHERE number IS NOT NULL GROUP BY number)
    SELECT coalesce(c.number, s.number) AS number, c.custkey, c.shipped,
        CASE WHEN s.number IS NOT NULL THEN s.status ELSE c.status END AS status, c.price,
        CASE WHEN s.number IS NOT NULL THEN {STAMP} END AS change_timestamp
    FROM core c FULL JOIN staged s ON c.number = s.number""",
)
def sparse_update(spark, sf):
    """Columns that are not staged keep their values."""
    rows = staged(spark, sf).select(KEY, "status")
    return upsert.upsert(core(spark, sf), rows, KEY, as_of())


@check("null_keys", f"WITH {RAW_SQL.format(where='')} SELECT * FROM raw WHERE number IS NULL")
def null_keys(spark, sf):
    return upsert.null_keys(staged(spark, sf), KEY)


@check("staged_rows", f"{ctes()} SELECT * FROM staged")
def staged_rows(spark, sf):
    return upsert.one_per_key(staged(spark, sf), KEY, ["shipped"])
