"""Sources, cleaning, projection and casts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyloom.functions import cells
from tallyloom.operators import clean, conform
from tallyloom.session import scratch_path
from tallyloom.sources import extracts, reports
from tallyloom.spec import Field, Provider

AS_OF = datetime(2024, 1, 20, 10, 30)

_TOKENS = ", ".join(f"'{t}'" for t in cells.NULL_TOKENS)
_CHARS = "chr(9) || chr(13) || chr(10) || '<>&'"


def clean_sql(c: str) -> str:
    return (
        f"replace(translate(CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END, "
        f"{_CHARS}, ''), 'undefined', '')"
    )


_CODED = """CASE lang WHEN 'de' THEN 'n/a' WHEN 'fr' THEN 'None' WHEN 'es' THEN 'undefined'
            ELSE 'a<b' || chr(9) || '&' || lang END"""


@check(
    "ingest_clean",
    f"""WITH cells AS (
        SELECT 'documents' AS origin, doc_id AS id, {_CODED} AS code, text AS body FROM documents
        UNION ALL
        SELECT 'pages', page_id, replace(url, 'example', 'undefined'), html FROM pages)
    SELECT origin, id, {clean_sql("code")} AS code, {clean_sql("body")} AS body FROM cells""",
)
def ingest_clean(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "'documents' AS origin",
        "doc_id AS id",
        "CASE lang WHEN 'de' THEN 'n/a' WHEN 'fr' THEN 'None' WHEN 'es' THEN 'undefined' "
        "ELSE concat('a<b', char(9), '&', lang) END AS code",
        "text AS body",
    )
    pages = table(spark, sf, "pages").selectExpr(
        "'pages' AS origin", "page_id AS id", "replace(url, 'example', 'undefined') AS code", "html AS body"
    )
    return clean.clean_extract(docs.unionByName(pages))


@check(
    "extract_read",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {clean_sql("lang || ', ' || text")} AS body,
        CAST(n_chars AS VARCHAR) AS "size.chars" FROM documents""",
)
def extract_read(spark, sf):
    """Whole texts, with quotes and line breaks, written as CSV files and read back."""
    path = scratch_path(spark, "extract")
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id", "concat(lang, ', ', text) AS body", "n_chars AS `size.chars`"
    )
    writer = docs.write.option("header", True).option("escape", '"')
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path)
    return clean.clean_extract(extracts.read_extract(spark, path))


@check(
    "fragment_union",
    """SELECT event_id, ts, user_id FROM events WHERE event_type = 'view'
    UNION ALL BY NAME SELECT event_id, value FROM events WHERE event_type = 'click'
    UNION ALL BY NAME SELECT event_id, props, user_id FROM events WHERE event_type = 'error'
    UNION ALL BY NAME SELECT event_id, value, props FROM events WHERE event_type = 'signup'
    UNION ALL BY NAME SELECT event_id, ts, value FROM events WHERE event_type = 'purchase'""",
)
def fragment_union(spark, sf):
    events = table(spark, sf, "events")
    parts = {
        "view": ["event_id", "ts", "user_id"],
        "click": ["event_id", "value"],
        "error": ["event_id", "props", "user_id"],
        "signup": ["event_id", "value", "props"],
        "purchase": ["event_id", "ts", "value"],
    }
    return extracts.union_fragments(
        [events.filter(F.col("event_type") == kind).select(*cols) for kind, cols in parts.items()]
    )


@check("lookback_filter", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00'")
def lookback_filter(spark, sf):
    return extracts.lookback(table(spark, sf, "events"), "ts", 7, AS_OF)


@check(
    "report_table",
    """SELECT o_orderkey, o_orderdate, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS priority
    FROM orders WHERE o_orderdate > TIMESTAMP '1998-08-16' ORDER BY o_orderdate DESC""",
)
def report_table(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderdate", "nullif(o_orderpriority, '5-LOW') AS priority"
    )
    return extracts.report_table(orders, "o_orderdate", "1998-08-16")


@check(
    "concat_space",
    """SELECT c_custkey, regexp_replace(chr(9) || ' ' || nullif(c_mktsegment, 'BUILDING') || ' '
        || c_name, '^\\s+', '') AS full_name FROM customer""",
)
def concat_space(spark, sf):
    parts = [F.expr("concat(char(9), ' ', nullif(c_mktsegment, 'BUILDING'))"), F.col("c_name")]
    return table(spark, sf, "customer").select(
        "c_custkey", cells.concat_cols(parts).alias("full_name")
    )


@check(
    "concat_nosep",
    """SELECT p_partkey, regexp_replace(nullif(p_brand, 'Brand#7') || p_type || CAST(p_size AS
        VARCHAR), '^\\s+', '') AS code FROM part""",
)
def concat_nosep(spark, sf):
    parts = [F.expr("nullif(p_brand, 'Brand#7')"), F.col("p_type"), F.col("p_size").cast("string")]
    return table(spark, sf, "part").select("p_partkey", cells.concat_cols(parts, "").alias("code"))


def _payment(name: str, kind: str, source: str, **flags: bool) -> Field:
    return Field("payments", name, kind, {"orders": source}, **flags)


PAYMENT_FIELDS = [
    _payment("payment_external_id", "TEXT", "order.key", business_key=True, outbound=True),
    _payment("effective_utc", "TIMESTAMPTZ", "order.date"),
    _payment("recorded_utc", "TIMESTAMPTZ", "order.date"),
    _payment("account_number", "INT", "o_custkey"),
    _payment("amount", "DECIMAL", "o_totalprice"),
    _payment("payment_type", "TEXT", "o_orderstatus+o_orderpriority"),
    _payment("reference", "TEXT", "o_orderstatus|order.key"),
    _payment("down_payment_ind", "BOOLEAN", "down"),
    _payment("reversal_note", "TEXT", "not_delivered"),
]
ORDERS = Provider("orders", "house", "Malawi")


def orders_text(spark, sf, orders=None):
    """Orders as a provider would deliver them: dotted headers, every value text."""
    orders = table(spark, sf, "orders") if orders is None else orders
    return orders.selectExpr(
        "cast(o_orderkey AS string) AS `order.key`",
        "cast(o_orderdate AS string) AS `order.date`",
        "concat(' ', o_custkey, ' ') AS o_custkey",
        "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS o_totalprice",
        "o_orderstatus",
        "nullif(o_orderpriority, '5-LOW') AS o_orderpriority",
        "CASE o_orderstatus WHEN 'O' THEN 'on' WHEN 'F' THEN 'Off' END AS down",
        "'x' AS unmapped",
    )


@check(
    "mapping_project",
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_external_id,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS effective_utc,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS recorded_utc,
        ' ' || o_custkey || ' ' AS account_number,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
        o_orderstatus || ' ' || nullif(o_orderpriority, '5-LOW') AS payment_type,
        o_orderstatus || o_orderkey AS reference,
        CASE o_orderstatus WHEN 'O' THEN 'on' WHEN 'F' THEN 'Off' END AS down_payment_ind,
        'orders' AS external_sys, 'house' AS organization, 'Malawi' AS country FROM orders""",
)
def mapping_project(spark, sf):
    rows = conform.project_mapping(orders_text(spark, sf), PAYMENT_FIELDS, "orders")
    return conform.stamp_source(rows, ORDERS)


@check(
    "drop_null_columns",
    "SELECT event_id, nullif(event_type, 'view') AS event_type, value FROM events",
)
def drop_null_columns(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "nullif(event_type, 'view') AS event_type",
        "nullif(user_id, user_id) AS user_id",
        "value",
        "nullif(props, props) AS props",
    )
    return conform.drop_all_null_columns(rows)


@check(
    "typed_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_external_id, o_orderdate AS effective_utc,
        o_orderdate AS recorded_utc, CAST(o_custkey AS INTEGER) AS account_number,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS down_payment_ind
    FROM orders""",
)
def typed_cast(spark, sf):
    staged = conform.project_mapping(orders_text(spark, sf), PAYMENT_FIELDS, "orders")
    typed = conform.typed_select(staged.drop("payment_type", "reference"), PAYMENT_FIELDS)
    return typed.withColumns(
        {
            "amount": F.col("amount").cast("double"),
            "effective_utc": F.col("effective_utc").cast("timestamp_ntz"),
            "recorded_utc": F.col("recorded_utc").cast("timestamp_ntz"),
        }
    )


@check(
    "bad_casts",
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_external_id,
        CASE WHEN o_orderstatus = 'P' THEN o_custkey || '.0x' ELSE '' || o_custkey END
        AS account_number FROM orders WHERE o_orderstatus = 'P'""",
)
def bad_casts(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey AS string) AS payment_external_id",
        "CASE WHEN o_orderstatus = 'P' THEN concat(o_custkey, '.0x') "
        "ELSE cast(o_custkey AS string) END AS account_number",
    )
    return conform.bad_casts(rows, PAYMENT_FIELDS)


_LAT = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {text})"
_GEO = """CASE c_mktsegment WHEN 'BUILDING' THEN '- -'
    WHEN 'MACHINERY' THEN concat({lat}, ' ', c_nationkey) WHEN 'FURNITURE' THEN NULL
    ELSE concat({lat}, ',', c_nationkey) END"""
_GEO_SPARK = _GEO.format(lat=_LAT.format(text="STRING"))
_LAT_SQL = _LAT.format(text="VARCHAR")


@check(
    "geo_reverse",
    f"""SELECT c_custkey,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
            THEN c_nationkey || ' ' || {_LAT_SQL} END AS lnglat,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN {_LAT_SQL} || ' ' || c_nationkey
            WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
            THEN c_nationkey || ' ' || {_LAT_SQL} END AS lnglat_parity
    FROM customer""",
)
def geo_reverse(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.expr(_GEO_SPARK).alias("geo"))
    return rows.select(
        "c_custkey",
        cells.lnglat_text(F.col("geo")).alias("lnglat"),
        cells.lnglat_text(F.col("geo"), parity=True).alias("lnglat_parity"),
    )


@check(
    "geo_extract",
    """SELECT c_custkey,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
            THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS latitude,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
            THEN CAST(c_nationkey AS DOUBLE) END AS longitude
    FROM customer""",
)
def geo_extract(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.expr(_GEO_SPARK).alias("geo"))
    rows = rows.select("c_custkey", cells.point(cells.lnglat_text(F.col("geo"))).alias("point"))
    point = F.col("point")
    return rows.select(
        "c_custkey",
        cells.latitude(point).alias("latitude"),
        cells.longitude(point).alias("longitude"),
    )


@check(
    "phone_digits",
    """WITH cells AS (SELECT 'documents' AS origin, doc_id AS id, text AS raw FROM documents
        UNION ALL SELECT 'pages', page_id, url FROM pages
        UNION ALL SELECT 'events', event_id, nullif(props, '{"k": 7}') FROM events)
    SELECT origin, id, left(nullif(coalesce(regexp_replace(raw, '[^0-9]', '', 'g'), '0'), ''), 12)
        AS phone FROM cells""",
)
def phone_digits(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("'documents' AS origin", "doc_id AS id", "text AS raw")
    pages = table(spark, sf, "pages").selectExpr("'pages' AS origin", "page_id AS id", "url AS raw")
    events = table(spark, sf, "events").selectExpr(
        "'events' AS origin", "event_id AS id", """nullif(props, '{"k": 7}') AS raw"""
    )
    rows = docs.unionByName(pages).unionByName(events)
    return rows.select("origin", "id", cells.phone_digits(F.col("raw")).alias("phone"))


@check(
    "regex_extract",
    """SELECT 'documents' AS origin, doc_id AS id,
        nullif(regexp_extract(text, '[0-9]{8}'), '') AS unit FROM documents
    UNION ALL SELECT 'pages', page_id, nullif(regexp_extract(html, '[0-9]{8}'), '') FROM pages
    UNION ALL SELECT 'customer', c_custkey, nullif(regexp_extract(c_name, '[0-9]{8}'), '')
        FROM customer""",
)
def regex_extract(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("'documents' AS origin", "doc_id AS id", "text AS raw")
    pages = table(spark, sf, "pages").selectExpr("'pages' AS origin", "page_id AS id", "html AS raw")
    names = table(spark, sf, "customer").selectExpr("'customer' AS origin", "c_custkey AS id", "c_name AS raw")
    rows = docs.unionByName(pages).unionByName(names)
    return rows.select("origin", "id", cells.first_match(F.col("raw"), "[0-9]{8}").alias("unit"))


@check(
    "decimal_text",
    """SELECT p_partkey,
        rtrim(rtrim(CAST(CAST(p_retailprice AS DECIMAL(18,8)) AS VARCHAR), '0'), '.') AS price,
        rtrim(rtrim(CAST(CAST(p_size AS DECIMAL(18,8)) AS VARCHAR), '0'), '.') AS size FROM part""",
)
def decimal_text(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        cells.decimal_text(F.col("p_retailprice").cast("decimal(18,8)")).alias("price"),
        cells.decimal_text(F.col("p_size").cast("decimal(18,8)")).alias("size"),
    )


def report_texts(spark, sf):
    """One report per event: its properties and a nested record, or an error."""
    return table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE WHEN event_type = 'error' THEN concat('<ErrorList>', event_id)
        ELSE concat('{"Form":[', props, ',{"k":', user_id, ',"by":{"type":"', event_type,
            '","at":{"id":', event_id, '}}}]}') END AS report""",
    )


@check(
    "json_flatten",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL AS "by.type",
        CAST(NULL AS BIGINT) AS "by.at.id" FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, user_id, event_type, event_id FROM events
    WHERE event_type <> 'error'""",
)
def json_flatten(spark, sf):
    record = "k bigint, `by` struct<type:string, at:struct<id:bigint>>"
    return reports.flatten_report(
        report_texts(spark, sf), "report", "Form", record, keep=("event_id",), strict=False
    )


@check(
    "json_flatten_inferred",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL AS "by.type",
        CAST(NULL AS BIGINT) AS "by.at.id" FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, user_id, event_type, event_id FROM events
    WHERE event_type <> 'error'""",
)
def json_flatten_inferred(spark, sf):
    return reports.flatten_report(
        report_texts(spark, sf), "report", "Form", keep=("event_id",), strict=False
    )


@check(
    "report_errors",
    """SELECT event_id, '<ErrorList>' || event_id AS report FROM events
    WHERE event_type = 'error'""",
)
def report_errors(spark, sf):
    return reports.report_errors(report_texts(spark, sf), "report")
