"""Lookups, recoding, counts, new members and scalar derivations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyloom.functions.cells import elapsed_days
from tallyloom.operators import aggregate, derive, lookup

# Orders as facts: the account key is missing on one priority, the fact's own
# values are missing on some statuses.
FACTS_SQL = """facts AS (SELECT o_orderkey AS id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey, o_orderstatus AS status,
        o_orderdate AS day, CASE WHEN o_orderstatus = 'O' THEN -1 END AS nation,
        nullif(o_orderpriority, '1-URGENT') AS segment FROM orders)"""
DIM_SQL = """dim AS (SELECT c_custkey AS ckey, c_nationkey AS cnation,
        nullif(c_mktsegment, 'BUILDING') AS csegment, c_name AS cname FROM customer)"""
WITH = f"WITH {FACTS_SQL}, {DIM_SQL}"


def facts(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey",
        "o_orderstatus AS status",
        "o_orderdate AS day",
        "CASE WHEN o_orderstatus = 'O' THEN -1 END AS nation",
        "nullif(o_orderpriority, '1-URGENT') AS segment",
    )


def dim(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS ckey",
        "c_nationkey AS cnation",
        "nullif(c_mktsegment, 'BUILDING') AS csegment",
        "c_name AS cname",
    )


_MAPS_SQL = """maps AS (SELECT 'STATUS' AS col, 'O' AS val, 'OPEN' AS target
    UNION ALL SELECT 'STATUS', 'P', NULL
    UNION ALL SELECT 'NATION', n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'FLAG', 'A', 'ACCEPTED' UNION ALL SELECT 'FLAG', 'R', 'RETURNED'
    UNION ALL SELECT 'LINE', 'F', 'FILLED')"""


def maps(spark, sf):
    fixed = spark.sql(
        """SELECT * FROM VALUES ('STATUS', 'O', 'OPEN'), ('STATUS', 'P', NULL),
        ('FLAG', 'A', 'ACCEPTED'), ('FLAG', 'R', 'RETURNED'), ('LINE', 'F', 'FILLED')
        AS maps(col, val, target)"""
    )
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    regions = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "'NATION' AS col", "n_name AS val", "r_name AS target"
    )
    return fixed.union(regions)


@check(
    "recode_status",
    f"""WITH {_MAPS_SQL}, src AS (SELECT o_orderkey AS id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey,
        o_orderstatus AS status, 'NATION_' || (length(o_orderpriority) * 2) AS nation FROM orders)
    SELECT id, custkey,
        CASE WHEN custkey IS NOT NULL AND s.val IS NOT NULL THEN s.target ELSE status END AS status,
        CASE WHEN custkey IS NOT NULL AND n.val IS NOT NULL THEN n.target ELSE nation END AS nation
    FROM src LEFT JOIN maps s ON s.col = 'STATUS' AND s.val = status
        LEFT JOIN maps n ON n.col = 'NATION' AND n.val = nation""",
)
def recode_status(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey",
        "o_orderstatus AS status",
        "concat('NATION_', length(o_orderpriority) * 2) AS nation",
    )
    codes = {"status": "STATUS", "nation": "NATION"}
    return lookup.recode(rows, maps(spark, sf), codes, key=["custkey"])


@check(
    "recode_composite",
    f"""WITH {_MAPS_SQL}, src AS (SELECT l_orderkey, CASE WHEN l_tax <> 0 THEN l_linenumber END
            AS line, l_partkey, l_returnflag AS flag, l_linestatus AS status FROM lineitem),
    coded AS (SELECT src.*, f.val AS fval, f.target AS ftarget, l.val AS lval, l.target AS ltarget
        FROM src LEFT JOIN maps f ON f.col = 'FLAG' AND f.val = flag
        LEFT JOIN maps l ON l.col = 'LINE' AND l.val = status),
    kin AS (SELECT l_orderkey AS k, line AS n, min(ftarget) AS ftarget, max(fval) AS fval,
        min(ltarget) AS ltarget, max(lval) AS lval FROM coded WHERE line IS NOT NULL GROUP BY 1, 2)
    SELECT l_orderkey, line, l_partkey,
        CASE WHEN line IS NULL THEN flag WHEN c.fval IS NOT NULL THEN c.ftarget
            WHEN kin.fval IS NOT NULL THEN kin.ftarget ELSE flag END AS flag,
        CASE WHEN line IS NULL THEN status WHEN c.lval IS NOT NULL THEN c.ltarget
            WHEN kin.lval IS NOT NULL THEN kin.ltarget ELSE status END AS status
    FROM coded c LEFT JOIN kin ON k = l_orderkey AND n = line""",
)
def recode_composite(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "CASE WHEN l_tax <> 0 THEN l_linenumber END AS line",
        "l_partkey",
        "l_returnflag AS flag",
        "l_linestatus AS status",
    )
    codes = {"flag": "FLAG", "status": "LINE"}
    return lookup.recode(rows, maps(spark, sf), codes, key=["l_orderkey", "line"], shared=True)


@check(
    "fk_fill",
    f"""{WITH} SELECT id, custkey, status, day, segment,
        CASE WHEN nation IS NULL AND ckey IS NOT NULL THEN cnation ELSE nation END AS nation
    FROM facts LEFT JOIN dim ON custkey = ckey""",
)
def fk_fill(spark, sf):
    return lookup.lookup(
        facts(spark, sf),
        dim(spark, sf),
        {"custkey": "ckey"},
        {"nation": "cnation"},
        only_null="nation",
        row_key=["id"],
    )


@check(
    "fk_fill_multi",
    f"""{WITH} SELECT id, custkey, status, day,
        CASE WHEN segment IS NULL AND ckey IS NOT NULL THEN csegment ELSE segment END AS segment,
        CASE WHEN segment IS NULL AND ckey IS NOT NULL THEN cnation ELSE nation END AS nation
    FROM facts LEFT JOIN dim ON custkey = ckey""",
)
def fk_fill_multi(spark, sf):
    return lookup.lookup(
        facts(spark, sf),
        dim(spark, sf),
        {"custkey": "ckey"},
        {"segment": "csegment", "nation": "cnation"},
        only_null="segment",
        row_key=["id"],
    )


@check(
    "fk_overwrite",
    f"""{WITH}, sup AS (SELECT s_suppkey, s_nationkey, s_name FROM supplier)
    SELECT id, custkey, status, day, CASE WHEN s_suppkey IS NOT NULL THEN s_nationkey ELSE nation
        END AS nation, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE segment END AS segment
    FROM facts LEFT JOIN sup ON custkey = s_suppkey""",
)
def fk_overwrite(spark, sf):
    return lookup.lookup(
        facts(spark, sf),
        table(spark, sf, "supplier"),
        {"custkey": "s_suppkey"},
        {"nation": "s_nationkey", "segment": "s_name"},
        row_key=["id"],
    )


@check(
    "fk_guarded",
    f"""{WITH} SELECT id, custkey, status, day, nation,
        CASE WHEN ckey IS NOT NULL AND status = 'F' AND day >= TIMESTAMP '1998-02-22 00:00:00'
            THEN csegment ELSE segment END AS segment
    FROM facts LEFT JOIN dim ON custkey = ckey""",
)
def fk_guarded(spark, sf):
    """A null of the lookup side overwrites too."""
    return lookup.lookup(
        facts(spark, sf),
        dim(spark, sf),
        {"custkey": "ckey"},
        {"segment": "csegment"},
        when="status = 'F' AND day >= TIMESTAMP_NTZ '1998-02-22 00:00:00'",
        row_key=["id"],
    )


@check(
    "fk_composite",
    """WITH dim AS (SELECT o_custkey, o_orderstatus, min(o_orderkey) AS first_order FROM orders
        GROUP BY 1, 2)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, first_order
    FROM lineitem LEFT JOIN dim ON l_suppkey = o_custkey AND l_linestatus = o_orderstatus""",
)
def fk_composite(spark, sf):
    """Many candidates per key: the smallest is taken and no row is multiplied."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus"
    )
    return lookup.lookup(
        lines,
        table(spark, sf, "orders"),
        {"l_suppkey": "o_custkey", "l_linestatus": "o_orderstatus"},
        {"first_order": "o_orderkey"},
        row_key=["l_orderkey", "l_linenumber"],
    )


@check(
    "fk_hot",
    """WITH dim AS (SELECT c_nationkey, min(c_name) AS name FROM customer GROUP BY 1)
    SELECT l_orderkey, l_partkey, l_linenumber, n AS nation, dim.name FROM (SELECT *,
        CASE WHEN l_returnflag = 'R' THEN 7 ELSE CAST(l_quantity AS INTEGER) END AS n FROM lineitem)
    LEFT JOIN dim ON n = c_nationkey""",
)
def fk_hot(spark, sf):
    """A third of the lines share one key; it is found by a count and salted."""
    from tallyloom.operators.skew import heavy_keys

    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "CASE WHEN l_returnflag = 'R' THEN 7 ELSE cast(l_quantity AS int) END AS nation",
    )
    hot = heavy_keys(lines, ["nation"], share=0.1, floor=0)
    return lookup.lookup(
        lines,
        table(spark, sf, "customer"),
        {"nation": "c_nationkey"},
        {"name": "c_name"},
        row_key=["l_orderkey", "l_linenumber"],
        hot=hot.get("nation", []),
    )


@check(
    "lookup_case",
    f"""{WITH} SELECT id, custkey, status, day, nation,
        CASE WHEN segment IS NULL AND ckey IS NOT NULL THEN cname ELSE segment END AS segment,
        CASE WHEN segment IS NULL AND ckey IS NOT NULL THEN
            CASE status WHEN 'F' THEN csegment WHEN 'O' THEN cname END END AS external
    FROM facts LEFT JOIN dim ON custkey = ckey""",
)
def lookup_case(spark, sf):
    return lookup.lookup(
        facts(spark, sf),
        dim(spark, sf),
        {"custkey": "ckey"},
        {
            "segment": "cname",
            "external": lambda d: F.when(F.col("status") == "F", d("csegment")).when(
                F.col("status") == "O", d("cname")
            ),
        },
        only_null="segment",
        carry=["csegment"],
        row_key=["id"],
    )


_USERS_SQL = """users AS (SELECT c_custkey AS user_id, c_custkey AS first_id, c_custkey * 2 AS second_id,
        c_name AS name FROM customer)"""


def users(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_custkey AS first_id",
        "c_custkey * 2 AS second_id",
        "c_name AS name",
    )


@check(
    "or_key_lookup",
    f"""WITH {_USERS_SQL}, found AS (SELECT event_id AS id, min(u.user_id) AS uid FROM events e
        JOIN (SELECT user_id, first_id AS k FROM users UNION SELECT user_id, second_id FROM users) u
        ON e.user_id = u.k GROUP BY 1)
    SELECT e.event_id, e.user_id, f.uid AS recorder_id, u.name AS recorder FROM events e
    LEFT JOIN found f ON e.event_id = f.id LEFT JOIN users u ON u.user_id = f.uid""",
)
def or_key_lookup(spark, sf):
    """Two identifiers per user; an event may meet two users and takes the smaller."""
    return lookup.lookup_any_key(
        table(spark, sf, "events").select("event_id", "user_id"),
        "user_id",
        users(spark, sf),
        ["first_id", "second_id"],
        {"recorder_id": "user_id", "recorder": "name"},
        pick=["user_id"],
        row_key=["event_id"],
    )


@check(
    "or_key_guarded",
    f"""WITH {_USERS_SQL}, known AS (SELECT * FROM users WHERE name <> 'Customer#000000003'),
    found AS (SELECT event_id AS id, min(u.user_id) AS uid FROM events e
        JOIN (SELECT user_id, first_id AS k FROM known UNION SELECT user_id, second_id FROM known) u
        ON e.user_id = u.k WHERE e.event_type = 'view' GROUP BY 1)
    SELECT e.event_id, e.user_id, CASE WHEN e.event_type <> 'view' THEN 0 ELSE f.uid END
        AS recorder_id FROM events e LEFT JOIN found f ON e.event_id = f.id""",
)
def or_key_guarded(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "CASE WHEN event_type <> 'view' THEN 0L END AS recorder_id"
    )
    return lookup.lookup_any_key(
        events,
        "user_id",
        users(spark, sf),
        ["first_id", "second_id"],
        {"recorder_id": "user_id"},
        only_null="recorder_id",
        dim_where="name <> 'Customer#000000003'",
        row_key=["event_id"],
    )


@check(
    "null_on_match",
    """SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE o_custkey END AS o_custkey
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def null_on_match(spark, sf):
    return lookup.null_on_match(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        table(spark, sf, "customer"),
        {"o_custkey": "c_custkey"},
        "o_custkey",
        dim_where="c_acctbal < 0",
        row_key=["o_orderkey"],
    )


@check(
    "exists_guard",
    f"""WITH {FACTS_SQL} SELECT id, custkey, status, day, nation,
        CASE WHEN segment IS NULL AND status NOT IN ('F', 'P') AND EXISTS (SELECT 1 FROM supplier
            WHERE s_acctbal > 0) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal < -1e9)
            THEN 'FILLED' ELSE segment END AS segment FROM facts""",
)
def exists_guard(spark, sf):
    supplier = table(spark, sf, "supplier")
    rows, wanted = facts(spark, sf), F.col("segment").isNull() & ~F.col("status").isin("F", "P")
    rows = lookup.set_if_exists(
        rows, supplier.filter("s_acctbal > 0"), {"segment": F.lit("FILLED")}, wanted
    )
    return lookup.set_if_exists(
        rows, supplier.filter("s_acctbal < -1e9"), {"segment": F.lit("NEVER")}, wanted
    )


@check(
    "identity_repair",
    """WITH core AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN
            c_acctbal > 5000 THEN 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
            ELSE c_name END AS email, c_mktsegment AS username FROM customer)
    SELECT id, CASE WHEN s_name <> email THEN s_name ELSE email END AS email,
        CASE WHEN s_name <> email THEN 'S' || s_nationkey ELSE username END AS username
    FROM core LEFT JOIN supplier ON id = s_suppkey""",
)
def identity_repair(spark, sf):
    core = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal > 5000 "
        "THEN concat('Supplier#', lpad(c_custkey, 9, '0')) ELSE c_name END AS email",
        "c_mktsegment AS username",
    )
    provider = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS email", "concat('S', s_nationkey) AS username"
    )
    return lookup.repair_identity(
        core, provider, {"id": "id"}, "email", ["email", "username"], row_key=["id"]
    )


_REMOTE_CORE = """SELECT CAST(o_orderkey AS VARCHAR) AS payment_external_id,
        CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS remote_id FROM orders"""


def remote_core(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey AS string) AS payment_external_id",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS remote_id",
    )


@check(
    "remote_id_writeback",
    f"""WITH core AS ({_REMOTE_CORE}), ids AS (SELECT CAST(l_orderkey AS VARCHAR) AS k,
        CAST(min(CAST(l_partkey AS VARCHAR)) AS BIGINT) AS id FROM lineitem
        WHERE l_returnflag <> 'R' GROUP BY 1)
    SELECT payment_external_id, coalesce(id, remote_id) AS remote_id FROM core
    LEFT JOIN ids ON payment_external_id = k""",
)
def remote_id_writeback(spark, sf):
    ids = table(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS payment_external_id",
        "CASE WHEN l_returnflag <> 'R' THEN cast(l_partkey AS string) END AS ID",
    )
    return lookup.write_back(remote_core(spark, sf), ids, "payment_external_id")


@check(
    "remote_id_backfill",
    f"""WITH core AS ({_REMOTE_CORE}) SELECT payment_external_id, coalesce(e.user_id, remote_id)
        AS remote_id FROM core LEFT JOIN events e
        ON payment_external_id = CAST(e.event_id AS VARCHAR)""",
)
def remote_id_backfill(spark, sf):
    """From a repair file: text columns, one row per key."""
    fixes = table(spark, sf, "events").selectExpr(
        "cast(event_id AS string) AS payment_external_id", "cast(user_id AS string) AS ID"
    )
    return lookup.write_back(remote_core(spark, sf), fixes, "payment_external_id")


@check(
    "count_fill",
    """WITH acc AS (SELECT c_custkey AS k, CASE c_mktsegment WHEN 'BUILDING' THEN NULL
            WHEN 'MACHINERY' THEN 'angaza' ELSE 'upya' END AS sys, c_nationkey AS payments
            FROM customer), n AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
    SELECT acc.k, sys, CASE WHEN sys <> 'angaza' THEN CAST(coalesce(n, 0) AS INTEGER)
        ELSE payments END AS payments FROM acc LEFT JOIN n ON acc.k = n.k""",
)
def count_fill(spark, sf):
    accounts = table(spark, sf, "customer").selectExpr(
        "c_custkey AS k",
        "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'angaza' "
        "ELSE 'upya' END AS sys",
        "c_nationkey AS payments",
    )
    orders = table(spark, sf, "orders").selectExpr("o_custkey AS k")
    return aggregate.count_fill(accounts, orders, "k", "payments", F.col("sys") != "angaza")


@check(
    "new_members",
    """WITH dim AS (SELECT DISTINCT p_brand AS product, p_brand AS external_name FROM part),
    src AS (SELECT 'Brand#' || CAST(l_quantity AS INTEGER) AS product FROM lineitem
        UNION SELECT nullif(p_type, 'SMALL') FROM part)
    SELECT * FROM dim UNION ALL SELECT product, product FROM src
    WHERE product IS NOT NULL AND product NOT IN (SELECT product FROM dim)""",
)
def new_members(spark, sf):
    part = table(spark, sf, "part")
    known = part.selectExpr("p_brand AS product", "p_brand AS external_name").distinct()
    lines = table(spark, sf, "lineitem").selectExpr(
        "concat('Brand#', cast(l_quantity AS int)) AS product"
    )
    types = part.selectExpr("nullif(p_type, 'SMALL') AS product")
    names = {"product": "product", "external_name": "product"}
    return aggregate.new_members(known, [lines, types], "product", names)


@check(
    "new_members_pair",
    """WITH dim AS (SELECT DISTINCT p_brand AS product, 'Q' || p_size AS grp FROM part),
    first AS (SELECT DISTINCT l_returnflag AS product, 'Q' || CAST(l_quantity * 2 AS INTEGER) AS grp
        FROM lineitem),
    one AS (SELECT * FROM dim UNION ALL SELECT * FROM first
        WHERE grp NOT IN (SELECT grp FROM dim)),
    second AS (SELECT DISTINCT c_mktsegment AS product, 'Q' || (c_nationkey * 3 + 40) AS grp
        FROM customer)
    SELECT * FROM one UNION ALL SELECT * FROM second WHERE grp NOT IN (SELECT grp FROM one)""",
)
def new_members_pair(spark, sf):
    part = table(spark, sf, "part")
    known = part.selectExpr("p_brand AS product", "concat('Q', p_size) AS grp").distinct()
    first = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS product", "concat('Q', cast(l_quantity * 2 AS int)) AS grp"
    )
    second = table(spark, sf, "customer").selectExpr(
        "c_mktsegment AS product", "concat('Q', c_nationkey * 3 + 40) AS grp"
    )
    return aggregate.new_member_pairs(known, [first, second], "grp", ["product", "grp"])


_ACCOUNT_SQL = """src AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(18,2)) AS recurring,
        CASE WHEN o_orderpriority <> '5-LOW' THEN length(o_orderpriority) - 8 END AS days,
        CASE WHEN o_orderstatus = 'P' THEN CAST(0.25 AS DECIMAL(18,8)) END AS given,
        o_orderdate AS registered, CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS unlock,
        CASE WHEN o_custkey > 100 THEN CAST(o_custkey / 10.0 AS DECIMAL(18,8)) END AS included
    FROM orders), paid AS (SELECT l_orderkey, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid
        FROM lineitem GROUP BY 1)"""


def derived_accounts(spark, sf):
    """Orders as accounts: paid is the price of their largest line, terms follow from the priority."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "cast(cast(o_totalprice AS decimal(18,2)) AS decimal(18,8)) AS recurring_amount",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN length(o_orderpriority) - 8 END "
        "AS days_per_recurring_amount",
        "CASE WHEN o_orderstatus = 'P' THEN cast(0.25 AS decimal(18,8)) END AS hour_price",
        "o_orderdate AS registration_date_utc",
        "o_orderdate AS date_of_disablement_utc",
        "cast(12.5 AS decimal(18,8)) AS upfront_price",
        "cast(cast(o_totalprice AS decimal(18,2)) * 2 AS decimal(18,8)) AS unlock_price",
        "CASE WHEN o_custkey > 100 THEN cast(o_custkey / 10.0 AS decimal(18,8)) END "
        "AS upfront_days_included",
        "CASE WHEN o_orderstatus = 'F' THEN 'upya' ELSE 'angaza' END AS external_sys",
        "nullif(o_orderpriority, '2-HIGH') AS linked_account_external_id",
        "cast(o_custkey AS decimal(18,8)) AS cumulative_activation_days",
    )
    paid = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,8)").alias("total_paid")
    )
    return orders.join(paid, orders.id == paid.l_orderkey, "left").drop("l_orderkey")


@check(
    "derive_arrears",
    f"""WITH {_ACCOUNT_SQL}, a AS (SELECT *, CASE WHEN days IS NOT NULL AND days <> 0 AND given IS
            NULL THEN CAST(recurring / days / 24 AS DECIMAL(18,8)) ELSE given END AS hourly,
            CAST(date_diff('day', registered, TIMESTAMP '2002-01-01') AS DECIMAL(18,8)) AS age
            FROM src LEFT JOIN paid ON id = l_orderkey),
    b AS (SELECT *, CASE WHEN hourly > 0 THEN least(CAST(12.5 + CAST(24 * hourly AS DECIMAL(18,8)) *
            greatest(age - included, CAST(0 AS DECIMAL(18,8))) AS DECIMAL(18,8)),
            CAST(unlock AS DECIMAL(18,8))) END AS expected FROM a)
    SELECT id, CAST(hourly AS DOUBLE) AS hour_price, CAST(expected AS DOUBLE) AS expected_paid,
        CAST(greatest(CAST(0 AS DECIMAL(18,8)), CAST(expected - paid AS DECIMAL(18,8))) AS DOUBLE)
            AS amount_in_arrears,
        CAST(CAST(unlock - paid AS DECIMAL(18,8)) AS DOUBLE) AS outstanding_amount FROM b""",
)
def derive_arrears(spark, sf):
    as_of = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
    figures = derive.account_figures(derived_accounts(spark, sf), as_of, disabled_for="upya")
    amounts = ["hour_price", "expected_paid", "amount_in_arrears", "outstanding_amount"]
    return figures.select("id", *[F.col(c).cast("double").alias(c) for c in amounts])


@check(
    "derive_disabled",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority =
        '2-HIGH' THEN greatest(date_diff('microsecond', o_orderdate, TIMESTAMP '2000-01-01 12:00:00')
        / 86400000000.0 - CAST(o_custkey AS DOUBLE), 0.0) ELSE 0.0 END END AS days_disabled
    FROM orders""",
)
def derive_disabled(spark, sf):
    as_of = F.lit("2000-01-01 12:00:00").cast("timestamp_ntz")
    figures = derive.account_figures(derived_accounts(spark, sf), as_of, disabled_for="upya")
    return figures.select("id", F.col("cumulative_days_disabled").alias("days_disabled"))


@check(
    "elapsed_days",
    """SELECT event_id,
        date_diff('microsecond', ts, TIMESTAMP '2024-01-20 10:30:00') / 86400000000.0 AS since,
        date_diff('microsecond', TIMESTAMP '2024-01-20 10:30:00', ts) / 86400000000.0 AS until
    FROM events""",
)
def elapsed(spark, sf):
    as_of = F.lit("2024-01-20 10:30:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id",
        elapsed_days(as_of, F.col("ts")).alias("since"),
        elapsed_days(F.col("ts"), as_of).alias("until"),
    )


@check(
    "conditional_null",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN NULL
        ELSE o_custkey END AS o_custkey, CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN NULL
        ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders""",
)
def conditional_null(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    hit = F.col("o_orderpriority").isin("5-LOW", "2-HIGH")
    return derive.set_where(rows, hit, o_custkey=None, o_orderstatus=None)


@check(
    "conditional_set",
    """SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 AND nullif(c_mktsegment, 'BUILDING')
        IS NOT NULL THEN 'angaza and upya' ELSE c_name END AS external_sys FROM customer""",
)
def conditional_set(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_nationkey", "c_name AS external_sys", "c_acctbal", "c_mktsegment"
    )
    both = (F.col("c_acctbal") > 0) & F.expr("nullif(c_mktsegment, 'BUILDING')").isNotNull()
    return derive.set_where(rows, both, external_sys=F.lit("angaza and upya")).select(
        "c_custkey", "c_nationkey", "external_sys"
    )
