"""The post-upsert rules of each table, and a whole accounts run.

Roles of the given tables: orders are accounts, line items payments, customers
clients, parts stock, suppliers users, events applications, nations countries.
"""

from __future__ import annotations

from datetime import datetime
from functools import cache

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyloom.plans import prep
from tallyloom.plans.context import Context, core_schema, instant, shaped
from tallyloom.plans.rules import apply_rules, derive_replacements
from tallyloom.plans.table_run import Workspace, conform_extract, upsert_staged
from tallyloom.session import scratch_path
from tallyloom.sources.snapshots import Store
from tallyloom.spec import Field, Mapping, Provider, TableFeed

AS_OF = datetime(2002, 1, 1)
PROVIDER = Provider(
    "upya", "house", "NATION_7", tables={"accounts": TableFeed(rules="accounts")}
)

MAPS = """VALUES ('ACCOUNT_STATUS', '1-URGENT', 'DETACHED'), ('ACCOUNT_STATUS', '2-HIGH',
    'WRITTEN_OFF'), ('ACCOUNT_STATUS', '3-MEDIUM', 'ACTIVE'), ('PRODUCT', 'O', 'Open kit'),
    ('PRODUCT', 'P', NULL), ('PRODUCT', 'ECONOMY', 'Eco'), ('TRANSIT_STATE', 'Brand#1', 'STORE'),
    ('APPLICATION_STATUS', 'view', 'APPROVAL_PENDING'), ('APPLICATION_STATUS', 'click', 'DEPLOYED')"""


def _accounts(name: str, kind: str, source: str = "", **flags: bool) -> Field:
    return Field("accounts", name, kind, {"upya": source} if source else {}, **flags)


MAPPING = Mapping(
    (
        Field("all", "external_sys", "TEXT", {"upya": "external_sys"}),
        Field("all", "organization", "TEXT", {"upya": "organization"}),
        Field("all", "country", "TEXT", {"upya": "country"}),
        Field("all", "remote_id", "BIGINT"),
        _accounts("account_id", "INT", surrogate=True),
        _accounts("account_external_id", "TEXT", "contractNumber", business_key=True),
        _accounts("unit_number", "TEXT", "paygNumber"),
        _accounts("asset_number", "TEXT", "unitSerialNumber"),
        _accounts("linked_account_external_id", "TEXT", "linkedTo.contractNumber"),
        _accounts("product", "TEXT", "product.name"),
        _accounts("account_status", "TEXT", "status"),
        _accounts("registration_date_utc", "TIMESTAMPTZ", "signingDate"),
        _accounts("registering_user_id", "INT"),
        _accounts("registering_user", "TEXT"),
        _accounts("registering_user_external_id", "TEXT", "recorder"),
        _accounts("upfront_price", "DECIMAL", "pricingSchedule.upfrontPayment"),
        _accounts("upfront_days_included", "DECIMAL", "pricingSchedule.upfrontDays"),
        _accounts("unlock_price", "DECIMAL", "totalCost"),
        _accounts("days_per_recurring_amount", "INT", "pricingSchedule.freq"),
        _accounts("recurring_amount", "DECIMAL", "pricingSchedule.recurrentPayment"),
        _accounts("total_paid", "DECIMAL", "totalPaid"),
        _accounts("outstanding_amount", "DECIMAL"),
        _accounts("hour_price", "DECIMAL"),
        _accounts("date_of_disablement_utc", "TIMESTAMPTZ", "nextStatusUpdate"),
        _accounts("number_of_payments", "INT"),
        _accounts("cumulative_activation_days", "DECIMAL", "totalDaysActivated"),
        _accounts("responsible_user_id", "INT"),
        _accounts("responsible_user", "TEXT"),
        _accounts("responsible_user_external_id", "TEXT", "respAgent"),
        _accounts("client_id", "INT"),
        _accounts("client_external_id", "TEXT", "client.clientNumber"),
        _accounts("application_id", "TEXT"),
        _accounts("application_external_id", "TEXT"),
        _accounts("owner_name", "TEXT", "client.profile.firstName+client.profile.lastName"),
    )
)


def context(spark, sf, **tables) -> Context:
    """The other tables, as far as the rules read them."""
    sources = {
        "columnmaps": lambda: spark.sql(f"SELECT * FROM {MAPS} AS maps(col, val, target)"),
        "country": lambda: table(spark, sf, "nation").selectExpr(
            "n_name AS country_name", "n_nationkey AS country_id"
        ),
        "payments": lambda: table(spark, sf, "lineitem").selectExpr(
            "CASE WHEN l_returnflag <> 'R' THEN concat('A', l_orderkey) END AS account_external_id"
        ),
        "clients": lambda: table(spark, sf, "customer").selectExpr(
            "concat('C', c_custkey) AS client_external_id", "cast(c_custkey AS int) AS client_id"
        ),
        "stock": lambda: table(spark, sf, "part").selectExpr(
            "concat('S', p_partkey) AS asset_number",
            "CASE WHEN p_size > 25 THEN 'upya' ELSE 'angaza' END AS external_sys",
            "cast(p_partkey AS int) AS stock_id",
        ),
        "users": lambda: table(spark, sf, "supplier").selectExpr(
            "cast(s_suppkey AS int) AS user_id",
            "cast(s_suppkey * 3 AS string) AS user_angaza_id",
            "cast(s_suppkey AS string) AS user_upya_id",
            "s_name AS full_name",
            "concat('u', s_suppkey) AS username",
        ),
        "webusers": lambda: table(spark, sf, "customer").selectExpr(
            "CASE WHEN c_acctbal > 0 THEN cast(c_custkey AS int) END AS webuser_id",
            "cast(c_custkey AS string) AS webuser_angaza_id",
            "cast(c_custkey + 50 AS string) AS webuser_upya_id",
            "c_name AS webuser_fullname",
        ),
        "applications": lambda: table(spark, sf, "events").selectExpr(
            "concat('A', user_id) AS account_external_id",
            "cast(event_id AS string) AS application_id",
            "concat('P', event_id) AS application_external_id",
        ),
        "accounts": lambda: table(spark, sf, "orders").selectExpr(
            "cast(o_orderkey AS int) AS account_id",
            "concat('A', o_orderkey) AS account_external_id",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN concat('U', o_orderkey) END AS unit_number",
            "CASE WHEN o_orderstatus <> 'P' THEN concat('S', o_custkey) END AS asset_number",
            "CASE WHEN o_orderstatus = 'F' THEN 'upya' ELSE 'angaza' END AS external_sys",
            "nullif(o_orderpriority, '2-HIGH') AS pricing_group",
            "cast(o_custkey AS int) AS responsible_user_id",
            "concat('R', o_custkey) AS responsible_user_external_id",
        ),
    }
    return Context(cache(lambda name: (tables.get(name) or sources[name])()), instant(AS_OF))


CONTEXT_SQL = f"""maps AS (SELECT * FROM ({MAPS}) AS maps(col, val, target)),
users AS (SELECT CAST(s_suppkey AS INTEGER) AS user_id, CAST(s_suppkey * 3 AS VARCHAR) AS
    user_angaza_id, CAST(s_suppkey AS VARCHAR) AS user_upya_id, s_name AS full_name,
    'u' || s_suppkey AS username FROM supplier),
user_keys AS (SELECT k, min(user_id) AS user_id FROM (SELECT user_angaza_id AS k, user_id FROM users
    UNION ALL SELECT user_upya_id, user_id FROM users) GROUP BY 1),
found_user AS (SELECT k, user_keys.user_id, full_name FROM user_keys JOIN users USING (user_id)),
accounts AS (SELECT CAST(o_orderkey AS INTEGER) AS account_id, 'A' || o_orderkey AS
    account_external_id, CASE WHEN o_orderpriority <> '5-LOW' THEN 'U' || o_orderkey END AS
    unit_number, CASE WHEN o_orderstatus <> 'P' THEN 'S' || o_custkey END AS asset_number,
    CASE WHEN o_orderstatus = 'F' THEN 'upya' ELSE 'angaza' END AS external_sys,
    nullif(o_orderpriority, '2-HIGH') AS pricing_group,
    CAST(o_custkey AS INTEGER) AS responsible_user_id,
    'R' || o_custkey AS responsible_user_external_id FROM orders)"""


# -- accounts: extract to enriched core -------------------------------------


def accounts_extract(spark, sf):
    """Orders as a provider's account extract: dotted headers, every value text."""
    return table(spark, sf, "orders").selectExpr(
        "concat('A', o_orderkey) AS contractNumber",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE concat('U', o_orderkey) END "
        "AS paygNumber",
        "concat('S', o_custkey) AS unitSerialNumber",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN 'None' ELSE concat('L', o_orderkey) END "
        "AS `linkedTo.contractNumber`",
        "o_orderstatus AS `product.name`",
        "o_orderpriority AS status",
        "cast(o_orderdate AS string) AS signingDate",
        "cast(o_custkey AS string) AS recorder",
        "'12.5' AS `pricingSchedule.upfrontPayment`",
        "CASE WHEN o_custkey > 100 THEN '7' ELSE '' END AS `pricingSchedule.upfrontDays`",
        "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS totalCost",
        "cast(length(o_orderpriority) - 8 AS string) AS `pricingSchedule.freq`",
        "cast(cast(cast(o_totalprice AS decimal(18,2)) * 0.1 AS decimal(18,4)) AS string) "
        "AS `pricingSchedule.recurrentPayment`",
        "cast(cast(cast(o_totalprice AS decimal(18,2)) * 0.25 AS decimal(18,4)) AS string) AS totalPaid",
        "cast(o_orderdate AS string) AS nextStatusUpdate",
        "cast(o_custkey AS string) AS totalDaysActivated",
        "cast(o_orderkey AS string) AS respAgent",
        "concat('C', o_custkey) AS `client.clientNumber`",
        "'Ann' AS `client.profile.firstName`",
        "concat(o_orderstatus, '<undefined>') AS `client.profile.lastName`",
        "cast(NULL AS string) AS `repossessed.date`",
    )


def accounts_core(spark, sf):
    """Customers as the accounts held so far, on every 20th account key."""
    rows = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey AS int) AS account_id",
        "concat('A', c_custkey * 20) AS account_external_id",
        "concat('OLD', c_custkey) AS unit_number",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'angaza' WHEN 'MACHINERY' THEN NULL "
        "ELSE 'upya_uganda' END AS external_sys",
        "concat('NATION_', c_nationkey) AS country",
        "cast(cast(c_acctbal AS decimal(18,2)) AS decimal(18,8)) AS unlock_price",
        "cast(10 AS decimal(18,8)) AS total_paid",
        "5 AS number_of_payments",
        "CASE WHEN c_acctbal > 0 THEN c_nationkey END AS client_id",
        "CASE WHEN c_nationkey > 12 THEN -1 END AS country_id",
        "false AS archived",
        "c_custkey AS remote_id",
    )
    return shaped(rows, core_schema(MAPPING, "accounts"))


_SHOWN = (
    "account_external_id account_id unit_number asset_number account_status product "
    "number_of_payments client_id stock_id application_id application_external_id "
    "registering_user_id registering_user responsible_user_id responsible_user country_id "
    "owner_name archived remote_id external_sys"
).split()
_AMOUNTS = "hour_price expected_paid amount_in_arrears outstanding_amount".split()
_DAYS = "days_since_registration cumulative_days_disabled days_to_cutoff".split()

_NUM = "DECIMAL(18,8)"


@check(
    "accounts_run",
    f"""WITH {CONTEXT_SQL},
    core AS (SELECT CAST(c_custkey AS INTEGER) AS account_id, 'A' || (c_custkey * 20) AS k,
        'OLD' || c_custkey AS unit, CASE c_mktsegment WHEN 'BUILDING' THEN 'angaza'
        WHEN 'MACHINERY' THEN NULL ELSE 'upya_uganda' END AS sys, 'NATION_' || c_nationkey AS country,
        CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {_NUM}) AS unlock, CAST(10 AS {_NUM}) AS paid,
        CASE WHEN c_acctbal > 0 THEN c_nationkey END AS client_id,
        CASE WHEN c_nationkey > 12 THEN -1 END AS country_id, c_custkey AS remote_id FROM customer),
    staged AS (SELECT *, 'A' || o_orderkey AS k, length(o_orderpriority) - 8 AS freq,
        CASE WHEN o_custkey > 100 THEN 7 END AS included,
        CAST(o_totalprice AS DECIMAL(18,2)) AS cost,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,4)) AS recurring,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,4)) AS spaid FROM orders),
    serial AS (SELECT k, CAST((SELECT max(account_id) FROM core) + row_number() OVER (ORDER BY k)
        AS INTEGER) AS id FROM staged WHERE k NOT IN (SELECT k FROM core)),
    merged AS (SELECT coalesce(s.k, c.k) AS k, s.k IS NOT NULL AS hit,
        coalesce(c.account_id, serial.id) AS account_id,
        CASE WHEN s.k IS NULL THEN c.unit WHEN o_orderpriority <> '5-LOW' THEN 'U' || o_orderkey END
            AS unit, 'S' || o_custkey AS asset, coalesce(st.target, o_orderpriority) AS status,
        CASE WHEN p.val IS NOT NULL THEN p.target ELSE o_orderstatus END AS product,
        CASE WHEN s.k IS NULL THEN c.sys ELSE 'upya' END AS sys,
        CASE WHEN s.k IS NULL THEN c.country ELSE 'NATION_7' END AS country,
        CASE WHEN s.k IS NULL THEN c.unlock ELSE s.cost END AS unlock,
        CASE WHEN s.k IS NULL THEN c.paid ELSE s.spaid END AS paid,
        freq, included, recurring, o_orderdate, o_custkey, o_orderkey, o_orderpriority,
        c.client_id, c.country_id, c.remote_id, 'Ann ' || o_orderstatus AS owner
        FROM core c FULL JOIN staged s ON c.k = s.k LEFT JOIN serial ON serial.k = s.k
        LEFT JOIN maps st ON st.col = 'ACCOUNT_STATUS' AND st.val = o_orderpriority
        LEFT JOIN maps p ON p.col = 'PRODUCT' AND p.val = o_orderstatus),
    priced AS (SELECT *, CASE WHEN freq <> 0 THEN CAST(recurring / freq / 24 AS {_NUM}) END AS hourly,
        date_diff('microsecond', o_orderdate, TIMESTAMP '2002-01-01') / 86400000000.0 AS age
        FROM merged),
    due AS (SELECT *, CASE WHEN hourly > 0 THEN least(CAST(12.5 + CAST(24 * hourly AS {_NUM}) *
        greatest(CAST(CAST(age AS {_NUM}) - included AS DECIMAL(20,8)), CAST(0 AS {_NUM})) AS {_NUM}),
        CAST(unlock AS {_NUM})) END AS expected FROM priced),
    paid AS (SELECT 'A' || l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R'
        GROUP BY 1),
    apps AS (SELECT 'A' || user_id AS k, min(CAST(event_id AS VARCHAR)) AS app FROM events
        GROUP BY 1)
    SELECT due.k AS account_external_id, account_id,
        CASE WHEN status IN ('DETACHED', 'WRITTEN_OFF') THEN NULL WHEN unit IS NULL AND status NOT IN
            ('DETACHED', 'WRITTEN_OFF') THEN asset ELSE unit END AS unit_number,
        asset AS asset_number, status AS account_status, product,
        CAST(CASE WHEN sys <> 'angaza' THEN coalesce(paid.n, 0) ELSE 5 - CASE WHEN hit THEN 5 ELSE 0
            END END AS INTEGER) AS number_of_payments,
        coalesce(due.client_id, CAST(c_custkey AS INTEGER)) AS client_id,
        CASE WHEN status IN ('DETACHED', 'WRITTEN_OFF') THEN NULL ELSE CAST(p_partkey AS INTEGER) END
            AS stock_id, app AS application_id, 'P' || app AS application_external_id,
        u.user_id AS registering_user_id, u.full_name AS registering_user,
        r.user_id AS responsible_user_id, r.full_name AS responsible_user,
        coalesce(due.country_id, n_nationkey) AS country_id, owner AS owner_name, FALSE AS archived,
        remote_id, sys AS external_sys, CAST(hourly AS DOUBLE) AS hour_price,
        CAST(expected AS DOUBLE) AS expected_paid,
        CAST(greatest(CAST(0 AS {_NUM}), CAST(expected - due.paid AS {_NUM})) AS DOUBLE)
            AS amount_in_arrears,
        CAST(CAST(unlock - due.paid AS {_NUM}) AS DOUBLE) AS outstanding_amount,
        age AS days_since_registration,
        CASE WHEN sys = 'upya' THEN CASE WHEN o_orderpriority = '2-HIGH'
            THEN greatest(age - o_custkey, 0.0) ELSE 0.0 END END AS cumulative_days_disabled,
        -age AS days_to_cutoff, CASE WHEN hit THEN TIMESTAMP '2002-01-01' END AS change_timestamp
    FROM due LEFT JOIN paid ON paid.k = due.k AND sys <> 'angaza'
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN part ON p_partkey = o_custkey AND sys = CASE WHEN p_size > 25 THEN 'upya'
            ELSE 'angaza' END
        LEFT JOIN apps ON apps.k = due.k
        LEFT JOIN found_user u ON u.k = CAST(o_custkey AS VARCHAR)
        LEFT JOIN found_user r ON r.k = CAST(o_orderkey AS VARCHAR)
        LEFT JOIN nation ON n_name = country""",
)
def accounts_run(spark, sf):
    """Clean, map, type, upsert with serials for new accounts, then all account rules."""
    workspace = Workspace(None, MAPPING)
    staged = conform_extract(accounts_extract(spark, sf), MAPPING, PROVIDER, "accounts")
    merged = upsert_staged(
        workspace, accounts_core(spark, sf), staged, PROVIDER, "accounts", AS_OF
    )
    done = apply_rules(merged, "accounts", context(spark, sf))
    return done.select(
        *_SHOWN,
        *[F.col(c).cast("double").alias(c) for c in _AMOUNTS],
        *_DAYS,
        F.col("change_timestamp").cast("timestamp_ntz").alias("change_timestamp"),
    )


# -- the other rule sets ----------------------------------------------------


def _payments_sql(paid_at: str) -> str:
    return f"""WITH {CONTEXT_SQL},
    pay AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id,
        CASE WHEN l_returnflag <> 'R' THEN 'A' || l_orderkey END AS k, {paid_at} AS paid_at,
        CASE WHEN l_linestatus = 'F' THEN -1 END AS account_id,
        CASE WHEN l_quantity > 25 THEN 'own' END AS unit, nullif(l_returnflag, 'N') AS grp,
        CASE WHEN l_linenumber = 3 THEN 5 END AS uid, CASE WHEN l_linenumber = 4 THEN 'kept' END AS
        uname, CASE WHEN l_tax > 0.04 THEN 'angaza' WHEN l_tax > 0.02 THEN 'upya' ELSE 'upya_uganda'
        END AS sys, 'NATION_' || l_suppkey AS country, CASE WHEN l_discount > 0.05 THEN -7 END AS cid
        FROM lineitem),
    one AS (SELECT pay.*, a.account_id AS aid, a.unit_number AS aunit, a.pricing_group AS agrp,
        a.account_external_id IS NOT NULL AS hit,
        CASE WHEN uid IS NULL AND paid_at >= TIMESTAMP '2020-02-22' THEN a.responsible_user_id ELSE uid
            END AS ruid, CASE WHEN a.account_external_id IS NOT NULL AND uid IS NULL AND paid_at >= TIMESTAMP '2020-02-22'
            THEN a.responsible_user_external_id ELSE 'ext' END AS rext
        FROM pay LEFT JOIN accounts a ON a.account_external_id = k)
    SELECT id AS payment_external_id, coalesce(one.account_id, aid) AS account_id,
        coalesce(unit, aunit) AS unit_number,
        CASE WHEN hit AND grp IS NOT NULL THEN agrp ELSE grp END AS pricing_group,
        ruid AS responsible_user_id,
        CASE WHEN uname IS NULL AND u.user_id IS NOT NULL THEN u.username ELSE uname END
            AS responsible_user,
        CASE WHEN uname IS NULL AND u.user_id IS NOT NULL THEN CASE sys WHEN 'angaza' THEN
            u.user_angaza_id WHEN 'upya' THEN u.user_upya_id END ELSE rext END
            AS responsible_user_ext_id, coalesce(cid, n_nationkey) AS country_id
    FROM one LEFT JOIN users u ON u.user_id = ruid LEFT JOIN nation ON n_name = country"""


def paid(spark, sf, paid_at: str):
    payments = table(spark, sf, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS payment_external_id",
        "CASE WHEN l_returnflag <> 'R' THEN concat('A', l_orderkey) END AS account_external_id",
        f"cast({paid_at} AS timestamp) AS effective_utc",
        "CASE WHEN l_linestatus = 'F' THEN -1 END AS account_id",
        "CASE WHEN l_quantity > 25 THEN 'own' END AS unit_number",
        "nullif(l_returnflag, 'N') AS pricing_group",
        "CASE WHEN l_linenumber = 3 THEN 5 END AS responsible_user_id",
        "CASE WHEN l_linenumber = 4 THEN 'kept' END AS responsible_user",
        "'ext' AS responsible_user_ext_id",
        "CASE WHEN l_tax > 0.04 THEN 'angaza' WHEN l_tax > 0.02 THEN 'upya' "
        "ELSE 'upya_uganda' END AS external_sys",
        "concat('NATION_', l_suppkey) AS country",
        "CASE WHEN l_discount > 0.05 THEN -7 END AS country_id",
    )
    done = apply_rules(payments, "payments", context(spark, sf))
    return done.drop("account_external_id", "effective_utc", "external_sys", "country")


@check("payments_rules", _payments_sql("l_shipdate"))
def payments_rules(spark, sf):
    return paid(spark, sf, "l_shipdate")


@check("payments_assigned", _payments_sql("l_shipdate + INTERVAL 20 YEAR"))
def payments_assigned(spark, sf):
    """The same payments twenty years on: most are due to the user of their account."""
    return paid(spark, sf, "l_shipdate + INTERVAL 20 YEAR")


@check(
    "applications_rules",
    f"""WITH {CONTEXT_SQL},
    app AS (SELECT event_id, 'A' || (event_id * 2) AS id, coalesce(m.target, event_type) AS status,
        CASE WHEN event_type <> 'view' OR user_id > 75 THEN 'A' || user_id END AS k,
        CASE WHEN value > 50 THEN 'upya' ELSE 'upya_uganda' END AS sys, user_id,
        CASE WHEN event_type = 'error' THEN 3 END AS nid, 'NATION_' || user_id AS country
        FROM events LEFT JOIN maps m ON m.col = 'APPLICATION_STATUS' AND m.val = event_type),
    st AS (SELECT *, CASE WHEN k IS NOT NULL AND status = 'APPROVAL_PENDING' THEN 'APPROVED'
        ELSE status END AS status2, CASE WHEN sys = 'upya_uganda' AND k IS NULL THEN NULL
        ELSE 'ACTIVE' END AS acc_status FROM app),
    keyed AS (SELECT st.*, coalesce(a.account_external_id, k) AS k2 FROM st
        LEFT JOIN accounts a ON a.account_external_id = st.id),
    web AS (SELECT k, min(id) AS wid FROM (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey AS id
        FROM customer WHERE c_acctbal > 0 UNION ALL SELECT CAST(c_custkey + 50 AS VARCHAR), c_custkey
        FROM customer WHERE c_acctbal > 0) GROUP BY 1)
    SELECT keyed.id AS application_external_id, status2 AS status, acc_status AS account_status,
        k2 AS account_external_id, a.account_id,
        CASE WHEN a.account_external_id IS NOT NULL AND sys = 'upya' AND status2 = 'DEPLOYED'
            THEN a.unit_number ELSE 'staged' END AS unit_number,
        u.user_id AS recorder_id, u.full_name AS recorder, u.user_id AS responsible_user_id,
        CASE WHEN nid IS NULL THEN c_name END AS note_recorder,
        coalesce(nid, CAST(wid AS INTEGER)) AS note_recorder_id, n_nationkey AS country_id
    FROM keyed LEFT JOIN accounts a ON a.account_external_id = k2
        LEFT JOIN found_user u ON u.k = CAST(keyed.user_id AS VARCHAR)
        LEFT JOIN web ON web.k = CAST(keyed.user_id AS VARCHAR) AND nid IS NULL
        LEFT JOIN customer ON c_custkey = wid LEFT JOIN nation ON n_name = country""",
)
def applications_rules(spark, sf):
    applications = table(spark, sf, "events").selectExpr(
        "cast(event_id AS int) AS application_id",
        "concat('A', event_id * 2) AS application_external_id",
        "event_type AS status",
        "CASE WHEN event_type <> 'view' OR user_id > 75 THEN concat('A', user_id) END "
        "AS account_external_id",
        "'ACTIVE' AS account_status",
        "cast(NULL AS int) AS account_id",
        "'staged' AS unit_number",
        "CASE WHEN value > 50 THEN 'upya' ELSE 'upya_uganda' END AS external_sys",
        "cast(user_id AS string) AS recorder_ext_id",
        "cast(NULL AS int) AS recorder_id",
        "cast(NULL AS string) AS recorder",
        "cast(user_id AS string) AS note_recorder_external_id",
        "cast(NULL AS string) AS note_recorder",
        "CASE WHEN event_type = 'error' THEN 3 END AS note_recorder_id",
        "cast(user_id AS string) AS responsible_user_ext_id",
        "cast(NULL AS int) AS responsible_user_id",
        "concat('NATION_', user_id) AS country",
        "cast(NULL AS int) AS country_id",
    )
    done = apply_rules(applications, "applications", context(spark, sf))
    return done.drop(
        "application_id",
        "external_sys",
        "recorder_ext_id",
        "note_recorder_external_id",
        "responsible_user_ext_id",
        "country",
    )


@check(
    "clients_rules",
    f"""WITH {CONTEXT_SQL} SELECT 'C' || c_custkey AS client_external_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '0' ELSE left(nullif(regexp_replace(c_name ||
            CAST(c_nationkey * 1000001 AS VARCHAR), '[^0-9]', '', 'g'), ''), 12) END
            AS next_of_kin_contact_number,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 1.5 ELSE
            CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS client_latitude,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 2.5 ELSE CAST(c_nationkey AS DOUBLE) END
            AS client_longitude, user_id AS responsible_user_id, n_nationkey AS country_id
    FROM customer LEFT JOIN found_user ON k = CAST(c_custkey AS VARCHAR)
        LEFT JOIN nation ON n_name = 'NATION_' || (c_nationkey * 2)""",
)
def clients_rules(spark, sf):
    clients = table(spark, sf, "customer").selectExpr(
        "concat('C', c_custkey) AS client_external_id",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN concat(c_name, c_nationkey * 1000001) END "
        "AS next_of_kin_contact_number",
        "named_struct('lng', cast(c_nationkey AS double), 'lat', "
        "cast(cast(c_acctbal AS decimal(18,2)) AS double)) AS client_location_lnglat",
        "CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN cast(1.5 AS decimal(18,8)) END "
        "AS client_latitude",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN cast(2.5 AS decimal(18,8)) END "
        "AS client_longitude",
        "cast(c_custkey AS string) AS responsible_user_external_id",
        "cast(NULL AS int) AS responsible_user_id",
        "concat('NATION_', c_nationkey * 2) AS country",
        "cast(NULL AS int) AS country_id",
    )
    done = apply_rules(clients, "clients", context(spark, sf))
    return done.select(
        "client_external_id",
        "next_of_kin_contact_number",
        F.col("client_latitude").cast("double").alias("client_latitude"),
        F.col("client_longitude").cast("double").alias("client_longitude"),
        "responsible_user_id",
        "country_id",
    )


@check(
    "stock_rules",
    f"""WITH {CONTEXT_SQL},
    st AS (SELECT *, CASE WHEN p_size > 40 THEN NULL ELSE 'S' || p_partkey END AS asset,
        CASE WHEN p_size > 25 THEN 'upya' ELSE 'angaza' END AS sys FROM part),
    acc AS (SELECT asset_number, external_sys, min(account_id) AS account_id FROM accounts
        WHERE asset_number IS NOT NULL GROUP BY 1, 2),
    first AS (SELECT st.*, coalesce(acc.account_id, CASE WHEN p_size < 5 THEN
        CAST(p_partkey AS INTEGER) END) AS aid FROM st LEFT JOIN acc
        ON acc.asset_number = asset AND acc.external_sys = sys)
    SELECT 'T' || p_partkey AS stock_external_id,
        CASE WHEN asset IS NOT NULL AND p_type = 'ECONOMY' THEN 'Eco' ELSE p_type END AS product,
        CASE WHEN asset IS NOT NULL AND p_brand = 'Brand#1' THEN 'STORE' ELSE p_brand END
            AS transit_state,
        CASE WHEN gone.account_id IS NOT NULL THEN NULL ELSE aid END AS account_id,
        user_id AS holder_id, n_nationkey AS country_id
    FROM first LEFT JOIN accounts gone ON gone.account_id = aid AND gone.asset_number IS NULL
        LEFT JOIN found_user ON k = CAST(p_size AS VARCHAR)
        LEFT JOIN nation ON n_name = 'NATION_' || p_size""",
)
def stock_rules(spark, sf):
    stock = table(spark, sf, "part").selectExpr(
        "concat('T', p_partkey) AS stock_external_id",
        "CASE WHEN p_size <= 40 THEN concat('S', p_partkey) END AS asset_number",
        "CASE WHEN p_size > 25 THEN 'upya' ELSE 'angaza' END AS external_sys",
        "p_type AS product",
        "p_brand AS transit_state",
        "CASE WHEN p_size < 5 THEN cast(p_partkey AS int) END AS account_id",
        "cast(p_size AS string) AS holder_external_id",
        "cast(NULL AS int) AS holder_id",
        "concat('NATION_', p_size) AS country",
        "cast(NULL AS int) AS country_id",
    )
    done = apply_rules(stock, "stock", context(spark, sf))
    return done.drop("asset_number", "external_sys", "holder_external_id", "country")


@check(
    "users_rules",
    """SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 0 AND c_nationkey > 3
        THEN 'angaza and upya' ELSE c_mktsegment END AS external_sys FROM customer""",
)
def users_rules(spark, sf):
    users = table(spark, sf, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_mktsegment AS external_sys",
        "CASE WHEN c_acctbal > 0 THEN c_name END AS user_upya_id",
        "CASE WHEN c_nationkey > 3 THEN c_name END AS user_angaza_id",
    )
    done = apply_rules(users, "users", context(spark, sf))
    return done.select("user_id", "external_sys")


@check(
    "account_events_rules",
    """WITH src AS (SELECT doc_id AS id, 'REPLACED' AS kind, text AS info, NULL AS unit, NULL AS rid
        FROM documents UNION ALL SELECT page_id, lang, html, unit, rid FROM (SELECT page_id, html,
            CASE WHEN contains(url, '/en') THEN 'REPLACED' ELSE 'MOVED' END AS lang,
            CASE WHEN contains(url, '.org') THEN 'kept' END AS unit,
            CASE WHEN contains(url, 'https') THEN page_id END AS rid FROM pages)
        UNION ALL SELECT c_custkey, 'REPLACED', c_name, NULL, NULL FROM customer)
    SELECT id, kind AS event_type, CASE WHEN kind = 'REPLACED' AND unit IS NULL AND rid IS NULL
        THEN nullif(regexp_extract(info, '[0-9]{8}'), '') ELSE unit END AS replaced_unit_number
    FROM src""",
)
def account_events_rules(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id AS id", "'REPLACED' AS event_type", "text AS event_info"
    )
    pages = table(spark, sf, "pages").selectExpr(
        "page_id AS id",
        "CASE WHEN contains(url, '/en') THEN 'REPLACED' ELSE 'MOVED' END AS event_type",
        "html AS event_info",
        "CASE WHEN contains(url, '.org') THEN 'kept' END AS replaced_unit_number",
        "CASE WHEN contains(url, 'https') THEN page_id END AS remote_id",
    )
    names = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "'REPLACED' AS event_type", "c_name AS event_info"
    )
    events = pages.unionByName(docs, True).unionByName(names, True)
    done = apply_rules(events, "account_events", context(spark, sf))
    return done.select("id", "event_type", "replaced_unit_number")


# -- replacements -----------------------------------------------------------


def replacement_sources(spark, sf):
    accounts = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey AS int) AS account_id",
        "'upya' AS external_sys",
        "o_orderstatus AS product",
        "cast(o_custkey AS string) AS previous_unit_number",
        "cast(o_orderkey AS int) AS stock_id",
        "concat('U', o_orderkey) AS unit_number",
        "concat('S', o_orderkey) AS asset_number",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS date_of_replacement_utc",
        "'who' AS responsible_user",
        "cast(o_custkey AS int) AS responsible_user_id",
        "cast(o_custkey AS string) AS responsible_user_external_id",
    )
    stock = table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS stock_id",
        "cast(s_suppkey AS string) AS unit_number",
        "s_name AS asset_number",
        "s_acctbal < 0 AS archived",
    )
    known = table(spark, sf, "nation").selectExpr("concat('R', n_nationkey) AS replacement_external_id")
    return accounts, stock, known


@check(
    "derive_replacements",
    """SELECT 'R' || o_custkey AS replacement_external_id, 'upya' AS external_sys,
        o_orderstatus AS product, CAST(o_orderkey AS INTEGER) AS account_id,
        CAST(s_suppkey AS INTEGER) AS old_stock_id, CAST(s_suppkey AS VARCHAR) AS old_unit_number,
        s_name AS old_asset_number, CAST(o_orderkey AS INTEGER) AS new_stock_id,
        'U' || o_orderkey AS new_unit_number, 'S' || o_orderkey AS new_asset_number,
        o_orderdate AS replacement_date_utc, 'WEB' AS source_of_replacement,
        'who' AS acc_responsible_user, CAST(o_custkey AS INTEGER) AS acc_responsible_user_id,
        CAST(o_custkey AS VARCHAR) AS acc_responsible_user_ext_id
    FROM orders JOIN supplier ON s_suppkey = o_custkey WHERE o_orderpriority <> '5-LOW'
        AND NOT s_acctbal < 0 AND 'R' || o_custkey NOT IN (SELECT 'R' || n_nationkey FROM nation)""",
)
def replacements(spark, sf):
    return derive_replacements(*replacement_sources(spark, sf))


@check(
    "replacements_rules",
    f"""WITH {CONTEXT_SQL},
    rep AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS id, 'S' || l_suppkey AS
        asset, 'P' || l_partkey AS old_unit, 'P' || l_suppkey AS new_unit, l_suppkey FROM lineitem),
    stk AS (SELECT 'P' || p_partkey AS unit, CAST(p_partkey AS INTEGER) AS stock_id, 'S' || p_partkey
        AS asset FROM part WHERE p_size <= 25)
    SELECT rep.id AS replacement_external_id, CASE WHEN lone.asset_number IS NOT NULL THEN NULL
            ELSE 4 END AS account_id, n.stock_id AS new_stock_id,
        coalesce(n.asset, rep.asset) AS new_asset_number, o.stock_id AS old_stock_id,
        o.asset AS old_asset_number, u.user_id AS responsible_user_id,
        u.user_id AS acc_responsible_user_id
    FROM rep LEFT JOIN (SELECT DISTINCT asset_number FROM accounts WHERE unit_number IS NOT NULL
            AND external_sys = 'upya') lone ON lone.asset_number = rep.asset
        LEFT JOIN stk n ON n.unit = new_unit LEFT JOIN stk o ON o.unit = old_unit
        LEFT JOIN found_user u ON u.k = CAST(l_suppkey AS VARCHAR)""",
)
def replacements_rules(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey) AS replacement_external_id",
        "4 AS account_id",
        "concat('S', l_suppkey) AS new_asset_number",
        "concat('P', l_partkey) AS old_unit_number",
        "concat('P', l_suppkey) AS new_unit_number",
        "cast(NULL AS int) AS new_stock_id",
        "cast(NULL AS int) AS old_stock_id",
        "cast(NULL AS string) AS old_asset_number",
        "cast(l_suppkey AS string) AS responsible_user_ext_id",
        "cast(l_suppkey AS string) AS acc_responsible_user_ext_id",
        "cast(NULL AS int) AS responsible_user_id",
        "cast(NULL AS int) AS acc_responsible_user_id",
    )
    base = context(spark, sf)

    def lone_accounts():
        """Accounts of one system have no identifier yet."""
        return base.table("accounts").withColumn(
            "account_id", F.expr("CASE WHEN external_sys <> 'upya' THEN account_id END")
        )

    def units():
        return table(spark, sf, "part").selectExpr(
            "concat('P', p_partkey) AS unit_number",
            "concat('S', p_partkey) AS asset_number",
            "CASE WHEN p_size > 25 THEN 'upya' ELSE 'angaza' END AS external_sys",
            "cast(p_partkey AS int) AS stock_id",
        )

    ctx = context(spark, sf, accounts=lone_accounts, stock=units)
    done = apply_rules(rows, "replacements", ctx)
    return done.drop(
        "old_unit_number",
        "new_unit_number",
        "responsible_user_ext_id",
        "acc_responsible_user_ext_id",
    )


# -- prep steps -------------------------------------------------------------


@check(
    "products_prep",
    """WITH known AS (SELECT DISTINCT p_brand AS product, p_brand AS product_external_name FROM part),
    staged AS (SELECT 'Brand#' || CAST(l_quantity AS INTEGER) AS product FROM lineitem
        UNION SELECT o_orderpriority FROM orders UNION SELECT nullif(c_mktsegment, 'BUILDING')
        FROM customer)
    SELECT * FROM known UNION ALL SELECT product, product FROM staged
    WHERE product IS NOT NULL AND product NOT IN (SELECT product FROM known)""",
)
def products_prep(spark, sf):
    """Stock and accounts of several providers; one of them lacks the column."""
    known = table(spark, sf, "part").selectExpr(
        "p_brand AS product", "p_brand AS product_external_name"
    )
    staged = [
        table(spark, sf, "lineitem").selectExpr(
            "concat('Brand#', cast(l_quantity AS int)) AS product"
        ),
        table(spark, sf, "orders").selectExpr("o_orderpriority AS product"),
        table(spark, sf, "customer").selectExpr("nullif(c_mktsegment, 'BUILDING') AS product"),
        table(spark, sf, "supplier").selectExpr("s_name AS holder"),
    ]
    return prep.add_products(known.distinct(), staged)


@check(
    "pricing_groups_prep",
    """WITH known AS (SELECT DISTINCT p_brand AS product, p_type AS pricing_group FROM part),
    first AS (SELECT DISTINCT o_orderstatus AS product, o_orderpriority AS pricing_group FROM orders),
    one AS (SELECT * FROM known UNION ALL SELECT * FROM first
        WHERE pricing_group NOT IN (SELECT pricing_group FROM known)),
    second AS (SELECT DISTINCT c_mktsegment AS product, CASE WHEN c_acctbal > 0 THEN '2-HIGH'
        ELSE 'NEW' END AS pricing_group FROM customer)
    SELECT * FROM one UNION ALL SELECT * FROM second
    WHERE pricing_group NOT IN (SELECT pricing_group FROM one)""",
)
def pricing_groups_prep(spark, sf):
    known = table(spark, sf, "part").selectExpr("p_brand AS product", "p_type AS pricing_group")
    staged = [
        table(spark, sf, "orders").selectExpr(
            "o_orderstatus AS product", "o_orderpriority AS pricing_group"
        ),
        table(spark, sf, "customer").selectExpr(
            "c_mktsegment AS product",
            "CASE WHEN c_acctbal > 0 THEN '2-HIGH' ELSE 'NEW' END AS pricing_group",
        ),
    ]
    return prep.add_pricing_groups(known.distinct(), staged)


_PEOPLE_SQL = """WITH core AS (SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS number,
        nullif(c_name, 'Customer#000000003') AS email, c_mktsegment AS name FROM customer),
    one AS (SELECT id, number, CASE WHEN s_name <> email THEN s_name ELSE email END AS email,
        CASE WHEN s_name <> email THEN 'S' || s_nationkey ELSE name END AS name
        FROM core LEFT JOIN supplier ON id = s_suppkey),
    two AS (SELECT id, number, CASE WHEN n_name <> email THEN n_name ELSE email END AS email,
        CASE WHEN n_name <> email THEN 'N' || n_regionkey ELSE name END AS name
        FROM one LEFT JOIN nation ON id = n_nationkey)"""


def people(spark, sf, user_id: str, number: str, email: str, name: str):
    core = table(spark, sf, "customer").selectExpr(
        f"c_custkey AS {user_id}",
        f"cast(c_custkey AS string) AS {number}",
        f"nullif(c_name, 'Customer#000000003') AS {email}",
        f"c_mktsegment AS {name}",
    )
    staged = [
        table(spark, sf, "supplier").selectExpr(
            f"cast(s_suppkey AS string) AS {number}",
            f"s_name AS {email}",
            f"concat('S', s_nationkey) AS {name}",
        ),
        table(spark, sf, "nation").selectExpr(
            f"cast(n_nationkey AS string) AS {number}",
            f"n_name AS {email}",
            f"concat('N', n_regionkey) AS {name}",
        ),
    ]
    return core, staged


@check(
    "users_prep",
    f"{_PEOPLE_SQL} SELECT id AS user_id, number AS user_upya_id, email AS user_email, name AS "
    "username FROM two",
)
def users_prep(spark, sf):
    """Two providers repair the same users one after the other."""
    core, staged = people(spark, sf, "user_id", "user_upya_id", "user_email", "username")
    return prep.repair_users(core, staged)


@check(
    "webusers_prep",
    f"{_PEOPLE_SQL} SELECT id AS webuser_id, number AS webuser_upya_id, email AS webuser_email, "
    "name AS webuser_username FROM two",
)
def webusers_prep(spark, sf):
    core, staged = people(
        spark, sf, "webuser_id", "webuser_upya_id", "webuser_email", "webuser_username"
    )
    return prep.repair_webusers(core, staged)


@check(
    "staged_snapshot",
    """SELECT 'A' || o_orderkey AS account_external_id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN 'U' || o_orderkey END AS unit_number,
        'Ann ' || o_orderstatus AS owner_name, 'upya' AS external_sys FROM orders""",
)
def staged_snapshot(spark, sf):
    """A staging write that drops the wholly empty columns while it writes."""
    extract = accounts_extract(spark, sf).selectExpr(
        "contractNumber",
        "paygNumber",
        "`client.profile.firstName`",
        "`client.profile.lastName`",
        "'none' AS status",
        "'n/a' AS recorder",
    )
    staged = conform_extract(extract, MAPPING, PROVIDER, "accounts")
    store = Store(spark, scratch_path(spark, "staged"))
    kept = store.write_staging("upya", "accounts", "r1", staged)
    return kept.drop("organization", "country")
