"""Delivery, responses and the incremental run."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.ingest import AS_OF, ORDERS, PAYMENT_FIELDS, orders_text
from checks.registry import check, table
from tallyloom.operators import deliver, ledger, numbering, respond
from tallyloom.plans import delivery_run
from tallyloom.plans.table_run import Workspace
from tallyloom.session import scratch_path
from tallyloom.sources.snapshots import Store
from tallyloom.spec import Delivery, Field, Mapping
from tallyloom.streaming.upsert_stream import stream_upsert


def _out(name: str, kind: str) -> Field:
    return Field("payments", name, kind, outbound=True)


FIELDS = [
    _out("payment_id", "INT"),
    _out("payment_external_id", "TEXT"),
    _out("effective_utc", "TIMESTAMPTZ"),
    _out("amount", "DECIMAL"),
    _out("payment_status", "TEXT"),
    _out("down_payment_ind", "BOOLEAN"),
    Field("all", "remote_id", "BIGINT", outbound=True),
]
MAPPING = Mapping(tuple(FIELDS))


def core(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey AS int) AS payment_id",
        "concat('T', o_orderkey) AS payment_external_id",
        "cast(o_orderdate AS timestamp) AS effective_utc",
        "cast(o_totalprice AS decimal(18,8)) AS amount",
        "CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '2-HIGH' THEN NULL "
        "ELSE concat(o_orderpriority, ' & <co>') END AS payment_status",
        "o_custkey > 700 AS down_payment_ind",
        "CASE WHEN o_orderstatus = 'F' OR o_custkey > 1000 THEN o_orderkey + 1000000 END "
        "AS remote_id",
        "o_orderpriority = '1-URGENT' AS archived",
        "cast(o_orderdate AS timestamp) AS change_timestamp",
    )


CORE_SQL = """core AS (SELECT CAST(o_orderkey AS INTEGER) AS payment_id,
        'T' || o_orderkey AS payment_external_id, o_orderdate AS effective_utc,
        CAST(o_totalprice AS DECIMAL(18,8)) AS amount, CASE o_orderpriority WHEN '5-LOW' THEN ''
            WHEN '2-HIGH' THEN NULL ELSE o_orderpriority || ' & <co>' END AS payment_status,
        o_custkey > 700 AS down_payment_ind, CASE WHEN o_orderstatus = 'F' OR o_custkey > 1000
            THEN o_orderkey + 1000000 END AS remote_id, o_orderpriority = '1-URGENT' AS archived
    FROM orders)"""
_SHOWN = """payment_id, payment_external_id, effective_utc, CAST(amount AS DOUBLE) AS amount,
    payment_status, down_payment_ind, remote_id AS ID"""


def shown(df):
    return df.withColumn("amount", F.col("amount").cast("double"))


@check(
    "delivery_new",
    f"WITH {CORE_SQL} SELECT {_SHOWN} FROM core WHERE remote_id IS NULL AND NOT archived",
)
def delivery_new(spark, sf):
    spec = Delivery("payments", "Payments", 100)
    return shown(deliver.delivery(core(spark, sf), MAPPING, spec, known=False))


@check(
    "delivery_changed",
    f"""WITH {CORE_SQL} SELECT {_SHOWN} FROM core WHERE remote_id IS NOT NULL AND NOT archived
        AND effective_utc > TIMESTAMP '1998-01-01'""",
)
def delivery_changed(spark, sf):
    spec = Delivery("payments", "Payments", 100)
    since = F.lit("1998-01-01").cast("timestamp")
    return shown(deliver.delivery(core(spark, sf), MAPPING, spec, known=True, since=since))


@check(
    "delivery_override",
    f"""WITH {CORE_SQL} SELECT {_SHOWN} FROM core WHERE remote_id IS NOT NULL
        AND payment_status <> ''""",
)
def delivery_override(spark, sf):
    """A spec may bring its own selection of known records."""
    sql = "SELECT {columns} FROM {core} WHERE ID IS NOT NULL AND payment_status <> ''"
    spec = Delivery("payments", "Payments", 100, update_sql=sql)
    return shown(deliver.delivery(core(spark, sf), MAPPING, spec, known=True))


@check(
    "batch_assign",
    """SELECT o_orderkey, o_custkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 100
        AS batch_id FROM orders""",
)
def batch_assign(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return numbering.assign_batches(rows, ["o_custkey", "o_orderkey"], 100)


@check(
    "assign_serials",
    """SELECT event_id, event_type, 500 + row_number() OVER (ORDER BY event_type, event_id)
        AS serial FROM events""",
)
def assign_serials(spark, sf):
    """The leading order column has five values; the second one lets them be split."""
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return numbering.assign_serials(rows, "serial", ["event_type", "event_id"], after=500)


def _text(sql: str) -> str:
    return f"rtrim(rtrim(CAST({sql} AS VARCHAR), '0'), '.')"


def _tag(name: str, value: str) -> str:
    return f"'<field name=\"{name}\"><value>' || {value} || '</value></field>'"


_STATUS = "replace(replace(replace(payment_status, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_ALWAYS = " || ".join(
    [
        _tag("payment_id", "payment_id"),
        _tag("payment_external_id", "payment_external_id"),
        _tag("effective_utc", "strftime(effective_utc, '%Y-%m-%d %H:%M:%S')"),
        _tag("amount", _text("amount")),
    ]
)
_DOWN = _tag("down_payment_ind", "CASE WHEN down_payment_ind THEN 'True' ELSE 'False' END")
ADD_SQL = f"""'<add>' || {_ALWAYS} || CASE WHEN payment_status <> ''
    THEN {_tag("payment_status", _STATUS)} ELSE '' END || {_DOWN} || CASE WHEN remote_id IS NOT NULL
    THEN {_tag("ID", "remote_id")} ELSE '' END || '</add>'"""
UPDATE_SQL = f"""'<update><criteria>ID=="' || remote_id || '"</criteria><newvalues>' || {_ALWAYS} ||
    CASE WHEN payment_status IS NULL THEN {_tag("payment_status", "''")} WHEN payment_status <> ''
    THEN {_tag("payment_status", _STATUS)} ELSE '' END || {_DOWN} || '</newvalues></update>'"""


def outbound(spark, sf):
    from tallyloom.operators.conform import outbound_select

    return outbound_select(core(spark, sf), FIELDS)


@check("payload_add", f"WITH {CORE_SQL} SELECT payment_id, {ADD_SQL} AS record FROM core")
def payload_add(spark, sf):
    return deliver.render_add(outbound(spark, sf)).select("payment_id", "record")


@check(
    "payload_update",
    f"""WITH {CORE_SQL} SELECT payment_id, {UPDATE_SQL} AS record FROM core
        WHERE remote_id IS NOT NULL""",
)
def payload_update(spark, sf):
    known = outbound(spark, sf).filter("ID IS NOT NULL")
    return deliver.render_update(known).select("payment_id", "record")


_BATCHES = f"""WITH {CORE_SQL}, rows AS (SELECT payment_id, {ADD_SQL} AS record,
        (row_number() OVER (ORDER BY payment_id) - 1) // 40 AS batch_id FROM core
        WHERE remote_id IS NULL AND NOT archived),
    payloads AS (SELECT batch_id, count(*) AS records, '<Envelope><applicationlist><application '
        || 'name="app"><formlist><form name="Payments">' || string_agg(record, '' ORDER BY
        payment_id) || '</form></formlist></application></applicationlist></Envelope>' AS payload
        FROM rows GROUP BY 1)"""


def batches(spark, sf):
    spec = Delivery("payments", "Payments", 40)
    records = deliver.render_add(deliver.delivery(core(spark, sf), MAPPING, spec, known=False))
    rows = records.select("payment_id", "record")
    cut = numbering.assign_batches(rows, ["payment_id"], spec.slice_length)
    return deliver.build_payloads(cut, ["payment_id"], "Envelope", "app", spec.form)


@check("payload_batches", f"{_BATCHES} SELECT * FROM payloads")
def payload_batches(spark, sf):
    return batches(spark, sf)


@check("payload_oversize", f"{_BATCHES} SELECT * FROM payloads WHERE length(payload) > 14000")
def payload_oversize(spark, sf):
    return deliver.oversize(batches(spark, sf), 14_000)


LIMIT = 12_000  # characters: most batches of 40 are longer
HEAD, TAIL = deliver.envelope("Envelope", "app", "Payments")
ROOM = LIMIT - len(HEAD) - len(TAIL)

_BOUNDED = f"""WITH RECURSIVE {CORE_SQL}, records AS (SELECT payment_id, {ADD_SQL} AS record FROM core
        WHERE remote_id IS NULL AND NOT archived),
    numbered AS (SELECT payment_id, record, length(record) AS n,
        row_number() OVER (ORDER BY payment_id) - 1 AS i FROM records),
    cut(i, part, used) AS (SELECT i, 0, n FROM numbered WHERE i % 40 = 0
        UNION ALL SELECT r.i, CASE WHEN used + n > {ROOM} THEN part + 1 ELSE part END,
            CASE WHEN used + n > {ROOM} THEN n ELSE used + n END
        FROM cut c JOIN numbered r ON r.i = c.i + 1 WHERE r.i % 40 <> 0)
    SELECT i // 40 AS batch_id, CAST(part AS INTEGER) AS part, count(*) AS records,
        '{HEAD}' || string_agg(record, '' ORDER BY i) || '{TAIL}' AS payload
    FROM cut JOIN numbered USING (i) GROUP BY ALL"""


def new_records(spark, sf):
    spec = Delivery("payments", "Payments", 40)
    return deliver.render_add(deliver.delivery(core(spark, sf), MAPPING, spec, known=False))


@check("payload_bounded", _BOUNDED)
def payload_bounded(spark, sf):
    """Batches by number of records and by characters."""
    rows = new_records(spark, sf).select("payment_id", "record")
    return deliver.bounded_payloads(rows, ["payment_id"], 40, "Envelope", "app", "Payments", LIMIT)


@check(
    "payload_unsendable",
    f"""WITH {CORE_SQL} SELECT payment_id, {ADD_SQL} AS record FROM core
        WHERE remote_id IS NULL AND NOT archived AND length({ADD_SQL}) > 300""",
)
def payload_unsendable(spark, sf):
    """Records that no payload of a small limit can hold."""
    return deliver.split_oversize(new_records(spark, sf).select("payment_id", "record"), 300)[1]


# What was acknowledged last: the record as it is now (untouched, or changed and back again),
# an earlier one (changed), or nothing; some payloads are still unanswered.
_LEDGER_STATE = "CASE payment_id % 6 WHEN 4 THEN 'sent' WHEN 5 THEN 'refused' ELSE 'acknowledged' END"


@check(
    "delivery_real_changes",
    f"""WITH {CORE_SQL}, records AS (SELECT payment_id, payment_external_id AS key, sha256({UPDATE_SQL}) AS digest
        FROM core WHERE remote_id IS NOT NULL AND NOT archived)
    SELECT key, digest FROM records WHERE payment_id % 6 IN (1, 3, 5)""",
)
def delivery_real_changes(spark, sf):
    """Of the known records, those whose rendering differs from the acknowledged one."""
    spec = Delivery("payments", "Payments", 40)
    records = deliver.render_update(deliver.delivery(core(spark, sf), MAPPING, spec, known=True))
    records = records.select("payment_id", F.col("payment_external_id").alias("key"), ledger.digest(F.col("record")).alias("digest"))
    earlier = F.sha2(F.concat("digest", F.lit("earlier")), 256)
    kind = F.col("payment_id") % 6
    state = F.expr(_LEDGER_STATE)
    held = records.where(kind != 3).select(
        "key",
        F.lit("r1").alias("run"),
        F.lit(True).alias("known"),
        F.when(kind == 1, earlier).otherwise(F.col("digest")).alias("digest"),
        state.alias("state"),
        # 2: changed and sent, then changed back and sent again
        F.when(kind.isin(1, 4, 5), earlier).otherwise(F.col("digest")).alias("delivered"),
    )
    return ledger.to_send(records, held, known=True).select("key", "digest")


def answers(spark, sf):
    """Members of batches of 40, and responses: none, refused as a whole, cut short, or whole."""
    rows = numbering.number_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "i")
    rows = rows.selectExpr("i div 40 AS batch_id", "0 AS part", "concat('T', o_orderkey) AS key", "i % 40 AS place", "o_orderkey", "o_orderstatus")
    result = """concat('<result><status>', CASE WHEN o_orderstatus = 'P' THEN 'Failed' ELSE 'Success' END,
        '</status><field name="key"><value>', key, '</value></field>', CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE
        concat('<field name="ID"><value>', o_orderkey + 7, '</value></field>') END, '</result>')"""
    listed = F.array_sort(F.collect_list(F.struct("place", F.expr(result).alias("result"))))
    bodies = rows.groupBy("batch_id", "part").agg(listed.alias("listed"))
    bodies = bodies.where("batch_id % 4 <> 0").selectExpr(
        "batch_id",
        "part",
        """CASE batch_id % 4 WHEN 1 THEN '<errorlist>limit</errorlist>' WHEN 3 THEN array_join(transform(listed, r -> r.result), '')
        ELSE concat(array_join(transform(slice(listed, 1, 20), r -> r.result), ''), '<result><status>Succ') END AS body""",
    )
    return rows.select("batch_id", "part", "key"), bodies


@check(
    "delivery_states",
    """WITH rows AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
    members AS (SELECT i // 40 AS batch_id, i % 40 AS place, 'T' || o_orderkey AS key, o_orderkey, o_orderstatus FROM rows),
    named AS (SELECT *, batch_id % 4 = 3 OR (batch_id % 4 = 2 AND place < 20) AS named FROM members)
    SELECT batch_id, key, CASE WHEN batch_id % 4 = 0 THEN 'sent' WHEN batch_id % 4 = 1 THEN 'refused'
            WHEN NOT named THEN 'unpaired' WHEN o_orderstatus = 'P' THEN 'refused' WHEN o_orderkey % 7 = 0 THEN 'unpaired'
            ELSE 'acknowledged' END AS state,
        CASE WHEN named AND o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 THEN o_orderkey + 7 END AS remote_id
    FROM named""",
)
def delivery_states(spark, sf):
    """What became of every record sent."""
    members, bodies = answers(spark, sf)
    return ledger.member_states(members, bodies, "body", "key").select("batch_id", "key", "state", "remote_id")


def _flagged(name: str, kind: str, **flags) -> Field:
    return Field("payments", name, kind, outbound=True, **flags)


LEDGER_MAPPING = Mapping(
    (
        _flagged("payment_id", "INT", surrogate=True),
        _flagged("payment_external_id", "TEXT", business_key=True),
        _flagged("amount", "DECIMAL"),
        Field("all", "remote_id", "BIGINT", outbound=True),
    )
)


@check(
    "delivery_closed",
    "SELECT o_orderkey AS payment_id, 'T' || o_orderkey AS key, o_orderkey + 7 AS remote_id, 'acknowledged' AS state FROM orders",
)
def delivery_closed(spark, sf):
    """New records sent until all are stored: slices unanswered, refused and cut short on the way."""
    root = scratch_path(spark, "delivery")
    ws = Workspace(Store(spark, root), LEDGER_MAPPING)
    rows = core(spark, sf).select("payment_id", "payment_external_id", "amount", F.lit(None).cast("bigint").alias("remote_id"), F.lit(False).alias("archived"))
    ws.store.write_core("payments", rows)
    spec = Delivery("payments", "Payments", 500)

    def answered(sent, whole, half):
        """Responses of the remote system to payloads, given which are answered whole and which by half."""
        result = """transform(members, m -> concat('<result><status>Success</status><field name="payment_external_id"><value>', m.key,
            '</value></field><field name="ID"><value>', cast(substring(m.key, 2) AS bigint) + 7, '</value></field></result>'))"""
        each = sent.where(whole | half).withColumn("members", F.when(whole, F.col("members")).otherwise(F.slice("members", 1, 250)))
        return each.select("batch_id", "part", F.array_join(F.expr(result), "").alias("body"))

    kind = F.col("batch_id") % 4
    sent = delivery_run.send(ws, spec, False, "Envelope", "app", "r1", limit=100_000)
    refused = sent.where(kind == 1).select("batch_id", "part", F.lit("<errorlist/>").alias("body"))
    delivery_run.settle(ws, spec, False, "r1", answered(sent, kind == 3, kind == 2).union(refused), "body")
    # the unanswered payloads once more, as they are
    again = delivery_run.open_payloads(ws, "payments", "r1", False)
    delivery_run.settle(ws, spec, False, "r1", answered(again, F.lit(True), F.lit(False)), "body")
    # what was not paired has been stored all but every third record, as a report of the remote system shows
    held = delivery_run.ledger(ws, "payments").where("state = 'unpaired'")
    number = F.expr("cast(substring(key, 2) AS bigint)")
    report = held.where(number % 3 != 0).select(F.col("key").alias("payment_external_id"), (number + 7).cast("string").alias("ID"))
    delivery_run.confirm(ws, spec, report, complete=True)
    # refused and lost records go out again, and nothing else
    sent = delivery_run.send(ws, spec, False, "Envelope", "app", "r2", limit=100_000)
    delivery_run.settle(ws, spec, False, "r2", answered(sent, F.lit(True), F.lit(False)), "body")
    entries = delivery_run.ledger(ws, "payments").select("key", "state")
    done = ws.core("payments").join(entries, F.col("payment_external_id") == F.col("key"), "left")
    return done.select(F.col("payment_id").cast("bigint").alias("payment_id"), "key", "remote_id", "state")


def responses(spark, sf):
    """Two results per order, fields in either order, at either depth; some refused."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS slice",
        """CASE WHEN o_orderpriority = '5-LOW' THEN '<errorlist/>' ELSE concat('<response>',
        '<result><status>', CASE WHEN o_orderstatus = 'P' THEN 'Failed' ELSE 'Success' END,
        '</status><field name="ID"><value>', o_orderkey + 7, '</value></field>',
        '<field name="key"><value>T&amp;', o_orderkey, '</value></field></result>',
        '<result><form><add><values><field name="key"><value>C', o_custkey, '</value></field>',
        CASE WHEN o_orderstatus = 'F' THEN '' ELSE
            concat('<field name="ID"><value>', o_custkey, '</value></field>') END,
        '</values><status>Success</status></add></form></result></response>') END AS body""",
    )


@check(
    "response_status",
    """SELECT o_orderkey AS slice, CASE WHEN o_orderpriority <> '5-LOW' THEN 'Failed' END AS status
    FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus = 'P'""",
)
def response_status(spark, sf):
    return respond.response_errors(responses(spark, sf), "body", keep=["slice"])


@check(
    "response_ids",
    """SELECT o_orderkey AS slice, 'T&' || o_orderkey AS key, CAST(o_orderkey + 7 AS VARCHAR) AS ID
    FROM orders WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT o_orderkey, 'C' || o_custkey, CAST(o_custkey AS VARCHAR) FROM orders
    WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F'""",
)
def response_ids(spark, sf):
    return respond.response_ids(responses(spark, sf), "body", "key", keep=["slice"])


RUN_MAPPING = Mapping(
    (
        Field("all", "external_sys", "TEXT", {"orders": "external_sys"}),
        Field("all", "organization", "TEXT", {"orders": "organization"}),
        Field("all", "country", "TEXT", {"orders": "country"}),
        Field("payments", "payment_id", "INT", surrogate=True),
        *PAYMENT_FIELDS,
    )
)


@check(
    "incremental_run",
    """SELECT CAST(row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS payment_id,
        CAST(o_orderkey AS VARCHAR) AS payment_external_id, o_orderdate AS effective_utc,
        CAST(o_custkey AS INTEGER) AS account_number,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        o_orderstatus || ' ' || nullif(o_orderpriority, '5-LOW') AS payment_type,
        CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS down_payment_ind,
        'orders' AS external_sys, FALSE AS archived FROM orders""",
)
def incremental_run(spark, sf):
    """Orders arrive as a stream, go through whole table runs and are read back from the core."""
    root = scratch_path(spark, "incremental")
    ws = Workspace(Store(spark, root), RUN_MAPPING)
    schema = table(spark, sf, "orders").schema
    landed = spark.readStream.schema(schema).parquet(f"{sf}/orders*.parquet")
    rows = orders_text(spark, sf, landed)
    query = stream_upsert(ws, ORDERS, "payments", rows, AS_OF, f"{root}/checkpoint", "orders")
    query.awaitTermination()
    return ws.core("payments").selectExpr(
        "payment_id",
        "payment_external_id",
        "cast(effective_utc AS timestamp_ntz) AS effective_utc",
        "account_number",
        "cast(amount AS double) AS amount",
        "payment_type",
        "down_payment_ind",
        "external_sys",
        "archived",
    )
