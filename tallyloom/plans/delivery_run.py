"""Delivery as files: payload tables out, response tables in, identifiers back.

A delivery run sends what the ledger of the table says has to be sent, enters what it sent,
and is closed by ``settle``, which reads the responses. Payloads are written under the run
before they are entered, and marked when they are, so a run can be repeated under its id: it
finds its payloads, sends the same ones and enters them once. Each step publishes a new version of the ledger or of the core.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.deliver import (
    MAX_PAYLOAD_CHARS,
    add_record,
    bounded_payloads,
    build_payloads,
    delivery,
    envelope,
    render_add,
    render_update,
    split_oversize,
    update_record,
)
from tallyloom.operators.ledger import (
    ACKNOWLEDGED,
    LEDGER,
    OVERSIZE,
    SENT,
    confirmed,
    digest,
    entered,
    member_states,
    started,
    to_send,
)
from tallyloom.operators.lookup import write_back
from tallyloom.operators.numbering import assign_batches
from tallyloom.operators.respond import response_ids
from tallyloom.plans.table_run import Workspace
from tallyloom.session import freeze, scratch_scope
from tallyloom.sources.snapshots import CODEC, bucket_of
from tallyloom.spec import Delivery, quoted


def rendered(ws: Workspace, spec: Delivery, known: bool) -> tuple[DataFrame, list[str]]:
    """Records of one delivery pass with their text in ``record``, and the columns that order them."""
    records, order = _records(ws, spec, known)
    return render_update(records) if known else render_add(records), order


def _records(ws: Workspace, spec: Delivery, known: bool) -> tuple[DataFrame, list[str]]:
    """Records of one delivery pass, and the columns that order them."""
    records = delivery(ws.core(spec.table), ws.mapping, spec, known, ws.remote_id)
    keys = [ws.mapping.surrogate(spec.table), ws.mapping.business_key(spec.table)]
    return records, [c for c in dict.fromkeys(keys) if c in records.columns]


def payloads(
    ws: Workspace, spec: Delivery, known: bool, root: str, application: str
) -> DataFrame:
    """Ordered payloads of one delivery pass over all records, whatever was sent before.

    They read a scratch table that stays until the caller's ``scratch_scope`` ends.
    """
    records, order = rendered(ws, spec, known)
    batched = assign_batches(records.select(*order, "record"), order, spec.slice_length)
    return build_payloads(batched, order, root, application, spec.form)


def _ledger_name(table: str) -> str:
    return f"ledger_{table}"


def ledger(ws: Workspace, table: str) -> DataFrame:
    """The ledger of a core table; empty before its first delivery run."""
    name = _ledger_name(table)
    if not ws.store.has_core(name):
        return ws.store.spark.createDataFrame([], LEDGER)
    return ws.store.read_core(name)


def _enter(ws: Workspace, table: str, events: DataFrame) -> int:
    """Events into the next version of the ledger, which is kept in buckets if its table is."""
    name, buckets = _ledger_name(table), ws.buckets.get(table)
    version = ws.store.latest(name)
    if version is None:
        rows = started(events)
        return ws.store.write_core(name, rows) if buckets is None else ws.store.write_buckets(name, rows, "key", buckets)
    if buckets is None:
        return ws.store.write_core(name, entered(ledger(ws, table), events), after=version)
    touched = None
    if ws.store.layout(name, version).buckets == buckets:
        found = events.select(bucket_of("key", buckets).alias("b")).distinct()
        touched = sorted(r["b"] for r in found.collect())  # one number a bucket
    old = ledger(ws, table) if touched is None else ws.store.read_core(name, version, buckets=touched)
    return ws.store.write_buckets(name, entered(old, events), "key", buckets, version, touched)


def payload_path(ws: Workspace, table: str, run: str, known: bool) -> str:
    return f"{ws.store.root}/delivery/{table}/run={run}/{'update' if known else 'add'}"


def read_payloads(ws: Workspace, table: str, run: str, known: bool) -> DataFrame:
    """(batch_id, part, records, members, payload) of a delivery run."""
    return ws.store.spark.read.parquet(payload_path(ws, table, run, known))


def send(
    ws: Workspace,
    spec: Delivery,
    known: bool,
    root: str,
    application: str,
    run: str,
    limit: int = MAX_PAYLOAD_CHARS,
) -> DataFrame:
    """Write the payloads of what has to be sent, enter it as sent, and return the payloads.

    Records that no payload can hold are entered as ``oversize`` and left out.
    """
    path = payload_path(ws, spec.table, run, known)
    rows, order = _records(ws, spec, known)
    columns = rows.columns
    text = (update_record if known else add_record)(rows, columns)
    key = F.col(quoted(ws.mapping.business_key(spec.table))).cast("string")

    def texts(df: DataFrame) -> DataFrame:
        others = [c for c in df.columns if c not in columns]
        done = df.withColumn("__text", text)
        return done.select(*others, *order, F.col("__text").alias("record"), key.alias("key"), digest(F.col("__text")).alias("digest"))

    with scratch_scope(ws.store.spark):
        rows = rows.where(key.isNotNull())
        if ws.store.has_core(_ledger_name(spec.table)):
            rows = to_send(rows, ledger(ws, spec.table), known, key, digest(text))
        # frozen, numbered and put into batches as they are: texts and digests are made where they are written
        room = limit - sum(map(len, envelope(root, application, spec.form)))
        fitting, large = split_oversize(freeze(rows, "records").withColumn("__text", text), room, "__text")
        if not ws.store.complete(path):
            built = bounded_payloads(
                fitting.drop("__text"), order, spec.slice_length, root, application, spec.form, limit, keep=["key", "digest"], texts=texts
            )
            built.write.mode("overwrite").option("compression", CODEC).parquet(path)
        if not ws.store.marked(path):
            sent = read_payloads(ws, spec.table, run, known).select("batch_id", "part", F.inline("members"))
            none = F.lit(None)
            large = texts(large.drop("__text")).select(none.alias("batch_id"), none.alias("part"), "key", "digest", F.lit(OVERSIZE).alias("state"))
            events = sent.withColumn("state", F.lit(SENT)).unionByName(large).withColumns(
                {"run": F.lit(run), "known": F.lit(known), "status": none, "remote_id": none}
            )
            _enter(ws, spec.table, events)
            ws.store.mark(path)
    return read_payloads(ws, spec.table, run, known)


def settle(
    ws: Workspace, spec: Delivery, known: bool, run: str, responses: DataFrame, text: str
) -> None:
    """Enter what the responses (batch_id, part, text) say, and write new identifiers into the core.

    Responses may come in several lots: only records still waiting for one are entered.
    """
    key = ws.mapping.business_key(spec.table)
    waiting = ledger(ws, spec.table).where(
        (F.col("run") == run) & (F.col("known") == known) & (F.col("state") == SENT)
    )
    # digests stay in the ledger
    members = waiting.drop("state", "status", "remote_id", "delivered", "digest")
    with scratch_scope(ws.store.spark):
        events = freeze(member_states(members, responses, text, key), "events")
        # the ledger last: what is interrupted before it is simply done again
        if not known:
            _write_ids(ws, spec.table, events)
        _enter(ws, spec.table, events.where(F.col("state") != SENT))


def confirm(ws: Workspace, spec: Delivery, report: DataFrame, complete: bool = False) -> None:
    """Settle unpaired records by a report (business key, ``ID``) of what the remote system holds."""
    key = ws.mapping.business_key(spec.table)
    pairs = report.select(F.col(quoted(key)).cast("string").alias("key"), F.col("ID").try_cast("bigint").alias("remote_id"))
    with scratch_scope(ws.store.spark):
        events = freeze(confirmed(ledger(ws, spec.table).drop("digest"), pairs, complete), "events")
        _write_ids(ws, spec.table, events.where("NOT known"))
        _enter(ws, spec.table, events)


def open_payloads(ws: Workspace, table: str, run: str, known: bool) -> DataFrame:
    """Payloads of a run that nothing has been heard of: to be sent again as they are.

    They are found by a scratch table of batch numbers, whose size the planner knows: no
    payload is shuffled to meet a small one. It stays until the caller's ``scratch_scope`` ends.
    """
    waiting = ledger(ws, table).where(
        (F.col("run") == run) & (F.col("known") == known) & (F.col("state") == SENT)
    )
    rows = read_payloads(ws, table, run, known)
    waiting = freeze(waiting.select("batch_id", "part").distinct(), "open")
    return rows.join(waiting, ["batch_id", "part"], "left_semi")


def _write_ids(ws: Workspace, table: str, events: DataFrame) -> int | None:
    """Identifiers of acknowledged records into the next core version, if there are any."""
    key = ws.mapping.business_key(table)
    ids = events.where(F.col("state") == ACKNOWLEDGED).select(F.col("key").alias(key), F.col("remote_id").alias("ID"))
    if ids.isEmpty():
        return None
    return _write_back(ws, table, ids)


def _write_back(ws: Workspace, table: str, ids: DataFrame) -> int:
    """Identifiers by business key into the next core version; of a table in buckets, into theirs."""
    key = ws.mapping.business_key(table)
    version = ws.store.latest(table)
    return ws.change(table, version, ids, key, lambda core: write_back(core, ids, key, ws.remote_id))


def store_identifiers(ws: Workspace, table: str, responses: DataFrame, text: str) -> int | None:
    """Write the identifiers that responses hold into the next core version."""
    return _write_back(ws, table, response_ids(responses, text, ws.mapping.business_key(table)))


def backfill_identifiers(ws: Workspace, table: str, fixes: DataFrame) -> int | None:
    """The same from a repair file with the business key and ``ID`` as text."""
    return _write_back(ws, table, fixes.select(ws.mapping.business_key(table), F.col("ID")))
