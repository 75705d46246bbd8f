"""Bounded payloads, the delivery ledger and real changes."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import deliver, ledger
from tallyloom.plans import delivery_run
from tallyloom.plans.table_run import Workspace
from tallyloom.sources.snapshots import Store
from tallyloom.spec import Delivery, Field, Mapping

MAPPING = Mapping(
    (
        Field("pay", "pay_id", "INT", surrogate=True, outbound=True),
        Field("pay", "ext", "TEXT", business_key=True, outbound=True),
        Field("pay", "note", "TEXT", outbound=True),
        Field("all", "remote_id", "BIGINT", outbound=True),
    )
)
SPEC = Delivery("pay", "Pay", 3)
HEAD, TAIL = deliver.envelope("R", "app", "Pay")
OK = '<result><status>Success</status><field name="ext"><value>{0}</value></field><field name="ID"><value>{1}</value></field></result>'


@pytest.fixture
def ws(spark, tmp_path):
    return Workspace(Store(spark, str(tmp_path / "store")), MAPPING)


def put(ws, rows, after=None):
    """Core rows (pay_id, ext, note, remote_id)."""
    df = ws.store.spark.createDataFrame(rows, "pay_id int, ext string, note string, remote_id bigint")
    ws.store.write_core("pay", df.withColumn("archived", F.lit(False)), after=after)


def send(ws, run, known=False, limit=10_000):
    sent = delivery_run.send(ws, SPEC, known, "R", "app", run, limit)
    return {(r["batch_id"], r["part"]): [m["key"] for m in r["members"]] for r in sent.collect()}


def settle(ws, run, bodies, known=False):
    df = ws.store.spark.createDataFrame([(*k, v) for k, v in bodies.items()], "batch_id bigint, part int, body string")
    delivery_run.settle(ws, SPEC, known, run, df, "body")


def states(ws):
    return {r["key"]: (r["state"], r["remote_id"]) for r in delivery_run.ledger(ws, "pay").collect()}


def stored(ws):
    return {r["ext"]: r["remote_id"] for r in ws.core("pay").collect()}


def greedy(lengths, size, room):
    out = []
    for start in range(0, len(lengths), size):
        part, used = 0, 0
        for n in lengths[start : start + size]:
            if used and used + n > room:
                part, used = part + 1, 0
            used += n
            out.append((start // size, part))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), max_size=25), st.integers(1, 7), st.integers(30, 80))
def test_payloads_keep_to_both_limits(spark, lengths, size, room):
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "id int, record string")
    limit = room + len(HEAD) + len(TAIL)
    out = deliver.bounded_payloads(df, ["id"], size, "R", "app", "Pay", limit, keep=["id"]).collect()
    assert all(len(r["payload"]) <= limit and r["records"] <= size for r in out)
    got = sorted((m["id"], r["batch_id"], r["part"]) for r in out for m in r["members"])
    assert [(b, p) for _, b, p in got] == greedy(lengths, size, room) and len(got) == len(lengths)
    for r in out:
        assert r["payload"] == HEAD + "".join("x" * lengths[m["id"]] for m in r["members"]) + TAIL


def test_batches_within_the_limit_are_those_of_the_plain_builder(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "id int, record string")
    plain = deliver.build_payloads(df.withColumn("batch_id", F.expr("id div 4")), ["id"], "R", "app", "Pay")
    bounded = deliver.bounded_payloads(df, ["id"], 4, "R", "app", "Pay")
    assert sorted(r["payload"] for r in plain.collect()) == sorted(r["payload"] for r in bounded.collect())


def test_records_too_long_for_a_payload_are_set_aside(spark):
    df = spark.createDataFrame([(1, "x" * 5), (2, "x" * 6), (3, None)], "id int, record string")
    fits, large = deliver.split_oversize(df, 5)
    assert [r["id"] for r in fits.collect()] == [1, 3] and [r["id"] for r in large.collect()] == [2]


def test_every_identifier_is_written_once(ws):
    put(ws, [(i, f"k{i}", "n", None) for i in range(12)])
    sent = send(ws, "r1")
    assert [len(v) for v in sent.values()] == [3] * 4
    # whole, refused, cut after the first result, no response
    settle(ws, "r1", {(0, 0): "".join(OK.format(f"k{i}", 100 + i) for i in range(3)), (1, 0): "<errorlist/>", (2, 0): OK.format("k6", 106) + "<result><sta"})
    got = states(ws)
    assert [got[f"k{i}"][0] for i in range(12)] == ["acknowledged"] * 3 + ["refused"] * 3 + ["acknowledged"] + ["unpaired"] * 2 + ["sent"] * 3
    assert stored(ws) == {f"k{i}": 100 + i if i in (0, 1, 2, 6) else None for i in range(12)}
    # only the payload without a response is open, and it is the one that was sent
    assert [(r["batch_id"], r["part"]) for r in delivery_run.open_payloads(ws, "pay", "r1", False).collect()] == [(3, 0)]
    # the next run takes what was refused; unpaired and unanswered records wait
    assert [k for v in send(ws, "r2").values() for k in v] == ["k3", "k4", "k5"]
    settle(ws, "r2", {(0, 0): "".join(OK.format(f"k{i}", 100 + i) for i in range(3, 6))})
    settle(ws, "r1", {(3, 0): "".join(OK.format(f"k{i}", 100 + i) for i in range(9, 12))})
    # a complete report holds one of the two unpaired records; the other one goes out again
    report = ws.store.spark.createDataFrame([("k7", "107"), ("k0", "100")], "ext string, ID string")
    delivery_run.confirm(ws, SPEC, report, complete=True)
    assert [k for v in send(ws, "r3").values() for k in v] == ["k8"]
    settle(ws, "r3", {(0, 0): OK.format("k8", 108)})
    assert stored(ws) == {f"k{i}": 100 + i for i in range(12)}
    assert set(states(ws).values()) == {("acknowledged", 100 + i) for i in range(12)}
    assert send(ws, "r4") == {}


def test_an_incomplete_report_leaves_the_rest_unpaired(ws):
    put(ws, [(1, "a", None, None), (2, "b", None, None)])
    send(ws, "r1")
    settle(ws, "r1", {(0, 0): "<response/>"})
    delivery_run.confirm(ws, SPEC, ws.store.spark.createDataFrame([("b", "9")], "ext string, ID string"))
    assert states(ws) == {"a": ("unpaired", None), "b": ("acknowledged", 9)}
    assert send(ws, "r2") == {}


def test_a_run_repeated_under_its_id_sends_the_same(ws):
    put(ws, [(1, "a", None, None)])
    first = send(ws, "r1")
    put(ws, [(1, "a", "changed", None), (2, "b", None, None)], after=0)
    assert send(ws, "r1") == first == {(0, 0): ["a"]}
    settle(ws, "r1", {(0, 0): OK.format("a", 5)})
    assert send(ws, "r1") == first and states(ws) == {"a": ("acknowledged", 5)}


def test_only_real_changes_are_sent(ws):
    known = [(i, f"k{i}", "n", 100 + i) for i in range(4)]
    put(ws, known)
    assert len([k for v in send(ws, "u1", known=True).values() for k in v]) == 4
    settle(ws, "u1", {(0, 0): "".join(OK.format(f"k{i}", 100 + i) for i in range(3)), (1, 0): OK.format("k3", 103)}, known=True)
    assert send(ws, "u2", known=True) == {}
    # one changed, one touched without a change
    put(ws, [(0, "k0", "new", 100), *known[1:]], after=ws.store.latest("pay"))
    assert send(ws, "u3", known=True) == {(0, 0): ["k0"]}
    # refused, and then changed back: the remote system still holds the first rendering
    settle(ws, "u3", {(0, 0): "<errorlist/>"}, known=True)
    put(ws, known, after=ws.store.latest("pay"))
    assert send(ws, "u4", known=True) == {}


def test_a_change_is_sent_again_until_it_is_acknowledged(ws):
    put(ws, [(0, "k0", "a", 100)])
    send(ws, "u1", known=True)
    settle(ws, "u1", {(0, 0): '<result><status>Failed</status><field name="ext"><value>k0</value></field></result>'}, known=True)
    assert states(ws)["k0"][0] == "refused"
    assert send(ws, "u2", known=True) == {(0, 0): ["k0"]}
    # while that is unanswered, the same rendering waits and a newer one goes out
    assert send(ws, "u3", known=True) == {}
    put(ws, [(0, "k0", "b", 100)], after=ws.store.latest("pay"))
    assert send(ws, "u4", known=True) == {(0, 0): ["k0"]}


def test_oversize_records_wait_for_a_change(ws):
    put(ws, [(1, "a", "x" * 400, None), (2, "b", "y", None)])
    assert send(ws, "r1", limit=400) == {(0, 0): ["b"]}
    assert states(ws) == {"a": ("oversize", None), "b": ("sent", None)}
    assert send(ws, "r2", limit=400) == {}
    put(ws, [(1, "a", "x", None), (2, "b", "y", None)], after=0)
    assert send(ws, "r3", limit=400) == {(0, 0): ["a"]}


def test_of_several_results_of_a_key_a_success_counts(spark):
    members = spark.createDataFrame([(0, 0, "a"), (0, 0, "b")], "batch_id bigint, part int, key string")
    failed = '<result><status>Failed</status><field name="ext"><value>a</value></field></result>'
    body = failed + OK.format("a", 8) + OK.format("a", 7) + OK.format("b", "no number")
    df = spark.createDataFrame([(0, 0, body)], "batch_id bigint, part int, body string")
    got = {r["key"]: (r["state"], r["remote_id"]) for r in ledger.member_states(members, df, "body", "ext").collect()}
    assert got == {"a": ("acknowledged", 7), "b": ("unpaired", None)}


def test_events_without_a_digest_keep_that_of_the_row(spark, rows):
    sha = "ab" * 32
    held = spark.createDataFrame(
        [("a", "r1", False, 0, 0, sha, "sent", None, None, None), ("b", "r1", False, 0, 0, "Short", "sent", None, None, "x"), ("c", "r1", False, 0, 0, None, "sent", None, None, sha)],
        ledger.LEDGER,
    )
    events = spark.createDataFrame(
        [("a", "r1", False, 0, 0, "acknowledged", "Success", 5), ("b", "r1", False, 0, 0, "refused", "Failed", None)],
        "key string, run string, known boolean, batch_id bigint, part int, state string, status string, remote_id bigint",
    )
    done = ledger.entered(held, events)
    assert done.columns == held.columns
    assert rows(done, "key", "digest", "state", "remote_id", "delivered") == [
        ("a", sha, "acknowledged", 5, sha),
        ("b", "Short", "refused", None, "x"),
        ("c", None, "sent", None, sha),
    ]
    # digests that are no sha256 in lower case come back as they are
    others = [c * 64 for c in "AG"]
    given = events.withColumn("digest", F.when(F.col("key") == "a", others[0]).otherwise(others[1]))
    assert rows(ledger.entered(held, given), "key", "digest", "delivered") == [("a", others[0], others[0]), ("b", others[1], "x"), ("c", None, sha)]


def test_records_are_chosen_before_they_are_rendered(spark, rows):
    held = spark.createDataFrame(
        [(k, "r1", False, 0, 0, d, state, None, None, None) for k, d, state in (("1", "x", "sent"), ("2", "old", "oversize"), ("3", "c", "oversize"), ("4", "x", "refused"))],
        ledger.LEDGER,
    )
    plain = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")], "key int, text string")
    out = ledger.to_send(plain, held, False, F.col("key").cast("string"), F.col("text"))
    assert out.columns == ["key", "text"] and rows(out) == [(2, "b"), (4, "d"), (5, "e")]


def test_payloads_of_rows_that_are_rendered_last(spark):
    plain = spark.range(25).selectExpr("id", "concat('n', id % 7) AS name")

    def texts(df):
        return df.withColumns({"record": F.concat("name", F.lit("-"), "id"), "key": F.col("id").cast("string")}).drop("name")

    early = deliver.bounded_payloads(texts(plain), ["id"], 10, "R", "a", "F", 120, keep=["key"])
    late = deliver.bounded_payloads(plain, ["id"], 10, "R", "a", "F", 120, keep=["key"], texts=texts)
    assert late.schema == early.schema
    assert sorted(late.collect()) == sorted(early.collect())
    assert late.agg(F.sum("records")).head()[0] == 25
