"""Whole table runs, deliveries and streams against a store in a temporary folder."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.skew import heavy_keys
from tallyloom.plans import delivery_run
from tallyloom.plans.rules import RULES
from tallyloom.plans.table_run import Workspace, run_all, run_table
from tallyloom.sources.snapshots import Store
from tallyloom.spec import Delivery, Field, Mapping, Provider, TableFeed
from tallyloom.streaming.upsert_stream import read_landing, stream_upsert

NOW, LATER = datetime(2024, 1, 1), datetime(2024, 2, 1)


def fields(table, *rows):
    out = []
    for name, kind, source, *flags in rows:
        sources = {"upya": source, "angaza": source} if source else {}
        out.append(Field(table, name, kind, sources, "key" in flags, "out" in flags, "pk" in flags))
    return out


MAPPING = Mapping(
    (
        *[Field("all", n, "TEXT", {"upya": n, "angaza": n}, outbound=True) for n in ("external_sys", "organization", "country")],
        Field("all", "remote_id", "BIGINT", outbound=True),
        *fields(
            "payments",
            ("payment_id", "INT", "", "pk", "out"),
            ("payment_external_id", "TEXT", "transactionId", "key", "out"),
            ("effective_utc", "TIMESTAMPTZ", "date", "out"),
            ("account_external_id", "TEXT", "contract.contractNumber", "out"),
            ("account_id", "INT", ""),
            ("unit_number", "TEXT", ""),
            ("pricing_group", "TEXT", "group"),
            ("amount", "DECIMAL", "amount", "out"),
            ("responsible_user", "TEXT", ""),
            ("responsible_user_id", "INT", ""),
            ("responsible_user_ext_id", "TEXT", ""),
        ),
        *fields(
            "accounts",
            ("account_id", "INT", "", "pk"),
            ("account_external_id", "TEXT", "contractNumber", "key"),
            ("unit_number", "TEXT", "payg"),
            ("asset_number", "TEXT", "serial"),
            ("product", "TEXT", "product"),
            ("pricing_group", "TEXT", "deal"),
            ("responsible_user_id", "INT", ""),
            ("responsible_user_external_id", "TEXT", "agent"),
        ),
        *fields(
            "stock",
            ("stock_id", "INT", "", "pk"),
            ("stock_external_id", "TEXT", "serial", "key"),
            ("asset_number", "TEXT", "serial"),
            ("product", "TEXT", "product"),
            ("transit_state", "TEXT", "state"),
            ("account_id", "INT", ""),
            ("holder_id", "INT", ""),
            ("holder_external_id", "TEXT", "holder"),
        ),
        *fields(
            "users",
            ("user_id", "INT", "", "pk"),
            ("user_upya_id", "TEXT", "agent"),
            ("user_angaza_id", "TEXT", "other"),
            ("username", "TEXT", "name"),
            ("full_name", "TEXT", "name"),
            ("user_email", "TEXT", "email", "key"),
        ),
        *fields(
            "webusers",
            ("webuser_email", "TEXT", "email", "key", "pk"),
            ("webuser_upya_id", "TEXT", "number"),
            ("webuser_username", "TEXT", "name"),
        ),
    )
)
UPYA = Provider(
    "upya",
    "house",
    "Malawi",
    tables={
        "users": TableFeed(prep="users", rules="users"),
        "webusers": TableFeed(prep="users"),
        "stock": TableFeed(rules="stock"),
        "accounts": TableFeed(prep="core"),
        "payments": TableFeed(rules="payments", filter="a.amount IS NULL OR a.amount <> '-1'"),
    },
)


@pytest.fixture
def ws(spark, tmp_path):
    return Workspace(Store(spark, str(tmp_path / "store")), MAPPING)


def extract(spark, header, *lines):
    return spark.createDataFrame([tuple(x) for x in lines], ", ".join(f"`{h}` string" for h in header))


PAYMENT = ["transactionId", "date", "contract.contractNumber", "group", "amount"]


def pay(spark, *lines):
    return extract(spark, PAYMENT, *lines)


def test_first_and_second_run(spark, ws, rows):
    first = pay(
        spark,
        ("t2", "2024-01-05", "A1", "g", "10.5"),
        ("t1", "2019-01-05", "A9", "n/a", "7"),
        (None, "2024-01-05", "A1", "g", "1"),
        ("t9", "2024-01-05", "A1", "g", "-1"),
    )
    done = run_table(ws, UPYA, "payments", first, NOW, "r1")
    assert (done.status, done.version) == ("written", 0)
    assert done.message == "1 staged rows without payment_external_id"
    shown = ["payment_id", "payment_external_id", "cast(amount AS double)", "archived", "country"]
    core = ws.core("payments")
    assert rows(core.selectExpr(*shown)) == [(1, "t1", 7.0, False, "Malawi"), (2, "t2", 10.5, False, "Malawi")]
    # the next extract lacks the date column, holds no group at all, and one amount is gone
    second = extract(
        spark,
        ["transactionId", "contract.contractNumber", "group", "amount"],
        ("t2", "A1", "None", ""),
        ("t3", "A1", "", "3"),
    )
    assert run_table(ws, UPYA, "payments", second, LATER, "r2").version == 1
    core = ws.core("payments")
    got = {r["payment_external_id"]: r for r in core.collect()}
    assert got["t2"]["amount"] is None  # a null cell overwrites
    assert got["t2"]["effective_utc"] == datetime(2024, 1, 5)  # an absent column does not
    assert got["t2"]["pricing_group"] == "g"  # nor does a wholly empty one
    assert got["t3"]["payment_id"] == 3
    assert got["t1"]["change_timestamp"] == NOW
    assert got["t2"]["change_timestamp"] == LATER
    assert ws.store.read_core("payments", 0).count() == 2  # the old version is still whole


def test_empty_extract_changes_nothing(spark, ws):
    run_table(ws, UPYA, "payments", pay(spark, ("t1", "2024-01-05", "A1", "g", "1")), NOW, "r1")
    done = run_table(ws, UPYA, "payments", pay(spark, ("x",) * 5).filter("false"), NOW, "r2")
    assert done.status == "unchanged"
    assert ws.store.latest("payments") == 0


def test_rules_read_other_tables(spark, ws, rows):
    users = extract(spark, ["agent", "other", "name", "email"], ("U1", "Z1", "Ann", "a@x"), ("U2", None, "Bob", "b@x"))
    run_table(ws, UPYA, "users", users, NOW, "r1")
    assert rows(ws.core("users"), "user_id", "external_sys") == [(1, "angaza and upya"), (2, "upya")]
    accounts = extract(
        spark, ["contractNumber", "payg", "serial", "product", "deal", "agent"], ("A1", "P1", "S1", "Kit", "G1", "U1")
    )
    run_table(ws, UPYA, "accounts", accounts, NOW, "r1")
    assert rows(ws.core("products")) == [("Kit", "Kit")]
    assert rows(ws.core("pricing_groups")) == [("Kit", "G1")]
    run_table(ws, UPYA, "payments", pay(spark, ("t1", "2024-01-05", "A1", "old", "1")), NOW, "r1")
    got = ws.core("payments").head()
    assert (got["account_id"], got["unit_number"], got["pricing_group"]) == (1, "P1", "G1")
    stock = extract(spark, ["serial", "product", "state", "holder"], ("S1", "Kit", "OUT", "U2"))
    run_table(ws, UPYA, "stock", stock, NOW, "r1")
    assert rows(ws.core("stock"), "account_id", "holder_id") == [(1, 2)]


def test_heavy_keys_come_from_both_inputs_and_change_nothing(spark, ws, monkeypatch):
    from tallyloom.plans import table_run

    monkeypatch.setattr(table_run, "heavy_keys", lambda df, keys: heavy_keys(df, keys, 0.2, 0))
    accounts = extract(spark, ["contractNumber", "payg"], ("A1", "P1"), ("A2", "P2"), ("A3", "P3"))
    run_table(ws, UPYA, "accounts", accounts, NOW, "r1")

    def lines(prefix, key):
        return [(f"{prefix}{i}", "2024-01-05", key if i < 40 else f"A{i}", "g", "1") for i in range(60)]

    run_table(ws, UPYA, "payments", pay(spark, *lines("x", "A1")), NOW, "r1")
    core, staged = ws.core("payments"), ws.staged("upya", "payments")
    hot = table_run.skewed_keys(ws, core, staged, UPYA, "payments", "payments")
    assert hot["account_external_id"] == ["A1"]
    assert heavy_keys(core.filter("false"), ["account_id"]) == {}
    run_table(ws, UPYA, "payments", pay(spark, *lines("y", "A2")), LATER, "r2")
    got = ws.core("payments").groupBy("account_external_id", "unit_number").count().collect()
    counts = {(r[0], r[1]): r[2] for r in got}
    assert counts[("A1", "P1")] == counts[("A2", "P2")] == 40
    assert sum(counts.values()) == 120


def test_users_prep_repairs_emails(spark, ws, rows):
    header = ["agent", "other", "name", "email"]
    run_table(ws, UPYA, "users", extract(spark, header, ("U1", None, "Ann", "old@x")), NOW, "r1")
    run_table(ws, UPYA, "users", extract(spark, header, ("U1", None, "Anna", "new@x")), NOW, "r2")
    # repaired before the upsert, so the person is matched instead of inserted again
    assert rows(ws.core("users"), "user_id", "user_email", "username") == [(1, "new@x", "Anna")]


def test_a_failed_table_is_logged_and_the_rest_go_on(spark, ws, rows):
    extracts = {
        "payments": pay(spark, ("t1", "not a date", "A1", "g", "1")),
        "accounts": extract(spark, ["contractNumber", "product"], ("A1", "Kit")),
    }
    log = run_all(ws, [UPYA], lambda p, t: extracts[t], NOW, "r1", tables=["payments", "accounts", "stock"])
    got = {r["table"]: r["status"] for r in log.collect()}
    assert got == {"payments": "failed", "accounts": "written", "stock": "failed"}
    assert ws.store.latest("payments") is None
    assert ws.store.read_log("runs").count() == 3


def test_a_concurrent_version_is_not_overwritten(spark, ws):
    run_table(ws, UPYA, "payments", pay(spark, ("t1", "2024-01-05", "A1", "g", "1")), NOW, "r1")
    with pytest.raises(Exception, match="(?i)exists"):
        ws.store.write_core("payments", ws.core("payments"), after=None)


def test_a_failed_write_does_not_block_the_table(spark, ws, rows):
    run_table(ws, UPYA, "payments", pay(spark, ("t1", "2024-01-05", "A1", "g", "1")), NOW, "r1")
    broken = ws.core("payments").withColumn("group", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        ws.store.write_core("payments", broken, after=0)
    assert ws.store.latest("payments") == 0 and ws.store.orphans("payments", 1 << 62) == []
    done = run_table(ws, UPYA, "payments", pay(spark, ("t2", "2024-01-06", "A1", "g", "2")), NOW, "r1")
    assert done.version == 1 and ws.core("payments").count() == 2


def test_of_two_overlapping_writers_one_wins(spark, ws):
    ws.store.write_core("country", spark.range(1))
    first, second = spark.range(2), spark.range(3)
    assert ws.store.write_core("country", first, after=0) == 1
    with pytest.raises(Exception, match="(?i)exists"):
        ws.store.write_core("country", second, after=0)
    assert ws.store.read_core("country").count() == 2 and ws.store.orphans("country", 1 << 62) == []


def test_a_run_can_be_repeated_under_its_id(spark, ws):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    for _ in range(3):
        assert ws.store.write_staging("upya", "payments", "r1", df).columns == ["a"]
    assert ws.store.latest_staging("upya", "payments") is not None
    assert ws.store.expire_staging("upya", "payments", keep=1) == 2


def test_old_versions_can_be_dropped(spark, ws):
    for n in range(4):
        ws.store.write_core("country", spark.range(n + 1), after=None if n == 0 else n - 1)
    assert ws.store.expire("country", keep=2) == [0, 1]
    assert ws.store.latest("country") == 3
    assert ws.store.read_core("country", 2).count() == 3
    assert ws.store.expire("country", keep=2) == []


def test_delivery_round_trip(spark, ws, rows):
    lines = [(f"t{i}", "2024-01-05 10:00:00", "A1", "g", f"{i}.50") for i in range(5)]
    run_table(ws, UPYA, "payments", pay(spark, *lines), NOW, "r1")
    spec = Delivery("payments", "Payments", 2)
    out = delivery_run.payloads(ws, spec, False, "Root", "app").orderBy("batch_id").collect()
    assert [r["records"] for r in out] == [2, 2, 1]
    assert '<field name="amount"><value>0.5</value></field>' in out[0]["payload"]
    assert '<field name="effective_utc"><value>2024-01-05 10:00:00</value></field>' in out[0]["payload"]
    result = '<result><status>Success</status><field name="payment_external_id"><value>t{0}</value></field><field name="ID"><value>{1}</value></field></result>'
    body = "<response>" + "".join(result.format(i, 900 + i) for i in range(4)) + "</response>"
    responses = spark.createDataFrame([(body,)], "body string")
    delivery_run.store_identifiers(ws, "payments", responses, "body")
    assert rows(ws.core("payments"), "payment_external_id", "remote_id") == [
        ("t0", 900), ("t1", 901), ("t2", 902), ("t3", 903), ("t4", None),
    ]
    again = delivery_run.payloads(ws, spec, False, "Root", "app").collect()
    assert [r["records"] for r in again] == [1]
    known = delivery_run.payloads(ws, spec, True, "Root", "app").collect()
    assert sum(r["records"] for r in known) == 4
    assert any('<criteria>ID=="900"</criteria>' in r["payload"] for r in known)
    fixes = extract(spark, ["payment_external_id", "ID"], ("t4", "77"))
    delivery_run.backfill_identifiers(ws, "payments", fixes)
    assert ws.core("payments").filter("remote_id = 77").count() == 1


def test_stream_equals_batch_and_survives_a_replay(spark, ws, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    head = ",".join(PAYMENT) + "\n"
    (landing / "a.csv").write_text(head + "t1,2024-01-05,A1,g,1\nt2,2024-01-06,A1,g,2\n")

    def run():
        stream = read_landing(spark, str(landing), PAYMENT)
        query = stream_upsert(ws, UPYA, "payments", stream, NOW, str(tmp_path / "cp"), "pay")
        query.awaitTermination()

    run()
    assert ws.core("payments").count() == 2
    (landing / "b.csv").write_text(head + "t2,2024-01-06,A1,g,5\nt3,2024-01-07,A1,g,3\n")
    run()
    shown = ["payment_id", "payment_external_id", "cast(amount AS double)"]
    want = [(1, "t1", 1.0), (2, "t2", 5.0), (3, "t3", 3.0)]
    assert rows(ws.core("payments").selectExpr(*shown)) == want
    version = ws.store.latest("payments")
    run()  # nothing has landed
    assert ws.store.latest("payments") == version
    assert not list((tmp_path / "store").glob("frozen*"))
    # the last batch is seen again, as after a crash between snapshot and commit
    (tmp_path / "cp" / "commits" / "1").unlink()
    crc = tmp_path / "cp" / "commits" / ".1.crc"
    crc.unlink(missing_ok=True)
    run()
    assert ws.store.latest("payments") == version
    assert rows(ws.core("payments").selectExpr(*shown)) == want


def test_rule_sets_cover_the_tables():
    assert set(RULES) == {
        "accounts", "applications", "clients", "payments", "stock", "users", "account_events", "replacements",
    }
