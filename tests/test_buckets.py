"""Core tables in buckets: what a run reads and writes, and that results stay those of whole runs."""

from __future__ import annotations

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_runs import MAPPING, NOW, PAYMENT, UPYA, extract, pay

from tallyloom.plans import delivery_run
from tallyloom.plans.rules import RULES, STEADY
from tallyloom.plans.table_run import Workspace, affected, buckets_to_run, run_table
from tallyloom.sources.snapshots import KEYLESS, Store, bucket_of
from tallyloom.streaming.upsert_stream import read_landing, stream_upsert


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def ws_of(spark, path, **buckets):
    return Workspace(Store(spark, str(path)), MAPPING, buckets=buckets)


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


def bucket(spark, key, n):
    return keyed(spark, (key, 0)).select(bucket_of("k", n).alias("b")).head()["b"]


def test_only_touched_buckets_are_written(spark, store, rows):
    store.write_buckets("t", keyed(spark, *[(f"k{i}", i) for i in range(100)], (None, -1)), "k", 8, tops=["v"])
    first = store.layout("t", 0)
    assert set(first.folders) == {"-1", *map(str, range(8))} and first.tops == {"v": 99}
    b = bucket(spark, "k5", 8)
    assert store.read_core("t", buckets=[KEYLESS]).count() == 1
    part = store.read_core("t", buckets=[b]).withColumn("v", F.when(F.col("k") == "k5", 500).otherwise(F.col("v")))
    assert store.write_buckets("t", part, "k", 8, after=0, touched=[b], tops=["v"]) == 1
    second = store.layout("t", 1)
    assert {x for x in second.folders if second.folders[x] != first.folders[x]} == {str(b)}
    assert second.tops == {"v": 500}
    want = sorted([(f"k{i}", 500 if i == 5 else i) for i in range(100)] + [(None, -1)], key=repr)
    assert rows(store.read_core("t")) == want
    assert store.read_core("t", 0).where("v = 500").isEmpty()
    written = second.folders[str(b)].split("/")[0]
    assert os.listdir(f"{store.root}/core/t/{written}").count(f"__bucket={b}") == 1


def test_rows_of_other_buckets_are_refused(spark, store):
    store.write_buckets("t", keyed(spark, ("a", 1)), "k", 8)
    other = next(f"x{i}" for i in range(50) if bucket(spark, f"x{i}", 8) != bucket(spark, "a", 8))
    with pytest.raises(ValueError, match="outside"):
        store.write_buckets("t", keyed(spark, (other, 1)), "k", 8, after=0, touched=[bucket(spark, "a", 8)])
    with pytest.raises(ValueError, match="has no"):
        store.write_buckets("t", keyed(spark, ("a", 1)), "k", 16, after=0, touched=[0])
    assert store.versions("t") == [0] and store.orphans("t", 1 << 62) == []


def test_emptied_buckets_and_tables(spark, store):
    store.write_buckets("t", keyed(spark, ("a", 1)), "k", 4, tops=["v"])
    store.write_buckets("t", keyed(spark).limit(0), "k", 4, after=0, touched=[bucket(spark, "a", 4)], tops=["v"])
    assert store.layout("t", 1).folders == {} and store.layout("t", 1).tops == {"v": 1}
    assert store.read_core("t").collect() == [] and store.read_core("t").columns == ["k", "v"]
    store.write_buckets("t", keyed(spark, ("b", 2)), "k", 4, after=1, touched=[bucket(spark, "b", 4)], tops=["v"])
    assert store.read_core("t").count() == 1


def test_new_columns_are_null_in_older_buckets(spark, store, rows):
    store.write_buckets("t", keyed(spark, *[(f"k{i}", i) for i in range(20)]), "k", 4)
    b = bucket(spark, "k3", 4)
    part = store.read_core("t", buckets=[b]).withColumn("w", F.lit("x")).drop("v")
    store.write_buckets("t", part, "k", 4, after=0, touched=[b])
    got = {r["k"]: (r["v"], r["w"]) for r in store.read_core("t").collect()}
    assert got["k3"] == (None, "x")
    assert {v for k, v in got.items() if bucket(spark, k, 4) != b} <= {(i, None) for i in range(20)}


def test_dropping_versions_keeps_folders_in_use(spark, store):
    store.write_buckets("t", keyed(spark, *[(f"k{i}", i) for i in range(20)]), "k", 4)
    b = bucket(spark, "k3", 4)
    for n in range(3):
        part = store.read_core("t", buckets=[b]).withColumn("v", F.lit(n))
        store.write_buckets("t", part, "k", 4, after=n, touched=[b])
    assert store.expire("t", keep=1) == [0, 1, 2]
    assert store.read_core("t").count() == 20 and store.orphans("t", 1 << 62) == []


def test_changed_rows_read_only_buckets_that_differ(spark, store, rows):
    store.write_buckets("t", keyed(spark, *[(f"k{i}", i) for i in range(40)]), "k", 8)
    b = bucket(spark, "k7", 8)
    part = store.read_core("t", buckets=[b]).withColumn("v", F.when(F.col("k") == "k7", 70).otherwise(F.col("v")))
    store.write_buckets("t", part, "k", 8, after=0, touched=[b])
    changed = store.changed_rows("t", 0, 1, ["k", "v"])
    assert rows(changed) == [("k7", 7), ("k7", 70)]
    files = changed.inputFiles()
    assert files and all(f"__bucket={b}/" in f for f in files)
    assert store.changed_rows("t", 0, 1, ["k"]).isEmpty()


ACCOUNT = ["contractNumber", "payg", "serial", "product", "deal", "agent"]


def history(ws, spark, rng, steps=5):
    """Random deliveries of accounts, users and payments; returns what is staged in the end."""
    for n in range(steps):
        when = datetime(2024, 1, 1 + n)
        if n != 2:
            accounts = [(f"A{i}", f"U{rng.randrange(99)}", f"S{i}", "Kit", rng.choice(["g", "h", None]), f"P{i % 3}") for i in rng.sample(range(12), 4)]
            run_table(ws, UPYA, "accounts", extract(spark, ACCOUNT, *accounts), when, f"a{n}")
            # a rule of the accounts stands in here: who is responsible
            version = ws.store.latest("accounts")
            named = ws.core("accounts", version).withColumn("responsible_user_id", F.expr(f"CASE WHEN account_id % 3 = {n % 3} THEN 1 ELSE responsible_user_id END"))
            ws.write("accounts", named, version)
        if n in (0, 3):
            users = [(f"P{i}", None, f"N{rng.randrange(9)}", f"u{i}@x") for i in range(2)]
            run_table(ws, UPYA, "users", extract(spark, ["agent", "other", "name", "email"], *users), when, f"u{n}")
        payments = [(f"t{i}", "2024-01-05", f"A{rng.randrange(14)}", rng.choice(["g", "n/a"]), str(i)) for i in rng.sample(range(40), 40 if n == 0 else 3)]
        run_table(ws, UPYA, "payments", pay(spark, *payments), when, f"p{n}")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_runs_equal_whole_runs(spark, tmp_path, rows, seed):
    whole = ws_of(spark, tmp_path / "whole")
    parts = ws_of(spark, tmp_path / "parts", payments=8, accounts=4, users=2)
    for ws in (whole, parts):
        history(ws, spark, random.Random(seed))
    for table in ("payments", "accounts", "users"):
        columns = sorted(whole.core(table).columns)
        assert rows(parts.core(table).select(*columns)) == rows(whole.core(table).select(*columns))
    layouts = [parts.store.layout("payments", v) for v in parts.store.versions("payments")]
    assert layouts[-1].inputs.keys() == {"accounts", "users", "country"}


def test_a_run_covers_staged_keys_and_rows_of_changed_lookups(spark, tmp_path):
    ws = ws_of(spark, tmp_path / "s", payments=64, accounts=64, users=4)
    lines = [(f"t{i}", "2024-01-05", f"A{i}", "g", "1") for i in range(60)]
    accounts = [(f"A{i}", f"U{i}", f"S{i}", "Kit", "g", "P") for i in range(60)]
    run_table(ws, UPYA, "users", extract(spark, ["agent", "other", "name", "email"], ("P", None, "N", "u@x")), NOW, "u")
    ws.store.write_core("country", spark.createDataFrame([(1, "Malawi")], "country_id int, country_name string"))
    run_table(ws, UPYA, "accounts", extract(spark, ACCOUNT, *accounts), NOW, "r")
    run_table(ws, UPYA, "payments", pay(spark, *lines), NOW, "r")
    run_table(ws, UPYA, "accounts", extract(spark, ACCOUNT, ("A7", "new", "S7", "Kit", "g", "P")), NOW, "s")
    pins = {r.table: ws.store.latest(r.table) for r in STEADY["payments"]}
    staged = spark.createDataFrame([("t3",)], "payment_external_id string")
    got = buckets_to_run(ws, "payments", 0, staged, "payments", pins)
    assert set(got) == {bucket(spark, "t3", 64), bucket(spark, "t7", 64)}
    run_table(ws, UPYA, "payments", pay(spark, ("t3", "2024-01-06", "A3", "g", "2")), NOW, "s")
    before, after = ws.store.layout("payments", 0), ws.store.layout("payments", 1)
    assert {int(b) for b in after.folders if after.folders[b] != before.folders.get(b)} == set(got)
    assert ws.core("payments").where("payment_external_id = 't3' AND amount = 2").count() == 1


def test_serials_go_on_from_buckets_not_read(spark, tmp_path):
    ws = ws_of(spark, tmp_path / "s", payments=16)
    run_table(ws, UPYA, "payments", pay(spark, *[(f"t{i}", "2024-01-05", "A1", "g", "1") for i in range(30)]), NOW, "r1")
    run_table(ws, UPYA, "payments", pay(spark, ("new", "2024-01-05", "A1", "g", "1")), NOW, "r2")
    assert ws.core("payments").where("payment_external_id = 'new'").head()["payment_id"] == 31
    assert ws.core("payments").select("payment_id").distinct().count() == 31


def test_identifiers_rewrite_their_buckets(spark, tmp_path):
    ws = ws_of(spark, tmp_path / "s", payments=32)
    run_table(ws, UPYA, "payments", pay(spark, *[(f"t{i}", "2024-01-05", "A1", "g", "1") for i in range(60)]), NOW, "r1")
    fixes = extract(spark, ["payment_external_id", "ID"], ("t4", "77"), (None, "78"), ("unknown", "79"))
    delivery_run.backfill_identifiers(ws, "payments", fixes)
    before, after = ws.store.layout("payments", 0), ws.store.layout("payments", 1)
    changed = {int(b) for b in after.folders if after.folders[b] != before.folders[b]}
    assert changed <= {bucket(spark, "t4", 32), bucket(spark, "unknown", 32)}
    assert ws.core("payments").where("remote_id = 77").count() == 1 and ws.core("payments").count() == 60
    assert (after.inputs, after.tops) == (before.inputs, before.tops)


def test_steady_rule_sets_change_nothing_when_run_again(spark, tmp_path, rows):
    assert set(STEADY) <= set(RULES)
    ws = ws_of(spark, tmp_path / "s")
    history(ws, spark, random.Random(9))
    first = ws.core("payments")
    run_table(ws, UPYA, "payments", pay(spark, ("other", "2024-01-05", None, None, "1")), NOW, "again")
    kept = ws.core("payments").where("payment_external_id <> 'other'").select(*first.columns)
    assert rows(kept) == rows(first)


def test_only_key_columns_are_scanned_for_affected_rows(spark, tmp_path):
    ws = ws_of(spark, tmp_path / "s", payments=4, accounts=4)
    run_table(ws, UPYA, "accounts", extract(spark, ACCOUNT, ("A1", "U1", "S1", "Kit", "g", "P")), NOW, "r1")
    run_table(ws, UPYA, "payments", pay(spark, ("t1", "2024-01-05", "A1", "g", "1")), NOW, "r1")
    run_table(ws, UPYA, "accounts", extract(spark, ACCOUNT, ("A1", "U2", "S1", "Kit", "g", "P")), NOW, "r2")
    reads = STEADY["payments"][0]
    found = affected(ws, "payments", 0, reads, 0, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<payment_external_id:string,account_external_id:string>" in plan
    assert [r[0] for r in found.collect()] == ["t1"]
    assert affected(ws, "payments", 0, reads, 1, 1).collect() == [] and affected(ws, "payments", 0, reads, None, 1) is None


def test_stream_batches_rewrite_their_buckets(spark, tmp_path, rows):
    ws = ws_of(spark, tmp_path / "s", payments=32)
    landing = tmp_path / "landing"
    landing.mkdir()
    head = ",".join(PAYMENT) + "\n"

    def deliver(name, *ids):
        (landing / name).write_text(head + "".join(f"{i},2024-01-05,A1,g,1\n" for i in ids))
        stream = read_landing(spark, str(landing), PAYMENT)
        stream_upsert(ws, UPYA, "payments", stream, NOW, str(tmp_path / "cp"), "pay").awaitTermination()

    deliver("a.csv", *[f"t{i}" for i in range(60)])
    deliver("b.csv", "t3", "new")
    before, after = ws.store.layout("payments", 0), ws.store.layout("payments", 1)
    assert {int(b) for b in after.folders if after.folders[b] != before.folders.get(b)} == {bucket(spark, "t3", 32), bucket(spark, "new", 32)}
    assert ws.core("payments").count() == 61
