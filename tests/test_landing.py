"""Dated landing folders with their ledger, and table runs that overlap."""

from __future__ import annotations

import threading
import time
from datetime import date, datetime

import pytest
from test_runs import NOW, PAYMENT, UPYA, extract, pay, ws  # noqa: F401

from tallyloom.plans.rules import RULES
from tallyloom.plans.schedule import RULE_READS, Job, run_jobs, table_job, waits_for
from tallyloom.plans.table_run import run_all, run_landed
from tallyloom.sources.landing import Landing
from tallyloom.sources.snapshots import Store

HEAD = ",".join(PAYMENT) + "\n"


@pytest.fixture
def feed(spark, tmp_path):
    return Landing(spark, str(tmp_path / "landing"))


def put(feed, day, name, text):
    import pathlib

    folder = pathlib.Path(feed.root) / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    for crc in folder.glob(".*.crc"):
        crc.unlink()


def names(files):
    return [f.path.rsplit("/", 1)[1] for f in files]


def test_each_file_is_taken_once(spark, ws, feed, rows):  # noqa: F811
    put(feed, "2024-01-01", "old.csv", HEAD + "t0,2024-01-01,A,g,1\n")
    put(feed, "2024-01-09", "a.csv", HEAD + "t1,2024-01-09,A,g,1\n")
    put(feed, "2024-01-10", "b.csv", "amount,transactionId,extra\n2,t2,x\n")  # another header
    put(feed, "2024-01-10", "_hidden.csv", "no extract")
    as_of = datetime(2024, 1, 10, 12)
    assert feed.window(as_of, 7) == (date(2024, 1, 3), date(2024, 1, 10))
    done = run_landed(ws, UPYA, "payments", feed, as_of, "r1")
    assert done.status == "written"
    shown = ["payment_external_id", "cast(amount AS int)", "cast(effective_utc AS date)"]
    assert rows(ws.core("payments").selectExpr(*shown)) == [("t1", 1, date(2024, 1, 9)), ("t2", 2, None)]
    assert run_landed(ws, UPYA, "payments", feed, as_of, "r2").message == "nothing has landed"
    # a late file of an earlier day, and a file delivered again in another state
    put(feed, "2024-01-08", "late.csv", HEAD + "t3,2024-01-08,A,g,3\n")
    put(feed, "2024-01-09", "a.csv", HEAD + "t1,2024-01-09,A,g,100\n")
    assert names(feed.pending(*feed.window(as_of, 7))) == ["late.csv", "a.csv"]
    run_landed(ws, UPYA, "payments", feed, as_of, "r3")
    got = rows(ws.core("payments").selectExpr("payment_external_id", "cast(amount AS int)"))
    assert got == [("t1", 100), ("t2", 2), ("t3", 3)]
    assert sorted(r["run"] for r in feed.taken(date(2024, 1, 1), date(2024, 1, 31)).collect()) == ["r1", "r1", "r3", "r3"]


def test_a_failed_run_takes_nothing(spark, ws, feed):  # noqa: F811
    put(feed, "2024-01-10", "bad.csv", HEAD + "t1,soon,A,g,1\n")
    window = feed.window(datetime(2024, 1, 10), 7)
    with pytest.raises(Exception, match="(?i)cast"):
        run_landed(ws, UPYA, "payments", feed, datetime(2024, 1, 10), "r1")
    assert names(feed.pending(*window)) == ["bad.csv"] and feed.taken(*window).isEmpty()


def test_only_the_days_asked_for_are_read(spark, feed):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        put(feed, day, "x.csv", HEAD)
        feed.take(feed.arrived(date.fromisoformat(day), date.fromisoformat(day)), "r")
    some = feed.taken(date(2024, 1, 2), date(2024, 1, 2))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan
    assert [r["day"] for r in some.collect()] == [date(2024, 1, 2)]
    assert feed.arrived(date(2023, 1, 1), date(2023, 1, 5)) == []


def test_runs_wait_for_runs_they_share_a_table_with():
    jobs = [
        table_job("a", "clients", None, "clients"),
        table_job("a", "stock", None, "stock"),
        table_job("a", "accounts", "core", "accounts"),
        table_job("a", "payments", None, "payments"),
        table_job("b", "clients", None, "clients"),
        table_job("b", "users", "users", "users"),
    ]
    assert waits_for(jobs) == [set(), set(), {0, 1}, {2}, {0, 2}, {0, 1, 2, 3, 4}]
    assert set(RULE_READS) <= set(RULES)


def test_reads_of_rule_sets_are_those_of_the_rules(spark):
    """Every table a rule asks its context for is listed."""
    import inspect
    import re

    from tallyloom.plans import rules

    source = inspect.getsource(rules)
    named = set(re.findall(r'ctx\.table\("(\w+)"\)', source))
    assert named == {t for reads in RULE_READS.values() for t in reads}


def test_untied_jobs_overlap_and_tied_ones_do_not(spark):
    jobs = [Job("x", frozenset(), frozenset({"x"})), Job("y", frozenset(), frozenset({"y"})), Job("z", frozenset({"x"}), frozenset({"z"}))]
    both = threading.Barrier(2, timeout=20)
    spans = {}

    def work(i):
        start = time.monotonic()
        if i < 2:
            both.wait()  # passes only if both run at once
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        spans[i] = (start, time.monotonic())
        return pool

    assert run_jobs(spark, jobs, work, parallel=2) == ["x", "y", "z"]
    assert spans[2][0] >= spans[0][1]
    assert run_jobs(spark, [], work, parallel=2) == []


def test_overlapping_runs_give_the_same_tables(spark, tmp_path, rows, ws):  # noqa: F811
    from dataclasses import replace

    extracts = {
        "users": extract(spark, ["agent", "other", "name", "email"], ("P", None, "N", "u@x")),
        "stock": extract(spark, ["serial", "product", "state", "holder"], ("S1", "Kit", "new", "P")),
        "accounts": extract(spark, ["contractNumber", "payg", "serial", "product", "deal", "agent"], ("A1", "U1", "S1", "Kit", "g", "P")),
        "payments": pay(spark, ("t1", "2024-01-05", "A1", "g", "1"), ("t2", "bad", "A1", "g", "1")),
        "webusers": extract(spark, ["email", "number", "name"], ("w@x", "1", "W")),
    }
    other = replace(ws, store=Store(spark, str(tmp_path / "other")))
    tables = list(extracts)
    one = run_all(ws, [UPYA], lambda p, t: extracts[t], NOW, "r1", tables=tables)
    two = run_all(other, [UPYA], lambda p, t: extracts[t], NOW, "r1", tables=tables, parallel=3)
    assert rows(one, "table", "status") == rows(two, "table", "status")
    assert [r["status"] for r in two.collect()].count("failed") == 1
    for table in ("users", "stock", "accounts", "webusers", "products", "pricing_groups"):
        assert rows(ws.core(table)) == rows(other.core(table))
