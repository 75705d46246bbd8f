"""Keys that become heavy through a rule, pairs under heavy keys, and cells set aside."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from statistics import median

import pytest
from pyspark.sql import functions as F
from test_runs import NOW, UPYA, pay, ws  # noqa: F401

from tallyloom.operators.lookup import FOLD, _folded, join_every, null_on_match, without_matches
from tallyloom.plans.context import Context, instant
from tallyloom.plans.rules import derive_replacements, payment_account, payment_user
from tallyloom.plans.table_run import filled_keys, refused, run_table

ASIDE = replace(UPYA, tables={**UPYA.tables, "payments": replace(UPYA.tables["payments"], set_aside=True)})


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def sizes(df):
    """Rows of each task; all columns are asked for, so no join is left out."""
    tasks = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.struct(*df.columns)))
    return sorted(r["n"] for r in tasks.collect())


def test_keys_filled_by_a_rule_are_salted(spark, no_aqe):
    payments = spark.range(40_000).selectExpr(
        "concat('t', id) AS payment_external_id", "concat('A', id % 1000) AS account_external_id",
        "timestamp'2024-01-01' AS effective_utc", "cast(NULL AS int) AS account_id", "cast(NULL AS string) AS unit_number",
        "'g' AS pricing_group", "cast(NULL AS int) AS responsible_user_id", "cast(NULL AS string) AS responsible_user",
        "cast(NULL AS string) AS responsible_user_ext_id", "'upya' AS external_sys",
    )
    # half of the accounts are one agent's
    accounts = spark.range(1000).selectExpr(
        "concat('A', id) AS account_external_id", "cast(id AS int) AS account_id", "'u' AS unit_number", "'g' AS pricing_group",
        "cast(CASE WHEN id % 2 = 0 THEN 7 ELSE 1000 + id END AS int) AS responsible_user_id", "'x' AS responsible_user_external_id",
    )
    users = spark.range(3000).selectExpr("cast(id AS int) AS user_id", "concat('n', id) AS username", "'a' AS user_angaza_id", "'b' AS user_upya_id")
    tables = {"accounts": accounts, "users": users}
    plain = Context(tables.__getitem__, instant(NOW))
    hot = filled_keys(payments, "payments", plain, floor=1000)
    assert hot == {"responsible_user_id": [7]}
    salted = Context(tables.__getitem__, instant(NOW), hot=hot)

    def done(ctx):
        return payment_user(payment_account(payments, ctx), ctx)

    rows = sizes(done(salted))
    assert max(rows) <= 3 * median(rows)
    assert max(sizes(done(plain))) > 3 * median(sizes(done(plain)))
    assert done(salted).where("responsible_user = 'n7'").count() == 20_000


def test_every_pair_under_a_heavy_key(spark, no_aqe):
    left = spark.range(9000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'h' WHEN id % 3 = 1 THEN concat('k', id) END AS k")
    right = spark.createDataFrame([("h", 1), ("h", 2), ("k1", 3), (None, 4)], "j string, v int")
    for hot in ((), ("h",), ("h", "k1", "none")):
        out = join_every(left, right, ("k", "j"), ["id"], hot)
        assert out.columns == ["id", "k", "j", "v"]
        assert sorted((r["id"], r["v"]) for r in out.collect()) == sorted([(i, v) for i in range(0, 9000, 3) for v in (1, 2)] + [(1, 3)])
    assert len(sizes(join_every(left, right, ("k", "j"), ["id"], ("h",)))) > 8


def test_rows_of_a_heavy_key_are_met_in_arrays(spark, no_aqe):
    left = spark.range(60).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'h' WHEN id % 3 = 1 THEN 'k' END AS k")
    # 700 rows of the heavy key, each of them twice, and a key that is not heavy on the left
    right = spark.range(1500).selectExpr("CASE WHEN id < 700 THEN 'h' WHEN id < 703 THEN 'k' WHEN id < 1400 THEN 'x' END AS j", "cast(id div 2 AS int) AS v", "'a' AS `w.x`")
    plain, folded = (join_every(left, right, ("k", "j"), ["id"], hot) for hot in ((), ("h",)))
    assert folded.schema == plain.schema
    counts = [Counter(map(tuple, df.collect())) for df in (plain, folded)]
    assert counts[0] == counts[1] and counts[1].total() == 20 * 700 + 20 * 3
    assert set(v for (_, k, *_), v in counts[1].items() if k == "h") == {2}
    # what the join gives before the arrays are unfolded
    plan = folded._jdf.queryExecution().executedPlan()
    assert plan.toString().index("Generate inline") < plan.toString().index("Join")
    folds = _folded(right, "j", ("h",)).selectExpr("__key", "size(__rows) AS n").collect()
    assert sorted(r["n"] for r in folds if r["__key"] == "h") == [700 - 2 * FOLD, FOLD, FOLD]
    assert Counter(r["n"] for r in folds if r["__key"] != "h") == {1: 700}
    only = join_every(left, right.select("j"), ("k", "j"), ["id"], ("h",))
    assert only.columns == ["id", "k", "j"] and only.count() == counts[1].total()


def test_rows_without_matches_under_a_heavy_key(spark, rows):
    left = spark.createDataFrame([(1, "h"), (2, "h"), (3, "k"), (4, "m"), (5, None)], "id int, k string")
    right = spark.createDataFrame([("h",), ("h",), ("m",), (None,)], "j string")
    for hot in ((), ("h",), ("h", "k")):
        assert rows(without_matches(left, right, ("k", "j"), ["id"], hot)) == [(3, "k"), (5, None)]


def test_replacements_of_a_heavy_unit_are_spread_before_they_multiply(spark, no_aqe):
    # the stock is broadcast, so its rows are paired where the recorded events have been met
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    accounts = spark.range(6000).selectExpr(
        "id AS account_id", "CASE WHEN id < 5000 THEN '7' ELSE concat('u', id % 2) END AS previous_unit_number", "'s' AS external_sys", "'p' AS product",
        "id AS stock_id", "'n' AS unit_number", "'a' AS asset_number", "timestamp'2024-01-01' AS date_of_replacement_utc",
        "'w' AS responsible_user", "1 AS responsible_user_id", "'x' AS responsible_user_external_id",
    )
    stock = spark.range(5).selectExpr("id AS stock_id", "CASE WHEN id < 3 THEN '7' ELSE concat('u', id - 3) END AS unit_number", "'a' AS asset_number", "false AS archived")
    known = spark.createDataFrame([("Ru1",), ("R9",), (None,)], "replacement_external_id string")
    done = derive_replacements(accounts, stock, known, ["7"])
    assert done.groupBy("replacement_external_id").count().orderBy("replacement_external_id").collect() == [("R7", 15_000), ("Ru0", 500)]
    assert max(sizes(done)) < 5000


def test_clearing_takes_heavy_values(spark, rows):
    facts = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "id int, a int")
    dim = spark.createDataFrame([(5, None), (6, "s")], "a int, s string")
    done = null_on_match(facts, dim, {"a": "a"}, "a", dim_where="s IS NULL", row_key=["id"], hot=[5])
    assert rows(done) == [(1, None), (2, None), (3, 6), (4, None)]


def test_refused_rows_are_set_aside_and_the_rest_go_on(spark, ws, rows):  # noqa: F811
    lines = pay(
        spark,
        ("t1", "2024-01-05", "A1", "g", "1"),
        ("t2", "not a date", "A1", "g", "much"),
        ("t3", "2024-01-05", "A1", "g", "more"),
        (None, "2024-01-05", "A1", "g", "x"),
    )
    done = run_table(ws, ASIDE, "payments", lines, NOW, "r1")
    assert done.status == "written" and done.message == "3 staged rows set aside for cells of another type"
    assert [r["payment_external_id"] for r in ws.core("payments").collect()] == ["t1"]
    assert rows(refused(ws, ASIDE, "payments", "r1"), "key", "column", "value", "type") == [
        ("t2", "amount", "much", "DECIMAL"),
        ("t2", "effective_utc", "not a date", "TIMESTAMPTZ"),
        ("t3", "amount", "more", "DECIMAL"),
        (None, "amount", "x", "DECIMAL"),
    ]
    # a repaired delivery goes through, and leaves nothing behind
    done = run_table(ws, ASIDE, "payments", pay(spark, ("t2", "2024-01-05", "A1", "g", "2")), NOW, "r2")
    assert done.message is None and refused(ws, ASIDE, "payments", "r2").isEmpty()
    assert ws.core("payments").count() == 2


def test_without_the_switch_a_refused_cell_fails_the_run(spark, ws):  # noqa: F811
    with pytest.raises(Exception, match="(?i)cast"):
        run_table(ws, UPYA, "payments", pay(spark, ("t1", "soon", "A1", "g", "1")), NOW, "r1")


def test_all_rows_refused(spark, ws):  # noqa: F811
    done = run_table(ws, ASIDE, "payments", pay(spark, ("t1", "soon", "A1", "g", "1")), NOW, "r1")
    assert done.status == "written" and ws.core("payments").count() == 0


def test_filled_keys_are_sought_without_the_upsert(spark, tmp_path, monkeypatch):
    from checks.stores import MAPPING
    from checks.stores import UPYA as HOUSE
    from tallyloom.plans import table_run
    from tallyloom.sources.snapshots import Store

    ws = table_run.Workspace(Store(spark, str(tmp_path / "store")), MAPPING)
    ws.store.write_core("country", spark.createDataFrame([(1, "NATION_7")], "country_id int, country_name string"))
    accounts = spark.createDataFrame([("A1", "u1", "g", "7"), ("A2", "u2", "g", "7")], "contract string, unit string, deal string, agent string")
    run_table(ws, HOUSE, "accounts", accounts, NOW, "r1")
    owned = ws.core("accounts").withColumn("responsible_user_id", F.lit(7))
    ws.write("accounts", owned, ws.store.latest("accounts"))
    rows = [(f"p{i}", "2024-01-01 00:00:00", f"A{i % 2 + 1}", "1", "g") for i in range(20)]
    found, frames = [], []

    def seen(rows, rules, ctx, floor=0):
        frames.append(rows._jdf.queryExecution().optimizedPlan().toString())
        found.append(filled_keys(rows, rules, ctx, 0))
        return found[-1]

    monkeypatch.setattr(table_run, "FLOOR", 0)
    monkeypatch.setattr(table_run, "filled_keys", seen)
    names = "id string, date string, contract string, amount string, group string"
    for run, some in (("r1", rows), ("r2", rows[:5])):
        assert run_table(ws, HOUSE, "payments", spark.createDataFrame(some, names), NOW, run).status == "written"
    assert found == [{"responsible_user_id": [7]}] * 2
    assert not any(word in frame for frame in frames for word in ("Join", "Aggregate"))
    # without a column the provider delivers, what is staged alone says too little
    short = spark.createDataFrame([r[:4] for r in rows[:5]], names.rsplit(",", 1)[0])
    assert run_table(ws, HOUSE, "payments", short, NOW, "r3").status == "written"
    assert "Join" in frames[-1] and found[-1] == {"responsible_user_id": [7]}


def test_characters_are_deleted_from_cells_that_hold_one(spark):
    from tallyloom.functions import cells

    texts = [None, "", "plain", "a<b>&c", "\ttab\n", "\r", "<None>", "None", "n/a", "unde<fined", "undefined x", "é<ü"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = cells.strip_literal(cells.strip_chars(cells.null_token("t")))
    got = rows.selectExpr(f"{cells.clean_cell('t')} AS new", f"{plain} AS old").collect()
    assert [r.new for r in got] == [r.old for r in got]
    assert got[3].new == "abc" and got[6].new == "None" and got[7].new is None
    assert "translate" in cells.clean_cell("t").split(" THEN ", 2)[2]
