from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import upsert

NOW = datetime(2024, 1, 1)


@pytest.fixture
def core(spark):
    return spark.createDataFrame(
        [(1, "a", "MWK", 1.0), (2, "b", "UGX", 2.0), (3, None, "ZMW", 3.0)],
        "id int, k string, currency string, amount double",
    )


@pytest.fixture
def staging(spark):
    return spark.createDataFrame([("b", None), ("c", 9.0), (None, 7.0)], "k string, amount double")


def plain(df):
    return sorted((tuple(r) for r in df.drop("change_timestamp").collect()), key=repr)


@pytest.mark.parametrize("small", [True, False, None])
def test_null_cell_overwrites_and_absent_column_stays(core, staging, small):
    out = upsert.upsert(core, staging, "k", NOW, small=small)
    assert plain(out) == [(1, "a", "MWK", 1.0), (2, "b", "UGX", None), (3, None, "ZMW", 3.0), (None, "c", None, 9.0)]
    stamped = {r["k"] for r in out.filter("change_timestamp IS NOT NULL").collect()}
    assert stamped == {"b", "c"}  # inserted rows are stamped like updated ones


def test_one_pass_is_insert_then_update(core, staging):
    inserted = upsert.insert_missing(staging, core, "k")
    two_steps = upsert.update_matched(inserted, staging, "k", NOW)
    one_pass = upsert.upsert(core, staging, "k", NOW)
    assert sorted(map(tuple, two_steps.collect()), key=repr) == sorted(map(tuple, one_pass.collect()), key=repr)


def test_twice_is_once(core, staging):
    once = upsert.upsert(core, staging, "k", NOW)
    assert plain(upsert.upsert(once, staging, "k", NOW)) == plain(once)


def test_null_keys_are_set_aside_even_for_an_empty_core(core, staging):
    empty = core.filter("id > 100")
    out = upsert.upsert(empty, staging, "k", NOW)
    assert {r["k"] for r in out.collect()} == {"b", "c"}
    assert [tuple(r) for r in upsert.null_keys(staging, "k").collect()] == [(None, 7.0)]


def test_null_core_key_does_not_block_inserts(core, staging):
    assert "c" in {r["k"] for r in upsert.insert_missing(staging, core, "k").collect()}


def test_duplicate_keys_take_the_last_in_order(spark, core):
    staged = spark.createDataFrame(
        [("b", 1.0, "2024-01-01"), ("b", 5.0, "2024-03-01"), ("b", 9.0, "2024-02-01")],
        "k string, amount double, day string",
    )
    out = upsert.upsert(core, staged, "k", NOW, order_by=["day"])
    assert out.filter("k = 'b'").collect()[0]["amount"] == 5.0
    assert out.count() == core.count()


def test_predicate_stops_insert_and_update(core, staging):
    out = upsert.upsert(core, staging, "k", NOW, where="amount > 10")
    assert plain(out) == plain(core)
    as_column = upsert.upsert(core, staging, "k", NOW, where=F.col("amount") > 8)
    assert {r["k"] for r in as_column.collect()} == {"a", "b", "c", None}


def test_declared_unique_staging_still_sets_null_keys_aside(core, staging):
    out = upsert.upsert(core, staging, "k", NOW, unique=True)
    assert out.count() == 4


@pytest.mark.parametrize("small", [True, False])
def test_many_null_core_keys_go_round_the_join(spark, staging, small):
    core = spark.range(200).selectExpr("id", "cast(NULL AS string) AS k", "0.0D AS amount")
    out = upsert.upsert(core, staging, "k", NOW, small=small)
    assert out.filter("k IS NULL").count() == 200
    assert out.count() == 202


def test_few_staged_rows_never_shuffle_the_core(spark, tmp_path):
    spark.range(10_000).selectExpr("cast(id AS string) AS k", "id AS v").write.parquet(str(tmp_path / "core"))
    spark.range(5).selectExpr("cast(id AS string) AS k", "-id AS v").write.parquet(str(tmp_path / "new"))
    core, staged = (spark.read.parquet(str(tmp_path / n)) for n in ("core", "new"))
    out = upsert.upsert(core, staged, "k", NOW)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    branch = plan.split("LeftOuter")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in branch
    assert out.count() == 10_000
    assert upsert.upsert(core, staged, "k", NOW, small=False).exceptAll(out).count() == 0
