from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import aggregate, lookup
from tallyloom.operators.skew import heavy_keys


@pytest.fixture(scope="module")
def maps(spark):
    return spark.createDataFrame(
        [("S", "x", "XX"), ("S", "y", None), ("OTHER", "z", "no")], "col string, val string, target string"
    )


def test_recode_mapped_unmapped_and_mapped_to_null(spark, maps, rows):
    df = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z"), (None, "x")], "k string, s string")
    out = lookup.recode(df, maps, {"s": "S"}, key=["k"])
    assert rows(out) == [("1", "XX"), ("2", None), ("3", "z"), (None, "x")]


def test_recode_over_a_shared_key(spark, maps, rows):
    df = spark.createDataFrame(
        [("a", "s", "x", 1), ("a", "s", "q", 2), ("b", "s", "q", 3), (None, "s", "x", 4), ("a", "s", "y", 5)],
        "asset string, sys string, s string, id int",
    )
    out = lookup.recode(df, maps, {"s": "S"}, key=["asset", "sys"], shared=True)
    assert rows(out, "id", "s") == [(1, "XX"), (2, "XX"), (3, "q"), (4, "x"), (5, None)]


def test_either_key_takes_the_smaller_user(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, fk string")
    users = spark.createDataFrame(
        [(7, None, "a", "seven"), (5, "a", None, "five"), (9, "b", "b", "nine")],
        "user_id int, k1 string, k2 string, name string",
    )
    out = lookup.lookup_any_key(
        df, "fk", users, ["k1", "k2"], {"uid": "user_id", "who": "name"}, pick=["user_id"]
    )
    assert rows(out) == [(1, "a", 5, "five"), (2, "zz", None, None), (3, None, None, None)]


def test_match_with_a_null_value_overwrites(spark, rows):
    df = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "id int, k string, v string")
    dim = spark.createDataFrame([("a", None)], "k string, v string")
    assert rows(lookup.lookup(df, dim, {"k": "k"}, {"v": "v"})) == [(1, "a", None), (2, "b", "old")]


def test_guard_may_compare_both_sides(spark, rows):
    core = spark.createDataFrame([(1, "a@x"), (2, None), (3, "c@x")], "id int, email string")
    new = spark.createDataFrame([(1, "a@y"), (2, "b@y"), (3, "c@x")], "id int, email string")
    out = lookup.repair_identity(core, new, {"id": "id"}, "email", ["email"])
    assert rows(out) == [(1, "a@y"), (2, None), (3, "c@x")]  # null never differs


def test_existence_guard(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "u")], "id int, unit string")
    fill = {"unit": F.lit("asset")}
    some, none = spark.range(3), spark.range(0)
    assert rows(lookup.set_if_exists(df, some, fill, F.col("unit").isNull())) == [(1, "asset"), (2, "u")]
    assert rows(lookup.set_if_exists(df, none, fill, F.col("unit").isNull())) == [(1, None), (2, "u")]


def test_write_back(spark, rows):
    core = spark.createDataFrame([("a", None), ("b", 5), (None, None)], "k string, remote_id bigint")
    ids = spark.createDataFrame([("a", "7"), ("b", None), (None, "9")], "k string, ID string")
    assert rows(lookup.write_back(core, ids, "k")) == [("a", 7), ("b", 5), (None, None)]


def test_counts(spark, rows):
    accounts = spark.createDataFrame(
        [("a", "first", None), ("b", "second", 9), ("c", "second", 9), ("d", None, 4), (None, "second", 9)],
        "k string, sys string, n int",
    )
    payments = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    out = aggregate.count_fill(accounts, payments, "k", "n", F.col("sys") != "first")
    assert rows(out) == [("a", "first", None), ("b", "second", 2), ("c", "second", 0), ("d", None, 4), (None, "second", 0)]


def test_new_members_equal_sequential_inserts(spark, rows):
    dim = spark.createDataFrame([("p", "p"), (None, None)], "product string, ext string")
    one = spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "product string")
    two = spark.createDataFrame([("q",), ("r",)], "product string")
    names = {"product": "product", "ext": "product"}
    at_once = aggregate.new_members(dim, [one, two], "product", names)
    stepwise = aggregate.new_members(
        aggregate.new_members(dim, [one], "product", names), [two], "product", names
    )
    assert rows(at_once) == rows(stepwise) == [("p", "p"), ("q", "q"), ("r", "r"), (None, None)]


def test_new_pairs_see_earlier_sources(spark, rows):
    dim = spark.createDataFrame([("p", "g0")], "product string, grp string")
    one = spark.createDataFrame([("p", "g1"), ("q", "g1"), ("p", "g0")], "product string, grp string")
    two = spark.createDataFrame([("z", "g1"), ("z", "g2")], "product string, grp string")
    out = aggregate.new_member_pairs(dim, [one, two], "grp", ["product", "grp"])
    assert rows(out) == [("p", "g0"), ("p", "g1"), ("q", "g1"), ("z", "g2")]


def test_heavy_keys_are_found_and_salting_changes_nothing(spark, rows):
    facts = spark.range(3000).selectExpr(
        "id", "CASE WHEN id < 1000 THEN 'hot' WHEN id < 1500 THEN NULL ELSE concat('k', id) END AS k"
    )
    dim = facts.selectExpr("k", "id AS v").filter("k IS NOT NULL")
    hot = heavy_keys(facts, ["k", "id"], share=0.1, floor=0)
    assert hot == {"k": ["hot"]}
    salted = lookup.lookup(facts, dim, {"k": "k"}, {"v": "v"}, row_key=["id"], hot=hot["k"])
    assert salted.count() == 3000
    assert rows(salted) == rows(lookup.lookup(facts, dim, {"k": "k"}, {"v": "v"}, row_key=["id"]))
    numbers = facts.selectExpr("id", "CASE WHEN id < 1000 THEN 4L ELSE id END AS n")
    assert heavy_keys(numbers, ["n"], share=0.1, floor=0) == {"n": [4]}


def test_null_and_hot_keys_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(4000).selectExpr(
            "id", "CASE WHEN id < 2000 THEN NULL ELSE 'hot' END AS k"
        )
        dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
        out = lookup.lookup(facts, dim, {"k": "k"}, {"v": "v"}, row_key=["id"], hot=["hot"])
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4
        assert max(sizes) < 2000
        assert out.filter("v = 1").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_never_pair_all_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).selectExpr("id", "cast(id AS string) AS fk")
        users = spark.range(5).selectExpr("id AS u", "cast(id AS string) AS k1", "cast(id * 2 AS string) AS k2")
        out = lookup.lookup_any_key(df, "fk", users, ["k1", "k2"], {"uid": "u"})
        plan = plan_of(out)
        assert "SortMergeJoin" in plan
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "SinglePartition"):
            assert bad not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    facts=st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 3))), max_size=8),
    dim=st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 9))), max_size=8),
)
def test_lookup_against_brute_force(spark, facts, dim):
    left = spark.createDataFrame([(i, *f) for i, f in enumerate(facts)], "id int, k string, v int")
    right = spark.createDataFrame(dim, "k string, w int")
    got = {r["id"]: r["v"] for r in lookup.lookup(left, right, {"k": "k"}, {"v": "w"}, only_null="v").collect()}
    want = {}
    for i, (k, v) in enumerate(facts):
        hits = [w for d, w in dim if d == k and k is not None]
        known = [w for w in hits if w is not None]
        want[i] = (min(known) if known else None) if hits and v is None else v
    assert got == want


def test_keys_nobody_listed_are_split_by_aqe(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "id", "CASE WHEN id < 20000 THEN 'hot' ELSE concat('k', id) END AS k"
        )
        dim = spark.range(0, 60_000, 1, 4).selectExpr("concat('k', id) AS k", "id AS v")
        dim = dim.union(spark.sql("SELECT 'hot', -1L"))
        out = lookup.lookup(facts, dim, {"k": "k"}, {"v": "v"}, row_key=["id"])
        assert out.agg(F.count("*"), F.min("v")).head()[:] == (60_000, -1)
        # the plan of the action itself is final only after it has run
        out.write.format("noop").mode("overwrite").save()
        frame = out.select("id", "v")
        frame.collect()
        assert "skew=true" in plan_of(frame)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
