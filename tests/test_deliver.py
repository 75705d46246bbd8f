from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import deliver, numbering, respond


@pytest.fixture
def record(spark):
    return spark.createDataFrame([(7, 1, None, "")], "ID bigint, a int, b string, c string")


def test_add_leaves_out_null_and_empty(record):
    text = deliver.render_add(record, ["a", "b", "c"]).head()["record"]
    assert text == '<add><field name="a"><value>1</value></field></add>'


def test_update_clears_null_and_leaves_out_empty(record):
    text = deliver.render_update(record).select("record").head()["record"]
    assert text == (
        '<update><criteria>ID=="7"</criteria><newvalues><field name="a"><value>1</value></field>'
        '<field name="b"><value></value></field></newvalues></update>'
    )


def test_values_as_text(spark):
    df = spark.sql(
        """SELECT true AS b, TIMESTAMP '2024-01-02 03:04:05' AS t,
        TIMESTAMP_NTZ '2024-01-02 03:04:05.5' AS n, cast(12.5 AS decimal(18,8)) AS d,
        named_struct('lng', 33.7D, 'lat', -13.9D) AS p, 'a&b<c>' AS s"""
    )
    texts = [deliver.value_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    row = df.select(*texts).head()
    assert row["b"] == "True"
    assert row["t"] == "2024-01-02 03:04:05"
    assert row["n"] == "2024-01-02 03:04:05.500000"
    assert row["d"] == "12.5"
    assert row["p"] == "POINT(33.7 -13.9)"
    assert "<value>a&amp;b&lt;c&gt;</value>" in deliver.render_add(df).head()["record"]


def test_seven_rows_in_batches_of_three(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1, 7, 2, 8)], "id int")
    out = numbering.assign_batches(df, ["id"], 3)
    assert sorted(map(tuple, out.collect())) == [(1, 0), (2, 0), (3, 0), (5, 1), (7, 1), (8, 1), (9, 2)]


def test_numbers_are_dense_when_one_value_holds_most_rows(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 0 ELSE id END AS k", "id")
    out = numbering.number_rows(df, ["k", "id"], "n").orderBy("n").collect()
    assert [r["n"] for r in out] == list(range(5000))
    assert [(r["k"], r["id"]) for r in out] == sorted((r["k"], r["id"]) for r in out)


def test_numbering_an_empty_table(spark):
    assert numbering.assign_batches(spark.range(0), ["id"], 3).collect() == []


def test_serials_follow_the_last_one(spark):
    out = numbering.assign_serials(spark.createDataFrame([("b",), ("a",)], "k string"), "pk", ["k"], 10)
    assert sorted(map(tuple, out.collect())) == [("a", 11), ("b", 12)]


def test_payload_order_and_size_guard(spark):
    df = spark.createDataFrame([(3, "c", 0), (1, "a", 0), (2, "b", 0), (4, "d", 1)], "id int, record string, batch_id int")
    out = deliver.build_payloads(df, ["id"], "Root", "app", "Form")
    by_batch = {r["batch_id"]: r for r in out.collect()}
    assert by_batch[0]["payload"] == (
        '<Root><applicationlist><application name="app"><formlist><form name="Form">abc'
        "</form></formlist></application></applicationlist></Root>"
    )
    assert by_batch[1]["records"] == 1
    assert deliver.oversize(out).count() == 0
    assert deliver.oversize(out, 10).count() == 2


RESPONSE = (
    '<response><result><status>Success</status><field name="ID"><value>7</value></field>'
    '<field name="key"><value>a&amp;b</value></field></result>'
    '<result><form><add><values><field type="text" name="key"> <value>q</value></field>'
    "<field name='ID'><value>8</value></field></values><status>Bad</status></add></form></result>"
    '<result><field name="ID"><value>9</value></field></result>'
    '<result><field name="key"><value>cut'
)


def test_responses(spark):
    df = spark.createDataFrame([(1, RESPONSE), (2, "<errorlist/>"), (3, None)], "b int, t string")
    ids = sorted(tuple(r) for r in respond.response_ids(df, "t", "key", keep=["b"]).collect())
    assert ids == [(1, "a&b", "7"), (1, "q", "8")]
    errors = sorted((tuple(r) for r in respond.response_errors(df, "t", ["b"]).collect()), key=repr)
    assert errors == [(1, "Bad"), (2, None)]


def test_references_cdata_and_unpaired_results(spark):
    text = (
        '<result><field name="key"><value><![CDATA[A<1&amp;]]></value></field><field name="ID"><value>1</value></field></result>'
        '<result><field name="key"><value>A&#39;2&#x41;&amp;lt;</value></field><field name="ID"><value>2</value></field></result>'
        '<result><field name="key"><value>only</value></field></result><result><field name="key"><value>cut'
    )
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "b int, t string")
    assert sorted(tuple(r) for r in respond.response_ids(df, "t", "key").collect()) == [("A'2A&lt;", "2"), ("A<1&amp;", "1")]
    unpaired = respond.response_unpaired(df, "t", "key", keep=["b"]).collect()
    assert sorted((r.b, r.key) for r in unpaired if r.key) == [(1, "only")] and len(unpaired) == 2
