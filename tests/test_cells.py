from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.functions import cells
from tallyloom.operators import clean, conform
from tallyloom.spec import Field


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(column).head()[0]


def test_null_tokens(spark):
    given = ["n/a", "None", "NONE", "n/a;n/a", "NULL", "", "nil", "#N/A", "-1.#QNAN", None]
    df = spark.createDataFrame([(g,) for g in given], "x string")
    got = [r[0] for r in clean.null_tokens(df).collect()]
    assert got == [None] * 6 + ["nil"] + [None] * 3


def test_cleaning_order_leaves_emptied_cells_empty(spark):
    df = spark.createDataFrame([("a<b>\t&c",), ("xundefinedy",), ("undefined",), ("<>",)], "x string")
    assert [r[0] for r in clean.clean_extract(df).collect()] == ["abc", "xy", "", ""]


def test_cleaning_leaves_other_types_alone(spark):
    df = spark.createDataFrame([("n/a", 1, 2.0)], "`a.b` string, i int, d double")
    cleaned = clean.clean_extract(df)
    assert cleaned.schema == df.schema
    assert tuple(cleaned.head()) == (None, 1, 2.0)


@pytest.mark.parametrize(
    ("parts", "sep", "expected"),
    [
        (("Ann", "Bee"), " ", "Ann Bee"),
        ((None, "Bee"), " ", None),
        (("", "Bee"), " ", "Bee"),
        (("\t Ann", " Bee"), " ", "Ann  Bee"),
        (("265", "991"), "", "265991"),
        (("265", None), "", None),
        ((" Ann", "Bee"), " ", "Ann Bee"),
    ],
)
def test_concat(spark, parts, sep, expected):
    column = cells.concat_cols([F.col("a"), F.col("b")], sep)
    assert one(spark, column, a=parts[0], b=parts[1]) == expected


@pytest.mark.parametrize(
    ("text", "corrected", "parity"),
    [
        ("-13.9,33.7", "33.7 -13.9", "33.7 -13.9"),
        ("- -", None, None),
        ("-13.9 33.7", "33.7 -13.9", "-13.9 33.7"),
        (None, None, None),
    ],
)
def test_geo_text(spark, text, corrected, parity):
    assert one(spark, cells.lnglat_text(F.col("x")), x=text) == corrected
    assert one(spark, cells.lnglat_text(F.col("x"), parity=True), x=text) == parity


def test_points_and_axes(spark):
    point = one(spark, cells.point(F.col("x")), x=" 33.7 -13.9")
    assert (point["lng"], point["lat"]) == (33.7, -13.9)
    assert one(spark, cells.latitude(cells.point(F.col("x"))), x="33.7 -13.9") == -13.9
    assert one(spark, cells.latitude(cells.point(F.col("x")), parity=True), x="33.7 -13.9") == 33.7
    assert one(spark, cells.point(F.col("x")), x=None) is None
    with pytest.raises(PySparkException):
        one(spark, cells.point(F.col("x")), x="north")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("+265 (99) 123", "26599123"),
        ("none at all", None),
        (None, "0"),
        ("1234567890123456", "123456789012"),
    ],
)
def test_phone(spark, text, expected):
    assert one(spark, cells.phone_digits(F.col("x")), x=text) == expected


def test_first_match_is_null_on_a_miss(spark):
    column = cells.first_match(F.col("x"), "[0-9]{8}")
    assert one(spark, column, x="unit 12345678 x") == "12345678"
    assert one(spark, column, x="no digits") is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("12.50", "12.5"), ("100", "100"), ("0.00000001", "0.00000001"), ("-0.5", "-0.5"), ("0", "0")],
)
def test_decimal_text(spark, text, expected):
    assert one(spark, cells.decimal_text(F.col("x").cast("decimal(18,8)")), x=text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("on", True), ("OFF", False), (" yes ", True), ("f", False), ("1", True), (None, None)],
)
def test_booleans(spark, text, expected):
    assert one(spark, cells.boolean_text(F.col("x")), x=text) is expected


def test_elapsed_days(spark):
    later, earlier = F.lit("2024-01-02 12:00:00"), F.lit("2024-01-01 00:00:00")
    days = cells.elapsed_days(later.cast("timestamp"), earlier.cast("timestamp"))
    assert one(spark, days) == 1.5


@pytest.mark.parametrize("text", ["", "12.0", "x"])
def test_strict_casts_fail_as_the_database_would(spark, text):
    df = spark.createDataFrame([(text,)], "n string")
    with pytest.raises(PySparkException):
        conform.typed_select(df, [Field("t", "n", "INT")]).collect()
    lenient = conform.typed_select(df, [Field("t", "n", "INT")], strict=False)
    assert lenient.head()["n"] is None


def test_anything_but_two_numbers_is_no_point(spark):
    for text in ("1 2 3", "1", "a b", ""):
        with pytest.raises(Exception, match="not a point"):
            one(spark, cells.point(F.col("x")), x=text)
        assert one(spark, cells.try_point(F.col("x")), x=text) is None


def test_bad_casts_of_all_types(spark):
    fields = [Field("t", "n", "INT"), Field("t", "b", "BOOLEAN"), Field("t", "g", "GEOGRAPHY"), Field("t", "s", "TEXT")]
    df = spark.createDataFrame(
        [("1", "yes", "1 2", "x"), ("x", "no", "1 2", "x"), ("1", "maybe", "1 2", "x"), ("1", "true", "1 2 3", "x"), (None, None, None, None)],
        "n string, b string, g string, s string",
    )
    assert [tuple(r)[:3] for r in conform.bad_casts(df, fields).collect()] == [
        ("x", "no", "1 2"),
        ("1", "maybe", "1 2"),
        ("1", "true", "1 2 3"),
    ]
    assert conform.typed_select(df, fields, strict=False).count() == 5
    assert sum(r.b is None for r in conform.typed_select(df, fields, strict=False).collect()) == 2


def test_bad_casts_and_decimal_scale(spark):
    fields = [Field("t", "n", "INT"), Field("t", "d", "DECIMAL")]
    df = spark.createDataFrame([(" 12 ", "12.55"), ("x", "1"), (None, None)], "n string, d string")
    assert [r["n"] for r in conform.bad_casts(df, fields).collect()] == ["x"]
    good = conform.typed_select(df.filter("n IS NULL OR n <> 'x'"), fields).collect()
    assert (good[0]["n"], str(good[0]["d"])) == (12, "12.55000000")
