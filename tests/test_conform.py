from __future__ import annotations

import pytest

from tallyloom.operators import conform
from tallyloom.sources import extracts, reports
from tallyloom.sources.mapping import read_mapping
from tallyloom.spec import Delivery, Provider, delivery_passes

HEADER = "table,house,type,first,second,update_on,remote,pk"
LINES = [
    HEADER,
    "all,external_sys,TEXT,external_sys,external_sys,,1,",
    "all,remote_id,BIGINT,,,,1,",
    "payments,payment_id,INT,,,,1,1",
    "payments,payment_key,TEXT,id,transaction.id,1,1,",
    "payments,effective_utc,TIMESTAMPTZ,made,date,,1,",
    "payments,recorded_utc,TIMESTAMPTZ,noted,date,,1,",
    "payments,payer,TEXT,name,who.first+who.last,,,",
    "payments,phone,BIGINT,msisdn,code|mobile,,1,",
    "payments,place,GEOGRAPHY,latlong,lat+lng,,,",
    "clients,client_id ,INT,,,,1,1",
]


@pytest.fixture(scope="module")
def mapping(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("mapping") / "mapping.csv"
    path.write_text("﻿" + "\n".join(LINES) + "\n", encoding="utf-8")
    return read_mapping(spark, str(path), canonical="house", outbound="remote")


def test_mapping_resolution(mapping):
    names = [f.name for f in mapping.resolve("payments", "second")]
    assert names == ["payment_key", "effective_utc", "recorded_utc", "payer", "phone", "place"]
    assert [f.name for f in mapping.resolve("payments", "first", system=True)][0] == "external_sys"
    everything = mapping.resolve("payments", system=True, core=True)
    assert {"remote_id", "payment_id"} <= {f.name for f in everything}
    assert [f.name for f in mapping.resolve("payments", system=True, outbound=True)] == [
        "external_sys", "remote_id", "payment_id", "payment_key", "effective_utc", "recorded_utc", "phone",
    ]
    assert mapping.business_key("payments") == "payment_key"
    assert mapping.surrogate("payments") == "payment_id"
    assert mapping.surrogate("clients") == "client_id"  # trimmed
    assert mapping.tables() == ["payments", "clients"]
    with pytest.raises(ValueError):
        mapping.business_key("clients")


def test_projection(spark, mapping, rows):
    df = spark.createDataFrame(
        [("t1", "2024-01-01", "Ann", "Bee", "265", "99", "-13.9", "33.7", "x")],
        "`transaction.id` string, date string, `who.first` string, `who.last` string, code string, "
        "mobile string, lat string, lng string, extra string",
    )
    out = conform.project_mapping(df, mapping.resolve("payments", "second"), "second")
    assert out.columns == ["payment_key", "effective_utc", "recorded_utc", "payer", "phone", "place"]
    assert rows(out) == [("t1", "2024-01-01", "2024-01-01", "Ann Bee", "26599", "33.7 -13.9")]
    parity = conform.project_mapping(df, mapping.resolve("payments", "second"), "second", True)
    assert parity.head()["place"] == "-13.9 33.7"


def test_absent_sources_are_skipped_but_half_a_join_fails(spark, mapping):
    df = spark.createDataFrame([("t1", "99", "Ann", "Bee", "1", "2")], "`transaction.id` string, mobile string, `who.first` string, `who.last` string, lat string, lng string")
    with pytest.raises(ValueError, match="code"):
        conform.project_mapping(df, mapping.resolve("payments", "second"), "second")
    first = conform.project_mapping(
        spark.createDataFrame([("k", "9")], "id string, msisdn string"),
        mapping.resolve("payments", "first"),
        "first",
    )
    assert first.columns == ["payment_key", "phone"]


def test_stamp_and_empty_columns(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "i int, e string, s string")
    kept = conform.drop_all_null_columns(df)
    assert kept.columns == ["i", "s"]
    stamped = conform.stamp_source(kept, Provider("first", "org", "Malawi"))
    assert rows(stamped) == [(1, "a", "first", "org", "Malawi"), (2, None, "first", "org", "Malawi")]


def test_read_extract(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text('id,note.text,zip\n1,"two\nlines, ""quoted""",007\n2,,\n')
    got = extracts.read_extract(spark, str(path))
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["string"] * 3
    first = got.orderBy("id").head()
    assert tuple(first) == ("1", 'two\nlines, "quoted"', "007")
    assert extracts.has_rows(got)
    assert not extracts.has_rows(got.filter("id = '9'"))


def test_files_with_other_headers_do_not_pass_silently(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,a\n")
    (tmp_path / "b.csv").write_text("x,id\nb,2\n")
    both = extracts.read_extract(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    with pytest.raises(Exception, match="(?i)header"):
        both.collect()
    parts = [extracts.read_extract(spark, str(tmp_path / n)) for n in ("a.csv", "b.csv")]
    union = extracts.union_fragments(parts)
    assert sorted(tuple(r) for r in union.collect()) == [("1", "a"), ("2", "b")]


def test_fragments_with_missing_columns(spark, rows):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("2", "y")], "id string, b string")
    assert rows(extracts.union_fragments([a, b])) == [("1", "x", None), ("2", None, "y")]


def test_report_error_fails_a_strict_read(spark):
    df = spark.createDataFrame([("No Such View",)], "t string")
    with pytest.raises(Exception, match="report failed"):
        reports.flatten_report(df, "t", "F", "a int").collect()
    assert reports.report_errors(df, "t").count() == 1


def test_report_flattening(spark, rows):
    text = '{"F":[{"a":1,"b":{"c":"x","d":{"e":2}}},{"a":2,"z":[1,2]}]}'
    df = spark.createDataFrame([(text,)], "t string")
    out = reports.flatten_report(df, "t", "F")
    assert sorted(out.columns) == ["a", "b.c", "b.d.e", "z"]
    assert rows(out, "a", "`b.c`", "`b.d.e`") == [(1, "x", 2), (2, None, None)]


def test_delivery_passes():
    assert delivery_passes(Delivery("t", "T", 10)) == [False, True]
    assert delivery_passes(Delivery("t", "T", 10), insert_only=True) == [False]
    assert delivery_passes(Delivery("t", "T", 10, update=False)) == [False]
