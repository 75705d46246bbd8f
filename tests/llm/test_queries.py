"""Registered queries on the smallest given tables, and every pipeline stage on its own input."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SMALL  # noqa: E402

from tallyloom.llm import quality  # noqa: E402
from tallyloom.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(ORACLE[name])
    names = [x[0] for x in found.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_quality_query(spark, small):
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, SMALL).collect()}
    for r in small["documents"].collect():
        x, n = got[r.doc_id], brute.counts(r.text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == n
        assert x.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (x.base_failed and x.kept)


def test_pii_and_secret_queries(spark, small):
    pii = {r.doc_id: r for r in QUERIES["op8_pii_deobfuscation"](spark, SMALL).collect()}
    secrets = {r.doc_id: r for r in QUERIES["op9_secret_entropy"](spark, SMALL).collect()}
    for r in small["documents"].collect():
        spans = brute.pii(r.text)
        x = pii[r.doc_id]
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(len(spans[k]) for k in ("email", "ip", "card", "phone"))
        assert x.base_sha256 == brute.sha(",".join(f"{k}:{s}:{e}" for k, v in spans.items() for s, e in v))
        found = brute.secrets(r.text)
        assert secrets[r.doc_id].base_sha256 == brute.sha(",".join(f"{brute.SECRETS[k]}:{s}:{e}" for s, k, e in found))


def test_line_query(spark, small):
    rows = sorted((r.doc_id, r.text) for r in small["documents"].collect())
    got = QUERIES["op6_line_alignment"](spark, SMALL).orderBy("doc_id").collect()
    assert [r.n_deleted for r in got] == brute.deleted_lines(rows, 64, 4)


def test_pipeline_stages(spark, small):
    docs = small["documents"].withColumn("_q", small["documents"]["n_chars"])
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        assert docs.columns == [*small["documents"].columns, "_q"]
        kept.append({r.doc_id: r for r in docs.collect()})
    first, lines, near, clean = kept
    start = {r.doc_id: r for r in small["documents"].collect()}
    judged = quality.judge(quality.measure(small["documents"]), quality.fit(quality.measure(small["documents"]), small["labels"]))
    assert set(first) == {r.doc_id for r in judged.where("verdict.kept").collect()}
    assert all(first[i].text == start[i].text for i in first)
    rows = sorted((i, r.text) for i, r in first.items())
    gone = dict(zip((i for i, _ in rows), brute.deleted_lines(rows, 64, 4), strict=True))
    for i, n in gone.items():
        if i in lines:
            assert lines[i].n_chars == len(lines[i].text) and first[i].text.count("\n") - lines[i].text.count("\n") == n
        else:
            assert n > 0
    rows = sorted((i, r.text) for i, r in lines.items())
    assert set(near) == {i for i, _, c in brute.near(rows, 5) if i == c}
    rows = sorted((i, r.text) for i, r in near.items())
    hits = {d for d, *_ in brute.contained(rows, [(r.item_id, r.text) for r in small["benchmark"].collect()])}
    assert set(clean) == set(near) - hits and hits
    pieces = corpus_pipeline.pack(spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(clean)


def test_pipeline_runs_whole(spark):
    assert QUERIES is not None and corpus_pipeline.run(spark, SMALL).count() > 0
