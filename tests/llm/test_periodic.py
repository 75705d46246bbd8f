"""Periodic runs against the definition, whole documents and exploded ones."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import periodic
from tallyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

SMALL = st.lists(st.sampled_from("ab"), max_size=60)
BLOCKS = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9)), max_size=5)


def ids_of(words):
    numbers = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def found_whole(texts):
    parts = [ids_of(t) for t in texts]
    most = periodic.octaves(max(map(len, parts), default=0))
    found = periodic.fragments(parts, 0, most, 6, 4, [(False, False)] * len(parts))
    return [sorted(((s, e - s, p) for p, s, e in f), key=lambda r: (r[0], r[2])) for f in found]


def found_in_pieces(words, size):
    ids, out = ids_of(words), []
    for low, high, start, stop in periodic.cuts(len(ids), size):
        open_ = (start > 0, stop < len(ids))
        out += [(p, s + start, e + start) for p, s, e in periodic.fragments([ids[start:stop]], low, high, 6, 4, [open_])[0]]
    whole = [(s, e - s, p) for p, s, e in periodic.joined(out) if e - s >= max(6, 4 * p)]
    return sorted(whole, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(SMALL, min_size=1, max_size=3))
def test_runs_of_random_words(texts):
    assert found_whole(texts) == [brute.runs(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(BLOCKS, st.sampled_from([16, 32]))
def test_runs_of_repeated_blocks(blocks, size):
    words = [w for block, times in blocks for w in block * times]
    assert found_whole([words]) == [brute.runs(words)]
    assert found_in_pieces(words, size) == brute.runs(words)


def test_long_periods_meet_across_pieces():
    rng = random.Random(3)
    words = [str(rng.randrange(50)) for _ in range(300)]
    block = [str(rng.randrange(50)) for _ in range(170)]
    words = words + block * 5 + words + ["x"] * 400 + ["y", "x"] * 150
    want = brute.runs(words)
    assert {q for _, _, q in want} >= {1, 2, 170}
    for size in (16, 64, 256):
        assert found_in_pieces(words, size) == want


def test_z_values():
    for text in ("", "a", "aaaa", "abcab", "abababa"):
        agree = [next((k for k in range(len(text) - i) if text[k] != text[i + k]), len(text) - i) for i in range(len(text))]
        assert periodic.z_values(list(text)) == agree


def test_one_word_repeated_costs_little_more_than_its_length():
    assert found_whole([["w"] * 20_000]) == [[(0, 20_000, 1)]]


def checked(rows, found):
    got = sorted((repr(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect())
    want = []
    for id, text in rows:
        w = brute.words(text)
        want.append((repr(id), brute.runs(w), brute.collapsed(w, brute.runs(w))))
    assert got == sorted(want)


ROWS = [
    (1, "a b a b a b a b c"),
    (1, "a b a b a b a b c"),  # repeated
    (1, "another text of the same id"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "no id " * 8),
    (None, "no id " * 8),
    (None, None),
    (5, "h " * 5),
    (6, "é ü " * 40 + "é"),
    (7, " ".join(str(i) for i in range(300)) + " " + "tick tock " * 300),
    (8, ("x y z " * 30 + "w ") * 20),
]


def test_defined_cases(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, runs int")
    checked(ROWS, periodic.periodic_runs(docs))
    checked(ROWS, periodic.periodic_runs(docs, piece_words=16))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(docs).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("k", "a " * 7)], "doc_id string, text string")
    row = periodic.periodic_runs(docs).first()
    assert (row["doc_id"], row["n_words"], row["collapsed"]) == ("k", 7, "a")


def test_fewer_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string"), min_periods=3)


@needs_data
def test_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    strongest = 0
    for doc in docs:
        w = brute.words(doc["text"])
        h = zlib.crc32(str(doc["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        found = brute.runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(found)
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute.collapsed(w, found).encode()).hexdigest()
        strongest += bool(found)
    assert strongest > 5
