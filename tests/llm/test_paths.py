"""Repeated windows as paths of a De Bruijn graph."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tallyloom.llm import substring  # noqa: E402


def labels_of(spark, chains, cycle=()):
    """Labels of chains of nodes, each link one label of one window, and of a cycle."""
    rows, number = [], 0
    for chain in [*chains, [*cycle, cycle[0]] if cycle else []]:
        for a, b in zip(chain, chain[1:], strict=False):
            number += 1
            rows.append((1, 0, number, 1, number, number, a, b))
    return spark.createDataFrame(rows, "doc_id long, key long, start int, n int, m long, p long, head long, tail long")


@pytest.mark.parametrize("length", [1, 2, 3, 7, 40])
def test_chains_become_paths(spark, length):
    chain = list(range(100, 101 + length))
    got = sorted((r["m"], r["place"]) for r in substring.paths(labels_of(spark, [chain])).collect())
    # a chain of one label is linked to nothing
    assert got == ([(i + 1, i) for i in range(length)] if length > 1 else [])


def test_paths_end_where_the_graph_branches(spark):
    # 1-2-3 meets 4-2 in 2, and 3 leads on to 5 and to 6
    found = substring.paths(labels_of(spark, [[1, 2, 3], [4, 2], [3, 5, 7], [3, 6]])).collect()
    by = {}
    for r in found:
        by.setdefault(r["path"], []).append((r["place"], r["m"]))
    # 3-5 and 5-7 are labels 4 and 5
    assert [[m for _, m in sorted(x)] for x in by.values()] == [[4, 5]]


def test_cycles_stay_apart(spark):
    found = substring.paths(labels_of(spark, [[1, 2, 3, 4]], cycle=[10, 11, 12])).collect()
    assert sorted((r["m"], r["place"]) for r in found) == [(1, 0), (2, 1), (3, 2)]
    assert substring.paths(labels_of(spark, [])).isEmpty()


def test_long_passages_are_one_span(docs):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(400))
    rows = [(i, " ".join(f"d{i}x{rng.randrange(10**6)}" for _ in range(50)) + " " + passage + f" end{i}") for i in range(5)]
    rows += [(9, "start " + " ".join(passage.split()[100:300]) + " other")]
    got = {r["doc_id"]: [(s["start"], s["n"]) for s in r["spans"]] for r in substring.repeated_spans(docs(rows), 35).collect()}
    # the graph branches where the shorter passage begins and ends; without paths there would be some 26 pieces
    for i in range(5):
        assert sum(n for _, n in got[i]) == 366 and len(got[i]) <= 8
    assert sum(n for _, n in got[9]) == 166 and len(got[9]) <= 5


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_few_words(docs, seed):
    """Texts of three words: cycles, branches and overlaps everywhere."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["a", "b", "ccc"][: 1 + i % 3]) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    got = {r.doc_id: r.kept for r in substring.remove_repeats(docs(rows), width=9, probe=3).collect()}
    left = brute.repeats([t for _, t in rows], 9)
    assert got == {i: " ".join(k) for (i, _), k in zip(rows, left, strict=True)}


def test_digests_are_of_the_words_whatever_stands_between(docs):
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(words)), (2, "\n\t ".join(words)), (3, "  ".join(words[:40]) + "\x0bother")]
    got = {r.doc_id: r.n_removed for r in substring.remove_repeats(docs(rows)).collect()}
    assert got == {1: 50, 2: 50, 3: 40}
