"""Line dedup against a plain version that aligns each pair on all lines the two share."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tallyloom.llm import lines  # noqa: E402

LICENCE = "this frequent licence line stands in very many documents"


def own(i, n=6):
    return [f"document {i} has a line number {j}" for j in range(n)]


def lost(docs, rows, **options):
    got = {r.doc_id: r for r in lines.dedup_lines(docs(rows), **options).collect()}
    return {i: got[i] for i, _ in rows}


def test_a_copy_loses_a_frequent_line_of_a_third_owner(docs):
    rows = [(i, "\n".join([*own(i), LICENCE])) for i in range(100)]
    rows += [(200, "\n".join([*own(50), LICENCE])), (201, "\n".join([*own(51)[:3], "one line was changed here", *own(51)[4:], LICENCE]))]
    got = lost(docs, rows)
    assert got[200].line_dedup.emptied
    assert got[201].text == "one line was changed here"
    # documents that share nothing rarer meet its owner by it
    assert all(got[i].line_dedup.n_deleted == (i > 0) for i in range(100))


def test_members_of_large_groups_with_a_line_of_their_own(docs):
    rows = [(i, "\n".join([*own("x"), f"only document {i} has this line"])) for i in range(100)]
    got = lost(docs, rows)
    assert all(got[i].text == f"only document {i} has this line" for i in range(1, 100))


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("rare", [1, 4, 64])
def test_equals_plain_version(docs, seed, rare):
    rng = random.Random(seed)
    pool = [[f"w{rng.randrange(9)} v{k} u t" for k in range(rng.randint(1, 8))] for _ in range(12)]
    common = ["a common line here", "another common line here"]
    rows = []
    for i in range(60):
        text = []
        for part in rng.sample(pool, rng.randint(1, 3)):
            text += part
            if rng.random() < 0.5:
                text.append(rng.choice([*common, "", f"line of document {i} only"]))
        rows.append((i, "\n".join(text) if rng.random() < 0.7 or not rows else rng.choice(rows)[1]))
    got = lost(docs, rows, rare=rare)
    assert [got[i].line_dedup.n_deleted for i, _ in rows] == [len(x) for x in brute.deleted(rows, rare)]


def test_short_lines_go_with_their_block(docs):
    text = ["Title", "", *own(1)[:3], "Part two", "ok", *own(1)[3:], "", "End"]
    rows = [(1, "\n".join(text)), (2, "\n".join(text)), (3, "\n".join(["Other title", *text[1:5], "Part three", "ok", *text[7:]])), (4, "Title\nPart two")]
    got = lost(docs, rows)
    assert got[1].text == rows[0][1] and got[4].text == rows[3][1]
    assert got[2].line_dedup.emptied and got[2].text == ""
    assert [x for x in got[3].text.split("\n") if x] == ["Other title", "Part three"]
    assert [got[i].line_dedup.n_deleted for i, _ in rows] == [len(x) for x in brute.deleted(rows)]


def test_short_lines_align_once():
    short = [lines._SHORT.pack(i, bytes(16)) for i in range(10)]
    first = {"pos": 0, "owner_pos": 0, "before": None, "owner_before": None, "after": short[1] + short[2], "owner_after": short[1]}
    last = {"pos": 3, "owner_pos": 2, "before": short[1] + short[2], "owner_before": short[1], "after": None, "owner_after": None}
    assert lines._with_short([first, last]) == [(0, 0), (1, 1), (3, 2)]
