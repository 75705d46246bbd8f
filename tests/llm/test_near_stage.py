"""The near-dedup stage keeps one row of each group, also with repeated and null ids."""

from __future__ import annotations

import corpus_pipeline


def test_one_row_of_each_group(spark, docs):
    def text(name, changed=None):
        words = [f"{name}{i}" for i in range(100)]
        if changed is not None:
            words[changed] = "changed"
        return " ".join(words)

    rows = [(1, text("a")), (1, text("a")), (1, text("a", 0)), (2, text("a", 99))]
    rows += [(None, text("b")), (None, text("b")), (None, text("b", 0)), (None, text("c")), (None, text("d")), (9, text("d"))]
    rows += [(5, text("e")), (5, text("f")), (6, None)]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs(rows), "").collect()]
    groups = [(i, t and t.split()[50][0]) for i, t in got]
    assert sorted(groups, key=repr) == sorted([(1, "a"), (None, "b"), (None, "c"), (9, "d"), (5, "e"), (5, "f"), (6, None)], key=repr)
    assert set(got) <= set(rows)
