"""Random tokens of one letter case with digits."""

from __future__ import annotations

import random

from tallyloom.llm import secrets


def test_tokens_of_one_case_are_reported_once(docs):
    rng = random.Random(1)
    base36 = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
    base32 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(32))
    rows = [
        (1, f"key {base36} end"),
        (2, f"seed={base32}="),
        (7, f"seed {base32}="),
        (3, f"Key={base36}"),
        (4, "internationalisationprogrammes and " + "xyxy1212" * 5),
        (5, "DEADBEEF0123456789AB CDEF"),
        (6, "0123456789" * 3),
    ]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs(rows)).collect()}
    assert got == {
        1: "entropy_lower:4:36",
        2: "entropy_base64:0:38",
        3: "entropy_base64:0:36",
        4: "",
        5: "entropy_hex:0:20",
        6: "",
        7: "entropy_upper:5:37",
    }
