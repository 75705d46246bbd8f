"""Cases all operators define: generated words, rows without an id or sharing one, clashing columns."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SMALL  # noqa: E402

from tallyloom.llm import containment, lines, neardup, quality, substring  # noqa: E402
from tallyloom.llm.words import blocks  # noqa: E402


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_generated_words_are_told_apart(docs):
    """Words on which every polynomial modulo 2**64 agrees."""
    one, two = thue_morse(2048), thue_morse(2048, "b", "a")
    found = next(iter(blocks(pa.array([one, two]))))
    assert found.hash[0] != found.hash[1]
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}")]
    assert [r.n_removed for r in substring.remove_repeats(docs(rows)).collect()] == [0, 0]
    pair = [(1, f"{one} x y z"), (2, f"{two} x y z")]
    assert {r.component_id for r in neardup.near_duplicates(docs(pair), k=4).collect()} == {1, 2}


def test_word_hashes_depend_on_every_byte_and_place():
    words = ["ab", "ba", "a", "b", "aa", "aab", "aba", "baa", "é", "ab" * 500, "ba" * 500]
    block = next(iter(blocks(pa.array([" ".join(words), *words]))))
    assert len(set(block.hash[: len(words)].tolist())) == len(words)
    assert np.array_equal(block.hash[: len(words)], block.hash[len(words) :])


def test_rows_without_an_id_are_kept_apart(docs):
    texts = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(40)]
    texts += [t + " more" for t in texts[:5]]
    rows = [(None, t) for t in texts] + [(7, texts[0]), (7, "shared id")]
    got = substring.remove_repeats(docs(rows), width=35).collect()
    left = brute.repeats([t for _, t in rows], 35)
    assert sorted(r.kept_sha256 for r in got) == sorted(brute.sha(" ".join(k)) for k in left)
    near = neardup.near_duplicates(docs(rows), k=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near), key=repr) == sorted(brute.near(rows, 4), key=repr)


def test_texts_of_null_ids_are_read_once(spark, docs):
    """The sets of classes are made from one text each, not from all rows without an id."""
    texts = [" ".join(f"t{i // 2}w{j}" for j in range(30)) + f" end{i}" for i in range(40)]
    rows = docs([(None, t) for t in texts])
    sketched = neardup.sketches(rows, 4, True)
    linked = neardup.links(rows, sketched, 4, True, 80)
    assert linked.count() >= 20


def test_short_items_are_found(spark, docs):
    rows = [(1, "so it was: The  QUICK fox!"), (2, "the quick brown fox"), (None, "quick"), (None, "slow"), (3, "")]
    items = [("a", "the quick fox"), ("b", "quick"), ("c", "fox the"), ("d", "?!"), (None, "Slow")]
    wanted = spark.createDataFrame(items, "item_id string, text string")
    got = containment.find_items(docs(rows), wanted).select("doc_id", "item_id", "n_found", "n_shingles")
    want = brute.contained(rows, items)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and len(want) == 5


def test_decontaminate_goes_by_the_own_text(spark, docs):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("text is not null").first()["text"]
    rows = [(None, f"before {item} after"), (None, "clean without an id"), (5, item), (5, "clean with a shared id"), (6, None), (6, None)]
    got = corpus_pipeline.decontaminate(spark, docs(rows), SMALL)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([rows[1], rows[3], rows[4], rows[5]], key=repr)


CLASHES = ["counts", "verdict", "line_dedup", "_q", "q", "key", "doc", "line", "component", "row", "text_key", "id", "node"]


@pytest.mark.parametrize("clash", CLASHES)
def test_stages_keep_clashing_columns(spark, docs, clash):
    text = "\n".join(" ".join(f"l{i}w{j}" for j in range(9)) for i in range(6))
    rows = [(1, text), (2, text), (3, " ".join(f"x{j}" for j in range(30))), (None, None)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs(rows, clash), SMALL)
        assert kept.columns == ["doc_id", "text", "lang", clash], name
        assert {r[clash] for r in kept.collect()} <= {7}


def test_into_replaces_a_column_of_its_name(docs):
    df = quality.judge(quality.measure(docs([(1, "a b")], "q")), quality.measure(docs([])).selectExpr("lang AS stratum", "map('x', 1.0D) AS cutoffs"))
    assert df.columns == ["doc_id", "text", "lang", "q", "verdict"] and df.first()["q"]["n_words"] == 2
    assert lines.dedup_lines(docs([(1, "a")], "line_dedup")).columns == ["doc_id", "text", "lang", "line_dedup"]


def test_disguises_in_four_languages():
    from tallyloom.llm import pii

    cases = {
        "write to ann dot lee at mail dot example dot org today": "mail",
        "écrivez à ann arobase exemple point fr demain": "ann arobase exemple point fr",
        "schreib an ann [at] beispiel [punkt] de bitte": "ann [at] beispiel [punkt] de",
        "escribe a ann arroba ejemplo punto es ya": "ann arroba ejemplo punto es",
        "call plus four nine three zero one two three four five six": "plus four nine three zero one two three four five six",
        "appelez plus trois trois un deux trois quatre cinq six": "plus trois trois un deux trois quatre cinq six",
        "ruf plus vier neun drei null eins zwei drei fünf an": "plus vier neun drei null eins zwei drei fünf",
        "llama más tres cuatro nueve uno dos tres cuatro cinco": "más tres cuatro nueve uno dos tres cuatro cinco",
    }
    for text, piece in cases.items():
        base, added = pii.spans(text)
        assert not any(base.values()) and len(added) == 1, text
        kind, start, end = added[0]
        assert piece in text[start:end], (text, text[start:end])
    for text in ("un point important", "der Punkt ist gut", "one two three four words", "he is at home", "deux ou trois points"):
        assert pii.spans(text)[1] == []


def test_entropy_of_windows_against_a_plain_count(spark):
    import math
    import random
    from collections import Counter

    from pyspark.sql import functions as F

    from tallyloom.llm import secrets

    rng = random.Random(2)
    texts = ["", "a", "a" * 30, "ab" * 20] + ["".join(rng.choice("abcdef0123XYZ+/") for _ in range(rng.randint(1, 70))) for _ in range(60)]

    def plain(t, w=20):
        windows = [Counter(t[i : i + w]) for i in range(len(t) - w + 1)]
        return max((-sum(c / w * math.log2(c / w) for c in x.values()) for x in windows), default=0.0)

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", secrets.window_entropy(F.col("t")).alias("e")).collect()
    assert all(abs(r.e - plain(r.t)) < 1e-9 for r in got)


def test_hadoop_names_of_an_object_store():
    from tallyloom.llm import warczip

    try:
        fs, name = warczip.open_store("s3a://bucket/some/pack.zip")
    except OSError as error:  # asking for the bucket's region needs a network
        assert "s3a" not in str(error)
    else:
        assert (fs.type_name, name) == ("s3", "bucket/some/pack.zip")


def test_rules_fire_in_every_stratum_and_keep_their_bound(spark):
    """Cutoffs on the given tables; few good documents go, and far fewer bad ones stay than by the base rules."""
    from pyspark.sql import functions as F

    root = SMALL.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    measured = quality.measure(docs).select("doc_id", "lang", "q").cache()
    cutoffs = quality.fit(measured, labels)
    assert {r.stratum for r in cutoffs.collect()} == {"=en", "=fr", "=de", "=es"}
    judged = quality.judge(measured, cutoffs).join(labels, "doc_id").where("not verdict.base_failed")
    rows = judged.groupBy("lang", "quality").agg(F.count("*").alias("n"), F.count_if("verdict.kept").alias("kept")).collect()
    good = {r.lang: r.kept / r.n for r in rows if r.quality == 1}
    assert all(x >= 1 - quality.ALPHA for x in good.values()), good
    bad, kept = sum(r.n for r in rows if r.quality == 0), sum(r.kept for r in rows if r.quality == 0)
    assert kept < 0.6 * bad, (kept, bad)


def test_the_bound_holds_on_fresh_documents(spark):
    """Strata whose good documents vary: over many draws none loses more than allowed, but for the stated risk."""
    import random

    rng = random.Random(12)

    def counts(good):
        n = rng.randint(50, 400)
        symbols = int(n * (rng.expovariate(40) if good else 0.5))
        return {"n_words": n, "word_chars": n * 5 + rng.randint(0, n), "n_symbols": symbols, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 10}

    rows = [(i, f"s{i % 8}", counts(i % 5 > 0), int(i % 5 > 0), i >= 8000) for i in range(24_000)]
    kind = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_lines:long>"
    df = spark.createDataFrame(rows, f"doc_id long, lang string, q {kind}, quality int, fresh boolean").cache()
    cutoffs = quality.fit(df.where("not fresh").drop("quality"), df.where("not fresh").select("doc_id", "quality"))
    assert cutoffs.count() == 8
    judged = quality.judge(df.where("fresh"), cutoffs)
    shares = judged.groupBy("lang", "quality").agg({"doc_id": "count"}).count()
    assert shares == 16
    lost = [r for r in judged.groupBy("lang", "quality").agg((1 - quality_kept()).alias("lost")).collect()]
    assert all(r.lost <= 1.3 * quality.ALPHA for r in lost if r.quality == 1), lost
    assert all(r.lost == 1 for r in lost if r.quality == 0), lost


def quality_kept():
    from pyspark.sql import functions as F

    return F.avg(F.col("verdict.kept").cast("int"))


def test_near_copies_by_lines_leave_no_stubs(spark, docs):
    def text(i, changed=()):
        return "\n".join(f"d{i} line {j} of some words{' changed' if j in changed else ''}" for j in range(10))

    rows = [(1, text(1)), (2, text(1, [3])), (3, text(2)), (4, text(2, range(4)))]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs(rows), SMALL).collect()}
    assert set(got) == {1, 3, 4} and got[4].count("\n") == 3
    shares = {r.doc_id: r.line_dedup.share for r in lines.dedup_lines(docs(rows)).collect()}
    assert shares[1] == 0 and shares[2] > 0.8 and 0.5 < shares[4] < 0.8


def test_an_encoder_is_kept_from_task_to_task():
    from tallyloom.llm import packing
    from tallyloom.llm.queries import TOKENIZER

    assert packing.encoder(TOKENIZER) is packing.encoder(TOKENIZER)
    assert packing.encoder(TOKENIZER)("a b").tolist() == packing.Encoder(TOKENIZER)("a b").tolist()


def test_texts_encoded_in_blocks_have_the_ids_of_whole_texts(monkeypatch):
    import random

    from tallyloom.llm import packing
    from tallyloom.llm.queries import TOKENIZER

    signs = ["a", "word", "'", "'s", "'ll", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "1", ",", ".", "é", "×", "’", "中", "<|endoftext|>", "x" * 9]
    draw = random.Random(5)
    texts = ["".join(draw.choices(signs, k=draw.randrange(14))) for _ in range(20_000)] + [None, "", " ", "a ", " a"]
    encode = packing.Encoder(TOKENIZER)
    for size in (1, 1 << 9, 1 << 24):
        monkeypatch.setattr(packing, "BLOCK", size)
        got = [ids for block in packing.blocks(pa.array(texts)) for ids in encode.block(block)]
        assert [ids.tolist() for ids in got] == [encode(t or "").tolist() for t in texts]


def test_each_distinct_part_of_a_block_is_encoded_once():
    from tallyloom.llm import packing
    from tallyloom.llm.queries import TOKENIZER

    class Counted:
        def __init__(self, inner):
            self.inner, self.seen = inner, 0

        def encode_to_numpy(self, text, **more):
            self.seen += len(text)
            return self.inner.encode_to_numpy(text, **more)

    encode = packing.Encoder(TOKENIZER)
    whole = encode("The quick, brown fox.\n" * 500)
    encode.fast = Counted(encode.fast)
    assert [ids.tolist() for ids in encode.block(pa.array(["The quick, brown fox.\n" * 500] * 20))] == [whole.tolist()] * 20
    assert encode.fast.seen < 100


def test_documents_holding_a_token_are_counted_beyond_a_byte():
    from tallyloom.llm import packing

    counts = packing.DocumentCounts(4)
    for i in range(700):
        counts.add(np.array([1, 1, 2] if i % 2 else [1]))
    assert counts.total().tolist() == [0, 700, 350, 0]


def test_small_batches_of_texts_are_encoded_together():
    from tallyloom.llm import packing

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b", None]})
    assert [b.num_rows for b in packing.joined(iter([batch] * 50))] == [100]
    large = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a" * packing.BLOCK]})
    assert [b.num_rows for b in packing.joined(iter([batch, large, large, batch]))] == [3, 1, 2]
