"""Line dedup: a document loses the blocks of lines that align with an earlier document.

Lines are compared with surrounding white space cut off, by a 128-bit hash; the r-th time a
line stands in a document it is the entry (line, r), so entries are unique in a document. The
earliest document that has an entry owns it. A document's lines as a whole are one more entry.

Entries choose partners: a document meets the owner of each entry that is in at most ``rare``
documents, or in at most ``SHARE`` of all, whichever is more, or, where all it shares are in more,
of the rarest one. A line's documents grow with the corpus, and so does what counts as rare. Entries that only it has say
nothing. Each pair is then aligned by patience on all lines the two share, frequent ones and
those of third owners included: of their common entries, the longest sequence that rises in
both. Lines under ``min_words`` words choose no partner; next to an aligned line they align as
far as both documents go on alike, blank lines aside. Aligned consecutive lines form blocks, and
blocks are deleted from the later document. A deleted line stays in the earliest document it
aligns down to.

A pair costs the shared lines of the later document, and a document has at most as many partners
as lines.

Defined cases: a null text has no lines; blank lines are never compared and stay, as do short
lines of a document without a longer one; order is by id, then by a hash of the text, nulls
last, so rows that share an id are told apart and identical rows are one document, given as
often as before. A document that loses every line with a word becomes empty and is marked
``emptied``. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import freeze

RARE, SHARE = 64, 0.0005
MIN_WORDS = 4


# An element of a run of short lines: position and hash.
_SHORT = struct.Struct("<i16s")


def _numbered(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Entries, with the runs of short lines before and after each; position -1 is the whole document."""
    space = b" \t\r\x0b\x0c"
    for batch in batches:
        doc, pos, line, before, after = [], [], [], [], []
        for row, text in enumerate(batch["text"]):
            seen: dict[bytes, int] = {}
            whole, run = hashlib.blake2b(digest_size=16, person=b"whole"), b""
            for i, raw in enumerate((text.as_py() or "").encode().split(b"\n")):
                cut = raw.strip(space)
                if not cut:
                    continue
                whole.update(cut + b"\n")
                if len(cut) < 2 * min_words - 1 or len(cut.split(None, min_words - 1)) < min_words:
                    run += _SHORT.pack(i, hashlib.blake2b(cut, digest_size=16).digest())
                    continue
                if seen:
                    after.append(run or None)
                seen[cut] = rank = seen.get(cut, -1) + 1
                doc.append(row)
                pos.append(i)
                line.append(hashlib.blake2b(cut, digest_size=16, salt=rank.to_bytes(8, "little")).digest())
                before.append(run or None)
                run = b""
            if seen:
                after += [run or None, None]
                doc.append(row)
                pos.append(-1)
                line.append(whole.digest())
                before.append(None)
        if doc:
            taken = batch["doc"].take(pa.array(doc))
            columns = [taken, pa.array(pos, pa.int32()), *(pa.array(x, pa.binary()) for x in (line, before, after))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "pos", "line", "before", "after"])


def longest_rise(values: list[int]) -> list[int]:
    """Indices of a longest strictly rising subsequence."""
    tails, at, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
        before[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _alike(mine: bytes | None, theirs: bytes | None, back: bool) -> list[tuple[int, int]]:
    """Positions at which two runs of short lines are alike, from their start or from their end."""
    runs = [list(_SHORT.iter_unpack(x or b"")) for x in (mine, theirs)]
    out = []
    for (p, a), (q, b) in zip(*(reversed(r) if back else r for r in runs), strict=False):
        if a != b:
            break
        out.append((p, q))
    return out[::-1] if back else out


def _with_short(kept: list[dict]) -> list[tuple[int, int]]:
    """Positions of aligned lines and of the short lines beside them; both rise."""
    out: list[tuple[int, int]] = []
    for x in kept:
        last = out[-1] if out else (-1, -1)
        out += [(p, q) for p, q in _alike(x["before"], x["owner_before"], True) if p > last[0] and q > last[1]]
        out.append((x["pos"], x["owner_pos"]))
        out += _alike(x["after"], x["owner_after"], False)
    return out


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair: positions in the later document that align with the partner, and the number of blocks."""
    for batch in batches:
        deleted, blocks = [], []
        for listed in batch["common"]:
            pairs = sorted(listed.as_py(), key=lambda x: x["pos"])
            kept = _with_short([pairs[i] for i in longest_rise([x["owner_pos"] for x in pairs])])
            deleted.append([p for p, _ in kept])
            blocks.append(sum(i == 0 or (p - kept[i - 1][0], q - kept[i - 1][1]) != (1, 1) for i, (p, q) in enumerate(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch["doc"], pa.array(deleted, pa.list_(pa.int32())), pa.array(blocks, pa.int64())], names=["doc", "deleted", "blocks"]
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, shares, emptied = [], [], [], []
        for text, gone in zip(batch["text"], batch["gone"], strict=True):
            kept, gone = text.as_py(), set(gone.as_py() or ())
            share = 0.0
            if gone:
                words = len(kept.encode().split())
                kept = "\n".join(x for i, x in enumerate(kept.split("\n")) if i not in gone)
                if not kept.strip(" \t\n\r\x0b\x0c"):
                    kept = ""
                share = 1 - len(kept.encode().split()) / words
            texts.append(kept)
            counts.append(len(gone))
            shares.append(share)
            emptied.append(bool(gone) and not kept)
        columns = [batch["row"], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), batch["n_blocks"], batch["n_partners"]]
        columns += [pa.array(shares, pa.float64()), pa.array(emptied, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_deleted", "n_blocks", "n_partners", "share", "emptied"])


def _doc(id: str, text: str) -> Column:
    return F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))


def deletions(docs: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, gone, n_blocks, n_partners) of documents that lose lines; ``gone`` holds line positions."""
    rows = docs.select(_doc(id, text).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    found = freeze(rows.mapInArrow(lambda x: _numbered(x, min_words), f"doc {kind}, pos int, line binary, before binary, after binary"), "lines")
    # a line in very many documents combines before the shuffle; the join back splits it
    owners = found.groupBy("line").agg(F.min("doc").alias("partner"), F.count("*").alias("df"))
    owners = freeze(owners.where("df > 1"), "owners")
    # identical rows fall together
    met = freeze(found.join(owners, "line").distinct(), "met")
    pairs = met.where(F.col("partner") != F.col("doc")).groupBy("doc", "partner").agg(F.min("df").alias("least"))
    rarest = F.min("least").over(Window.partitionBy("doc"))
    most = max(rare, int(docs.count() * SHARE))
    pairs = pairs.withColumn("limit", F.greatest(rarest, F.lit(most))).where("least <= limit").select("doc", "partner")
    lines = met.where("pos >= 0")
    theirs = lines.select(
        F.col("doc").alias("partner"), "line", F.col("pos").alias("owner_pos"), F.col("before").alias("owner_before"), F.col("after").alias("owner_after")
    )
    common = pairs.join(lines.drop("partner", "df"), "doc").join(theirs, ["partner", "line"])
    both = F.struct("pos", "owner_pos", "before", "after", "owner_before", "owner_after")
    pairs = common.groupBy("doc", "partner").agg(F.collect_list(both).alias("common")).select("doc", "common")
    aligned = pairs.mapInArrow(_align, f"doc {kind}, deleted array<int>, blocks long")
    return aligned.groupBy("doc").agg(
        F.flatten(F.collect_list("deleted")).alias("gone"), F.sum("blocks").alias("n_blocks"), F.count("*").alias("n_partners")
    )


def dedup_lines(docs: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text", into: str = "line_dedup") -> DataFrame:
    """``docs`` without the deleted lines, and the struct ``into``: n_deleted, n_blocks, n_partners, share, emptied.

    ``share`` is that of its words that a document loses. ``into`` replaces a column of that name.
    """
    columns = [c for c in docs.columns if c.lower() != into.lower()]
    gone = freeze(deletions(docs, rare, min_words, id, text), "gone").select(
        F.col("doc.id").alias("id"), F.col("doc.key").alias("key"), "gone", "n_blocks", "n_partners"
    )
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns) if c != text] or [F.lit(0).alias("c")]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(text).alias("text"), _doc(id, text).alias("doc"))
    # the documents that lose lines grow with the corpus, so they are never broadcast
    gone = gone.hint("merge")
    joined = rows.join(gone, rows["doc.id"].eqNullSafe(gone["id"]) & (rows["doc.key"] == gone["key"]), "left")
    joined = joined.select("row", "text", "gone", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), F.coalesce("n_partners", F.lit(0)).alias("n_partners"))
    kind = joined.schema["row"].dataType.simpleString()
    done = joined.mapInArrow(_cut, f"row {kind}, text string, n_deleted long, n_blocks long, n_partners long, share double, emptied boolean")
    return done.select(
        *[F.col("text").alias(c) if c == text else F.col("row").getField(f"c{i}").alias(c) for i, c in enumerate(columns)],
        F.struct("n_deleted", "n_blocks", "n_partners", "share", "emptied").alias(into),
    )
