"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets. An item's sketch holds its smallest
shingle hashes (a MinHash sketch of the small side only: a document of any length either
contains a sketched shingle or not, so long documents do not dilute the estimate as they do a
Jaccard MinHash). A partition with sets of at most ``u`` shingles sketches
``floor((1 - threshold) * u) + 1`` of them, so an item that is contained to the threshold has
at least one sketched shingle in the document: the search loses no hit. Documents smaller than
a partition's least size allows are no candidates for it.

An item of fewer words than a shingle is one shingle, its whole sequence of words; such items
are searched by the hashes of that many consecutive words and verified by the words.

Documents are read once, whatever the number of items: a bitmap of ``FILTER_BITS`` over the
sketched hashes goes to all tasks, and only documents with a shingle in it are kept, with those
shingles. They meet the sketches by a join on the hash, and pairs of a document and an item are
verified by the exact shingles, as words, not hashes. A bitmap too small for the items lets
more documents through, never fewer.

Words are runs of letters and digits, lower-cased, so punctuation and case do not hide a copy.

Defined cases: null texts and texts without words contain nothing and are contained in nothing;
a null item id is an id. Identical rows give identical hits, equal items each give theirs; rows
that share an id are told apart by ``key``, a hash of their text. An empty table on either side
gives no hits. Documents are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import mix, sequence_hash
from tallyloom.session import freeze

SHINGLE, THRESHOLD_PERCENT = 5, 80
FILTER_BITS = 1 << 27  # 16 MB for every task, whatever the number of items
_WORD = re.compile(r"[^\W_]+")
_PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 else (c + 32 if 65 <= c <= 90 else 32) for c in range(128)) + bytes([32] * 128)

Shingle = tuple[str, ...]


def normal_words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    if text.isascii():
        return text.encode().translate(_PLAIN).decode().split()
    return _WORD.findall(text.lower())


def shingles(words: list[str], k: int) -> set[Shingle]:
    return set(zip(*(words[i:] for i in range(k)), strict=False))


class _Vocabulary(dict):
    """Word -> 64-bit hash; holds a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        raw, h = word.encode(), 0xCBF29CE484222325
        for at in range(0, len(raw), 8):
            h = ((h ^ int.from_bytes(raw[at : at + 8], "little")) * 0x9E3779B97F4A7C15 + len(raw)) & 0xFFFFFFFFFFFFFFFF
            h ^= h >> 29
        self[word] = h
        return h


def _hashes(words: list[str], vocabulary: _Vocabulary, k: int) -> np.ndarray:
    if len(words) < k:
        return np.empty(0, np.uint64)
    values = mix(np.fromiter(map(vocabulary.__getitem__, words), np.uint64, len(words)))
    return sequence_hash(values, np.arange(len(words) - k + 1), k)


def _sketcher(k: int, percent: int):
    """Per item: its shingle length, the least number of shingles of a document, its sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary()
        for batch in batches:
            rows, lengths, leasts, sketches = [], [], [], []
            for i, text in enumerate(batch["text"]):
                words = normal_words(text.as_py())
                length = min(k, len(words))
                if not length:
                    continue
                # partition: sizes from u / 2 + 1 to u, u a power of two
                u = 1 << (len(shingles(words, length)) - 1).bit_length()
                rows.append(i)
                lengths.append(length)
                leasts.append(-(-percent * (u // 2 + 1) // 100))
                sketches.append(np.unique(_hashes(words, vocabulary, length))[: (100 - percent) * u // 100 + 1].view(np.int64))
            columns = [batch["item"].take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int32()), pa.array(leasts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sketches, pa.list_(pa.int64()))], names=["item", "length", "least", "sketch"])

    return sketch


def _bitmap(sketched: DataFrame, bits: int) -> np.ndarray:
    """The bits of all sketched hashes; built in pieces of 32,768 bits, of which there are a bounded number."""
    place = F.pmod("h", F.lit(bits)) + 1
    pieces = sketched.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in pieces.collect():  # at most bits / 32,768 rows
        at = (row["piece"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


_HITS = pa.list_(pa.struct([("length", pa.int32()), ("h", pa.int64()), ("n", pa.int32())]))


def _searcher(bitmap, bits: int, lengths: list[int]):
    """Documents with a shingle in the bitmap, and those shingles."""
    mask = np.uint64(bits - 1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vocabulary = bitmap.value, _Vocabulary()
        for batch in batches:
            rows, hits = [], []
            for i, text in enumerate(batch["text"]):
                words, found = normal_words(text.as_py() or ""), []
                for length in lengths:
                    own = _hashes(words, vocabulary, length)
                    place = own & mask
                    inside = (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                    found += [{"length": length, "h": h, "n": len(own)} for h in np.unique(own[inside > 0]).view(np.int64).tolist()]
                if found:
                    rows.append(i)
                    hits.append(found)
            if rows:
                taken = [batch[c].take(pa.array(rows)) for c in ("doc_id", "key", "text")]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(hits, _HITS)], names=["doc_id", "key", "text", "hits"])

    return search


def _verifier(k: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words, sets = None, [], {}
        for batch in batches:
            rows, found, total = [], [], []
            for i, (doc, text, item) in enumerate(zip(batch["doc"], batch["text"], batch["item_text"], strict=True)):
                if doc.as_py() != last:  # pairs of a document mostly come together
                    last, words, sets = doc.as_py(), normal_words(text.as_py()), {}
                asked = normal_words(item.as_py())
                length = min(k, len(asked))
                if length not in sets:
                    sets[length] = shingles(words, length)
                wanted = shingles(asked, length)
                both = len(wanted & sets[length])
                if 100 * both >= percent * len(wanted):
                    rows.append(i)
                    found.append(both)
                    total.append(len(wanted))
            taken = [batch[c].take(pa.array(rows, pa.int64())) for c in ("doc_id", "key", "item_id")]
            columns = [*taken, pa.array(found, pa.int64()), pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "item_id", "n_found", "n_shingles"])

    return verify


def find_items(
    docs: DataFrame,
    items: DataFrame,
    k: int = SHINGLE,
    percent: int = THRESHOLD_PERCENT,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, key, item_id, n_found, n_shingles): items contained in documents to ``percent``.

    ``filter_bits`` is a power of two.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    # numbers that are fixed by being written tell apart rows that agree in everything
    wanted = freeze(wanted.withColumn("item", F.monotonically_increasing_id()), "items")
    sketched = wanted.select("item", "text").mapInArrow(_sketcher(k, percent), "item long, length int, least int, sketch array<long>")
    sketched = freeze(sketched.select("item", "length", "least", F.explode("sketch").alias("h")), "sketches")
    lengths = sorted(r["length"] for r in sketched.select("length").distinct().collect())  # at most k
    bitmap = spark.sparkContext.broadcast(_bitmap(sketched, filter_bits))

    kind, item_kind = (df.schema[0].dataType.simpleString() for df in (rows, wanted))
    hits = rows.mapInArrow(_searcher(bitmap, filter_bits, lengths), f"doc_id {kind}, key long, text string, hits array<struct<length:int,h:long,n:int>>")
    hits = freeze(hits.withColumn("doc", F.monotonically_increasing_id()), "hits")
    pairs = hits.select("doc", F.inline("hits")).join(sketched, ["length", "h"]).where("n >= least").select("doc", "item").distinct()
    asked = wanted.select("item", "item_id", F.col("text").alias("item_text"))
    both = pairs.join(asked, "item").join(hits.select("doc", "doc_id", "key", "text"), "doc")
    both = both.select("doc", "doc_id", "key", "text", "item_id", "item_text")
    return both.mapInArrow(_verifier(k, percent), f"doc_id {kind}, key long, item_id {item_kind}, n_found long, n_shingles long")
