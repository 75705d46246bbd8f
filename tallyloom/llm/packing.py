"""Packing of tokenised documents into windows, neighbours chosen by a sharded BM25 index.

A document is its token ids and the end id. What fills whole windows is cut off as sequences
of its own; the rest of each document (under one window) goes to a shard. A shard holds an
inverted index of its rests (token -> documents, BM25 weights with document frequencies over
the whole documents of the corpus). The next unused rest is the seed of a window; the index
returns its unused neighbours by score, which fill the window in that order; the one that no
longer fits is cut, and what is left of it seeds the next window. So only the last window of a
shard is short.

Shards hold about ``SHARD`` rests and are made by content, so that a seed finds its neighbours
in its own shard whatever the size of the corpus. BM25 weights, folded into ``FOLDED`` signed
sums, are the coordinates of a rest; a bounded sample is halved at medians into leaves of equal
size; a rest belongs to the cell of its nearest and second nearest leaf mean. Cells are laid
out in the order of the leaves, a rest takes a random place within its cell, and every
``SHARD`` places are a shard: like rests are neighbours there, and a cell of very many, or of
equal, rests is many shards. Document frequencies are one number per token of the vocabulary,
cells at most ``LEAVES`` squared.

Ids are those of the ``tokenizers`` file. Its vocabulary and merges are handed to ``tiktoken``,
which applies the same byte-level merges faster; a text with a special token's string, or with
characters outside the Latin blocks and general punctuation, about which the libraries' tables
could differ, is encoded by ``tokenizers`` itself, as are all texts of a file of another kind.
Texts for ``tiktoken`` are cut, in blocks, where its pattern always starts a piece whatever lies
around, and each distinct part of a block is encoded once.

Defined cases: a null text is empty and has the end id only. Rows are documents of their own,
also with equal ids. An empty table gives no rows. Texts are tokenised whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.llm.ann import balanced_means, squares
from tallyloom.llm.vectors import gathered, sampled
from tallyloom.llm.words import mix
from tallyloom.session import freeze

WINDOW, END_ID = 2048, 1
SHARD = 512
K1, B = 1.2, 0.75
FOLDED = 128
LEAVES, SAMPLE = 256, 8192
BLOCK = 1 << 23  # bytes of text encoded at a time; a longer text is a block of its own

_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]")
# Fixed value: how byte-level tokenizers of this kind cut a text before they merge.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Kinds of bytes that decide where a text may be cut; all others, parts of wider characters among them, decide nothing.
_SPACE, _LINE, _WORD, _MARK, _WIDE = 1, 2, 4, 8, 16
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _WORD
_KIND[[0x20, 0x0A]] = _SPACE, _LINE
_SOLID = _WORD | _MARK | _WIDE
_KIND[0xC3:0xCA] = _WIDE  # first bytes of U+00C0 to U+024F, none of them white space


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself, if it can be printed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Merge ranks of a byte-level file, or None if it is of another kind."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
    if not plain or cut.get("add_prefix_space") or spec.get("normalizer") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    letters = _byte_letters()
    vocabulary = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merges]
    # ranks can be ids only if ids follow the order of the merges
    return vocabulary if order == sorted(order) else None


class Encoder:
    """Texts to ids."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        ranks = _ranks(path)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("byte_level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.bytes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
            self.bytes[list(ranks.values())] = [*map(len, ranks)]

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _unusual(self, text: str) -> bool:
        return self.fast is None or bool(not text.isascii() and _UNUSUAL.search(text)) or any(s in text for s in self.special)

    def __call__(self, text: str) -> np.ndarray:
        return self._encode(text) if self._unusual(text) else self.fast.encode_to_numpy(text, disallowed_special=())

    def block(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each of some texts, none of them null."""
        out = [self._encode(t) if self._unusual(t) else None for t in texts.to_pylist()]
        plain = [i for i, ids in enumerate(out) if ids is None]
        if plain:
            ids, bounds = self._joined(texts.take(pa.array(plain)).cast(pa.large_binary()))
            for i, first, last in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                out[i] = ids[first:last]
        return out

    def _joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin and end."""
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1] if data else np.zeros(len(texts) + 1, np.int64)
        if not ends[-1]:
            return np.empty(0, np.uint32), ends
        at = cuts(np.frombuffer(data, np.uint8)[: ends[-1]], ends)
        parts = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, ends[-1])), data])
        parts = parts.dictionary_encode()
        distinct = self._distinct(parts.dictionary).take(parts.indices)
        first = np.append(np.searchsorted(at, ends[:-1]), len(at))
        return distinct.values.to_numpy(), distinct.offsets.to_numpy()[first]

    def _distinct(self, parts: pa.Array) -> pa.Array:
        """Lists of the ids of parts. Those that begin a piece after any other are encoded as one text.

        Ids stand for bytes one after the other, so bytes tell where a part's ids end.
        """
        _, offsets, data = parts.buffers()
        data, begin = np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)[: len(parts)]
        after = data[np.minimum(begin + 1, len(data) - 1)]
        spaced = (data[begin] == 0x20) & (_KIND[after] & _SOLID > 0) & (pc.binary_length(parts).to_numpy() > 1)
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])
        parts, joined = parts.take(pa.array(order)), int(spaced.sum())
        size = np.cumsum(pc.binary_length(parts[:joined]).to_numpy())
        text = parts.buffers()[2].to_pybytes()[: size[-1]].decode() if joined else ""
        ids = self.fast.encode_to_numpy(text, disallowed_special=())
        last = np.searchsorted(np.cumsum(self.bytes[ids]), size) + 1
        single = [self.fast.encode_to_numpy(p.decode(), disallowed_special=()) for p in parts[joined:].to_pylist()]
        bounds = np.concatenate([[0], last, len(ids) + np.cumsum(np.fromiter(map(len, single), np.int64, len(single)))]).astype(np.int64)
        lists = pa.LargeListArray.from_arrays(bounds, np.concatenate([ids, *single]).astype(np.uint32, copy=False))
        return lists.take(pa.array(np.argsort(order)))


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where parts of texts begin; ``data`` are the bytes of all texts, ``ends`` 0 and the end of each.

    What ``_PATTERN`` finds in a text is what it finds in its parts: a space before something else
    than white space begins a piece, whatever precedes it; no piece goes on from a letter or digit
    to a mark, or from either to white space; and a line end alone between two of them is a piece.
    """
    kind = _KIND[data]
    solid = (kind & _SOLID) > 0
    line = kind == _LINE
    cut = np.zeros(len(data), bool)
    cut[:-1] = (kind[:-1] == _SPACE) & solid[1:]
    cut[ends[1:] - 1] = False  # what follows there is another text
    line[1:] &= solid[:-1]
    line[:1] = False
    cut |= line
    cut[1:] |= ((kind[1:] == _MARK) & (kind[:-1] == _WORD)) | (solid[1:] & line[:-1])
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches as ones of about ``BLOCK`` bytes, since parts repeat the more the longer a block is."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes + 256 * batch.num_rows  # what is kept of a row besides its text
        if size >= BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in blocks of about ``BLOCK`` bytes, null ones empty."""
    size = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy()
    first = 0
    while first < len(texts):
        before = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, before + BLOCK, "right")))
        yield pc.fill_null(texts.slice(first, last - first), "")
        first = last


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a file, kept from task to task of a worker."""
    return Encoder(path)


PIECES = [("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary()), ("df", pa.binary())]


class DocumentCounts:
    """How many documents hold each token; narrow counts are emptied into wide ones before they overflow."""

    def __init__(self, size: int) -> None:
        self.seen, self.few, self.many = np.zeros(size, np.uint8), np.zeros(size, np.uint8), np.zeros(size, np.int64)
        self.added = 0

    def add(self, ids: np.ndarray) -> None:
        if self.added == 255:
            self.total()
        self.seen[ids] = 1
        self.few += self.seen
        self.seen[ids] = 0
        self.added += 1

    def total(self) -> np.ndarray:
        self.many += self.few
        self.few[:] = 0
        self.added = 0
        return self.many


def _tokeniser(path: str, kind: pa.DataType, window: int, end_id: int) -> Callable:
    names = ["doc_id", *(n for n, _ in PIECES)]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        size = max(encode.size, end_id + 1)
        counts = DocumentCounts(size)
        for batch in joined(batches):
            rows = []
            for i, ids in enumerate(chain.from_iterable(map(encode.block, blocks(batch["text"])))):
                values = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                raw = values.tobytes()
                counts.add(values)
                n = len(values)
                for start in range(0, n - window + 1, window):
                    rows.append((i, start, window, zlib.crc32(raw[4 * start : 4 * (start + window)]), n, None, None))
                start = n - n % window
                if start < n:
                    rest = values[start:].astype("<u2" if size <= 1 << 16 else "<u4").tobytes()
                    rows.append((i, start, n - start, zlib.crc32(raw[4 * start :]), n, rest, None))
            if rows:
                at, *columns = zip(*rows, strict=True)
                arrays = [batch["doc_id"].take(pa.array(at)), *(pa.array(c, k) for c, (_, k) in zip(columns, PIECES, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        total = counts.total()
        if total.any():
            # one row per task: how many of its documents hold each token
            values = [0, 0, 0, 0, None, total.tobytes()]
            arrays = [pa.nulls(1, kind), *(pa.array([v], k) for v, (_, k) in zip(values, PIECES, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return tokenise


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch["df"]:
            counts = np.frombuffer(raw.as_py(), np.int64)
            token = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(counts[token])], names=["token", "df"])


def weigh(ids: np.ndarray, idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a document that say something, and their BM25 weights."""
    t, tf = np.unique(ids, return_counts=True)
    keep = idf[t] > 0
    t, tf = t[keep], tf[keep]
    return t, idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))


def fold(docs: list[np.ndarray], idf: np.ndarray, mean: float) -> np.ndarray:
    """Unit vectors: each token's weight added to, or taken from, one of ``FOLDED`` sums."""
    spread = mix(np.arange(len(idf), dtype=np.uint64) + np.uint64(1))
    place, sign = (spread % np.uint64(FOLDED)).astype(np.int64), np.where(spread >> np.uint64(63), 1.0, -1.0)
    out = np.empty((len(docs), FOLDED))
    for i, ids in enumerate(docs):
        t, w = weigh(ids, idf, mean)
        out[i] = np.bincount(place[t], w * sign[t], FOLDED)
    size = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, size, out=out, where=size > 0)


def _rests(column: pa.Array, vocabulary: int) -> list[np.ndarray]:
    wide = "<u2" if vocabulary <= 1 << 16 else "<u4"
    return [np.frombuffer(x.as_buffer(), wide) for x in column]


def _placer(idf, mean: float, means: np.ndarray):
    """The rows with the nearest and second nearest leaf of each rest."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, 512):
            d = squares(fold(_rests(part["ids"].combine_chunks(), len(idf.value)), idf.value, mean), means)
            first = d.argmin(1)
            if d.shape[1] > 1:
                d[np.arange(len(d)), first] = np.inf
            leaves = {"leaf": pa.array(first, pa.int32()), "second": pa.array(d.argmin(1), pa.int32())}
            part = part.combine_chunks()
            for name, values in leaves.items():
                part = part.append_column(name, values)
            yield from part.to_batches()

    return place


class Index:
    """BM25 postings of some documents (arrays of token ids)."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        self.n = len(docs)
        terms, owners, weights = [], [], []
        for i, ids in enumerate(docs):
            t, w = weigh(ids, idf, mean)
            terms.append(t)
            owners.append(np.full(len(t), i))
            weights.append(w)
        self.terms = terms
        flat = np.concatenate(terms) if terms else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.vocabulary, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], len(flat))
        self.owners = np.concatenate(owners)[order] if terms else flat
        self.weights = np.concatenate(weights)[order] if terms else flat

    def scores(self, doc: int) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, self.terms[doc])
        first, count = self.first[at], self.last[at] - self.first[at]
        place = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.bincount(self.owners[place], self.weights[place], self.n)


def fill_windows(lengths: list[int], index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); every document is used up exactly once."""
    unused = np.ones(len(lengths), bool)
    carry: tuple[int, int] | None = None  # a cut document and where it goes on
    following = 0
    while True:
        if carry is None:
            while following < len(lengths) and not unused[following]:
                following += 1
            if following == len(lengths):
                return
            unused[following] = False
            carry = following, 0
        seed, start = carry
        filled, carry = [(seed, start, lengths[seed] - start)], None
        room = window - filled[0][2]
        if room and unused.any():
            left = np.flatnonzero(unused)
            for doc in left[np.argsort(-index.scores(seed)[left], kind="stable")].tolist():
                unused[doc] = False
                take = min(room, lengths[doc])
                filled.append((doc, 0, take))
                room -= take
                if take < lengths[doc]:
                    carry = doc, take
                if not room:
                    break
        yield filled


def _packer(kind: pa.DataType, idf, mean: float, window: int) -> Callable:
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        base = int(key[0].as_py()) << 32
        # an order of its own for every group, whatever the order of arrival
        table = table.sort_by([("salt", "ascending")])
        rows = table.drop_columns(["doc_id"]).to_pylist()
        out, number = [], 0
        for i, r in enumerate(rows):
            if r["ids"] is None:
                out.append((i, r["start"], r["length"], r["crc"], r["tokens"], base + number, 0))
                number += 1
        rests = [i for i, r in enumerate(rows) if r["ids"] is not None]
        wide = "<u2" if len(idf.value) <= 1 << 16 else "<u4"
        ids = [np.frombuffer(rows[i]["ids"], wide) for i in rests]
        for filled in fill_windows([len(x) for x in ids], Index(ids, idf.value, mean), window):
            offset = 0
            for doc, start, length in filled:
                r, part = rows[rests[doc]], ids[doc][start : start + length]
                out.append((rests[doc], r["start"] + start, length, zlib.crc32(part.astype("<u4").tobytes()), r["tokens"], base + number, offset))
                offset += length
            number += 1
        at, *columns = zip(*out, strict=True)
        taken = table["doc_id"].take(pa.array(at))
        return pa.Table.from_arrays([taken, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *names])

    return pack


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, shard: int = SHARD, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    name, kind = rows.schema["doc_id"].dataType.simpleString(), to_arrow_type(rows.schema["doc_id"].dataType)
    columns = f"doc_id {name}, start long, length long, crc long, tokens long, ids binary, df binary"
    pieces = rows.mapInArrow(_tokeniser(tokenizer, kind, window, end_id), columns)
    # a number of its own for each row, fixed by being written
    pieces = freeze(pieces.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "tokens")
    held = pieces.where("df is not null").select("df").mapInArrow(_token_counts, "token long, df long")
    counted = held.groupBy("token").agg(F.sum("df").alias("df")).collect()  # at most the vocabulary
    sizes = pieces.where("df is null").agg(
        F.count("ids").alias("rests"), F.avg(F.when(F.col("ids").isNotNull(), F.col("length"))).alias("mean"), F.count_if(F.col("start") == 0).alias("docs"), F.count("*").alias("all")
    ).first()
    df = np.zeros(max((r["token"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        df[r["token"]] = r["df"]
    idf = np.maximum(0.0, np.log((sizes["docs"] - df + 0.5) / (df + 0.5))) if sizes["docs"] else df.astype(float)
    weights, mean = _padded(idf, tokenizer, end_id), float(sizes["mean"] or 1)
    idf = spark.sparkContext.broadcast(weights)
    dealt = _dealt(pieces.where("df is null").drop("df"), idf, mean, sizes, shard)
    result = f"doc_id {name}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(_packer(kind, idf, mean, window), result)


def _dealt(pieces: DataFrame, idf, mean: float, sizes, shard: int) -> DataFrame:
    """Pieces with their shard: rests by content, whole windows evenly."""
    spark = pieces.sparkSession
    shards = max(1, -(-max(sizes["rests"], sizes["all"] // 4) // shard))
    evenly = F.pmod("salt", F.lit(shards))
    if shards == 1 or not sizes["rests"]:
        return pieces.withColumn("shard", evenly)
    rests = pieces.where("ids is not null")
    sample = sampled(rests.select("ids", F.xxhash64("salt").alias("order")), sizes["rests"], SAMPLE).select("ids").toArrow()["ids"].combine_chunks()
    folded = np.unique(fold(_rests(sample, len(idf.value)), idf.value, mean), axis=0)
    means = balanced_means(folded, max(1, min(LEAVES, len(folded) // 8, shards * 4)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rests.schema)
    placed = freeze(rests.mapInArrow(_placer(idf, mean, means), f"{schema}, leaf int, second int"), "placed")
    cells = sorted(map(tuple, placed.groupBy("leaf", "second").count().collect()))  # LEAVES squared at most
    count = np.array([n for *_, n in cells], np.int64)
    base = np.cumsum(count) - count
    listed = [(*c[:2], int(b), int(n)) for c, b, n in zip(cells, base, count, strict=True)]
    cells = spark.createDataFrame(listed, "leaf int, second int, base long, count long")
    # a place between 0 and 1 from 52 bits of the salt
    share = F.shiftrightunsigned("salt", 12) / F.lit(float(1 << 52))
    place = F.col("base") + F.floor(share * F.col("count"))
    near = placed.join(F.broadcast(cells), ["leaf", "second"]).withColumn("shard", F.floor(place * shards / int(count.sum())))
    return near.drop("leaf", "second", "base", "count").unionByName(pieces.where("ids is null").withColumn("shard", evenly))


def _padded(idf: np.ndarray, tokenizer: str, end_id: int) -> np.ndarray:
    """One weight per token of the vocabulary."""
    size = max(Encoder(tokenizer).size, end_id + 1)
    return np.concatenate([idf, np.zeros(max(0, size - len(idf)))])
