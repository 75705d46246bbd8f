"""Repeated word spans by compacting a De Bruijn graph of the corpus.

Edges are the ``width``-word windows of all texts, nodes the runs of ``width - 1`` words; an edge
leads from its first to its last ``width - 1`` words. A repeated window is an edge that occurs
twice.

- Within a text, the consecutive windows with one minimiser (the smallest hash of the
  ``probe``-word runs inside a window) are compacted into one row, a piece of path. Equal windows
  have equal minimisers at equal places, so pieces meet by a join on the minimiser. Where all
  pieces of a minimiser are equal, they are repeated, or are not, as one. Where they differ, each
  distinct piece is opened into its edges at its source coordinates and edges are counted.
- Repeated pieces are the labels of a graph over their nodes. At a node with one piece in and one
  out the path does not branch: the two are linked. Linked pieces are ranked by pointer doubling,
  a join a round, which gives each its path and its place on it. Edges of opened pieces stand
  where the graph branches and are on no path.
- Paths go back to source coordinates: the pieces that a text has of one path at one distance
  make a long span, and so do consecutive edges of an opened piece.

A piece is told apart by its minimiser and by a digest of its words, read at its source
coordinates; so is an edge. So a span is repeated if its words are, not if sums of hashes agree.

Defined cases: a null text has no words; texts shorter than ``width`` have no windows. Rows are
documents of their own: a row repeated whole repeats all its windows. Rows that share an id,
or have none, are told apart by a hash of their text. Labels on a cycle, as in a text that
repeats a few words, stay paths of their own. An empty table gives no rows. Texts are read
whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import Block, blocks, sequence_hash
from tallyloom.session import freeze

WIDTH, PROBE = 35, 8
_PROBE_BASE, _NODE_BASE = 0x9FB21C651E98DF25, 0xA0761D6478BD642F


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` neighbours, the first of equal ones."""
    best, at, span = values, np.arange(len(values)), 1
    while span < width:
        shift = min(span, width - span)
        later = best[shift:] < best[:-shift]
        at = np.where(later, at[shift:], at[:-shift])
        best = np.where(later, best[shift:], best[:-shift])
        span += shift
    return at


class Source:
    """The words of a block joined by single spaces: digests of runs of words at their coordinates."""

    def __init__(self, block: Block) -> None:
        length = block.end - block.start
        self.first = np.concatenate([[0], np.cumsum(length + 1)])
        self.data = np.full(self.first[-1], 0x20, np.uint8)
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        self.data[place + np.repeat(self.first[:-1], length)] = block.data[place + np.repeat(block.start, length)]
        self.data = self.data.tobytes()

    def digests(self, start: np.ndarray, words: np.ndarray) -> np.ndarray:
        lows, highs = self.first[start].tolist(), self.first[start + words].tolist()
        data, digest = self.data, hashlib.blake2b
        return np.frombuffer(b"".join(digest(data[x:y], digest_size=8).digest() for x, y in zip(lows, highs, strict=True)), np.int64)


def _nodes(block: Block, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the nodes that begin at some words: they say where paths may be joined, not what is repeated, so 32 bits do."""
    return (sequence_hash(block.hash, at, width - 1, _NODE_BASE) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _pieces(block: Block, width: int, probe: int):
    """(text, first window, windows, minimiser hash, digest, first node, last node) of every piece."""
    n = len(block.hash)
    if n < width:
        return None
    hashes = sequence_hash(block.hash, np.arange(n - probe + 1), probe, _PROBE_BASE)
    least = _sliding_argmin(hashes, width - probe + 1)
    left = np.repeat(block.first[1:], np.diff(block.first))[: n - width + 1] - np.arange(n - width + 1)
    windows = np.flatnonzero(left >= width)
    if not len(windows):
        return None
    at = least[windows]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1))))
    count = np.diff(np.append(first, len(windows)))
    start, at = windows[first], at[first]
    doc = np.searchsorted(block.first, start, "right") - 1
    # the minimiser's place in the piece is part of what it is
    digest = Source(block).digests(start, count + width - 1) ^ ((at - start).astype(np.uint64) * np.uint64(_PROBE_BASE)).view(np.int64)
    return doc, start - block.first[doc], count, hashes[at].view(np.int64), digest, _nodes(block, start, width), _nodes(block, start + count, width)


def _piece_rows(width: int, probe: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                found = _pieces(block, width, probe)
                if found is None:
                    continue
                doc, start, count, *hashes = found
                source = pa.array(doc + block.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(source),
                        batch["key"].take(source),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        *map(pa.array, hashes),
                    ],
                    names=["doc_id", "key", "start", "n", "m", "p", "head", "tail"],
                )

    return rows


def _edge_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                m, p, offset, at, copies = [], [], [], [], []
                for t in range(block.texts):
                    for x in batch["pieces"][block.row + t].as_py():
                        m.append(np.full(x["n"], x["m"]))
                        p.append(np.full(x["n"], x["p"]))
                        copies.append(np.full(x["n"], x["copies"]))
                        offset.append(np.arange(x["n"]))
                        at.append(block.first[t] + x["start"] + offset[-1])
                if m:
                    at = np.concatenate(at)
                    edges = Source(block).digests(at, np.full(len(at), width))
                    columns = [np.concatenate(m), np.concatenate(p), np.concatenate(offset).astype(np.int32), np.concatenate(copies), edges]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["m", "p", "offset", "copies", "edge"])

    return rows


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))


def _same(rows: DataFrame, listed: DataFrame) -> Column:
    return rows["doc_id"].eqNullSafe(listed["id"]) & (rows["key"] == listed["text_key"])


def repeated_labels(
    docs: DataFrame, width: int = WIDTH, probe: int = PROBE, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Where repeated pieces stand (doc_id, key, start, n, m, p, head, tail), and where runs of repeated edges of
    opened pieces stand (doc_id, key, start, n)."""
    rows = _keyed(docs, id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = rows.mapInArrow(_piece_rows(width, probe), f"doc_id {kind}, key long, start int, n int, m long, p long, head int, tail int")
    pieces = freeze(pieces, "pieces")
    # copies of a minimiser combine before the shuffle; the join back is split where it is hot
    met = pieces.groupBy("m").agg(F.count("*").alias("copies"), (F.min("p") == F.max("p")).alias("equal")).where("copies > 1")
    # written before the join, or the join could not split a minimiser that very many texts share
    met = freeze(pieces.join(freeze(met.select("m", "equal"), "minimisers"), "m"), "met")
    equal = met.where("equal").select("doc_id", "key", "start", "n", "m", "p", "head", "tail")

    branching = met.where("not equal")
    distinct = branching.groupBy("m", "p").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "key", "start", "n")).alias("source")
    )
    # at most the pieces of one text per group
    sources = distinct.groupBy(F.col("source.doc_id").alias("id"), F.col("source.key").alias("text_key")).agg(
        F.collect_list(F.struct("source.start", "source.n", "m", "p", "copies")).alias("pieces")
    )
    opened = rows.join(sources, _same(rows, sources)).select("text", "pieces")
    edges = opened.mapInArrow(_edge_rows(width), "m long, p long, offset int, copies long, edge long")
    # two rows of one id and text open the same pieces twice
    edges = freeze(edges.dropDuplicates(["m", "p", "offset"]), "edges")
    again = edges.groupBy("m", "edge").agg(F.sum("copies").alias("copies")).where("copies > 1").select("m", "edge")
    # the edges of one piece, as runs of consecutive ones
    runs = edges.join(again, ["m", "edge"]).groupBy("m", "p").agg(F.sort_array(F.collect_list("offset")).alias("at"))
    first = F.filter("at", lambda x, i: F.coalesce(x - F.get("at", i - 1) > 1, F.lit(True)))
    last = F.filter("at", lambda x, i: F.coalesce(F.get("at", i + 1) - x > 1, F.lit(True)))
    runs = runs.select("m", "p", F.inline(F.arrays_zip(first.alias("offset"), last.alias("last"))))
    single = branching.select("doc_id", "key", "start", "m", "p").join(freeze(runs, "runs"), ["m", "p"])
    single = single.select("doc_id", "key", (F.col("start") + F.col("offset")).alias("start"), (F.col("last") - F.col("offset") + 1).alias("n"))
    return equal, single


def paths(pieces: DataFrame) -> DataFrame:
    """(m, p, path, place): pieces on paths that do not branch; ``place`` counts windows from the path's start.

    A path is named by the number of its first piece. Pieces that are linked to no other are left out.
    """
    distinct = pieces.groupBy("m", "p").agg(F.first("head").alias("head"), F.first("tail").alias("tail"), F.first("n").alias("n"))
    distinct = freeze(distinct.withColumn("label", F.monotonically_increasing_id()), "distinct")
    ends = distinct.groupBy(F.col("tail").alias("node")).agg(F.count("*").alias("into"), F.min("label").alias("before"), F.min("n").alias("n"))
    starts = distinct.groupBy(F.col("head").alias("node")).agg(F.count("*").alias("out"), F.min("label").alias("label"))
    links = ends.where("into = 1").join(starts.where("out = 1"), "node").where("before != label").select("label", "before", F.col("n").cast("long").alias("place"))
    links = freeze(links, "links")
    # labels that a link leads from and none leads to
    firsts = links.select(F.col("before").alias("label")).join(links.select("label"), "label", "left_anti")
    ranked = freeze(firsts.select("label", F.col("label").alias("path"), F.lit(0).cast("long").alias("place")), "paths")
    open_ = links
    while True:
        # what points to a ranked label is ranked; the rest points on to where that label points
        done = open_.join(ranked.select(F.col("label").alias("before"), "path", F.col("place").alias("so_far")), "before")
        done = freeze(done.select("label", "path", (F.col("place") + F.col("so_far")).alias("place")), "paths")
        if done.isEmpty():
            # each path has a label next to its ranked ones: what is left runs in cycles
            break
        ranked = ranked.union(done)
        rest = open_.join(done.select("label"), "label", "left_anti")
        ahead = open_.select(F.col("label").alias("before"), F.col("before").alias("far"), F.col("place").alias("more"))
        rest = rest.join(ahead, "before").select("label", F.col("far").alias("before"), (F.col("place") + F.col("more")).alias("place"))
        open_ = freeze(rest, "links")
    return ranked.join(distinct.select("label", "m", "p"), "label").select("m", "p", "path", "place")


def repeated_spans(docs: DataFrame, width: int = WIDTH, probe: int = PROBE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, spans): per text with repeated windows, runs of ``n`` of them from the word ``start`` on.

    Identical rows have the same spans, which are given once. Spans may touch or overlap.
    """
    pieces, runs = repeated_labels(docs, width, probe, id, text)
    ranked = freeze(paths(pieces), "ranked")
    placed = pieces.select("doc_id", "key", "start", "n", "m", "p").join(ranked, ["m", "p"], "left").drop("m", "p")
    none = F.lit(None).cast("long")
    placed = placed.union(runs.select("doc_id", "key", "start", "n", none, none))
    # pieces of a path at one distance; what is on no path is alone at its place
    shift = F.when(F.col("path").isNull(), F.col("start")).otherwise(F.col("start") - F.col("place"))
    # at most the windows of one text
    parts = placed.groupBy("doc_id", "key", "path", shift.alias("shift")).agg(F.collect_set(F.struct("start", "n")).alias("parts"))
    first, last = F.array_min(F.transform("parts", lambda x: x["start"])), F.array_max(F.transform("parts", lambda x: x["start"] + x["n"]))
    total = F.aggregate("parts", F.lit(0), lambda a, x: a + x["n"])
    long = F.array(F.struct(first.alias("start"), (last - first).alias("n")))
    # a text may have a path with gaps, or two runs at one place
    spans = F.when(total == last - first, long).otherwise(F.col("parts"))
    return parts.select("doc_id", "key", spans.alias("spans")).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _remover(width: int, texts_too: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                texts = batch["text"].slice(block.row, block.texts)
                total, gone, kept, digests = [], [], [], []
                for t, text in enumerate(texts):
                    words = (text.as_py() or "").encode().split()
                    spans = batch["spans"][block.row + t].as_py()
                    if spans:
                        edge = np.zeros(len(words) + 1, np.int64)
                        start = np.array([x["start"] for x in spans])
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + np.array([x["n"] for x in spans]) + width - 1, -1)
                        covered = np.cumsum(edge[:-1]) > 0
                        left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                    else:
                        left = words
                    joined = b" ".join(left)
                    total.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(joined.decode() if texts_too else None)
                    digests.append(hashlib.sha256(joined).hexdigest())
                columns = [batch["doc_id"].slice(block.row, block.texts), pa.array(total), pa.array(gone), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return remove


def remove_repeats(docs: DataFrame, width: int = WIDTH, probe: int = PROBE, id: str = "doc_id", text: str = "text", texts_too: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and (if wanted) the kept words joined by a space."""
    listed = repeated_spans(docs, width, probe, id, text).select(F.col("doc_id").alias("id"), F.col("key").alias("text_key"), "spans")
    listed = freeze(listed, "spans")
    rows = _keyed(docs, id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(listed, _same(rows, listed), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_remover(width, texts_too), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
