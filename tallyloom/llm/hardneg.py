"""Hard negatives for anchors, by Four-Russians scores of every anchor against every row.

Components are quantised to integers. A candidate's components are cut into bit planes (two's
complement), and each plane into groups of eight dimensions, one byte a group. For an anchor
and a group a table holds the sums of all 256 subsets of its eight components, built by
doubling. The sum that one plane contributes to the inner product is one look-up a group, and
the planes are joined from the sign plane down by shift and add. Scores are exact.

The anchors are a stated set, packed into blocks of a bounded number, and so are the
candidates. Each anchor block meets all candidate blocks in cells (anchor block, salt), which
tasks work off block by block; a task keeps the best of each anchor so far, so what is shuffled
are a few rows an anchor and task. The first pass finds the positives, which bound the scores
that count as hard; the second finds the negatives.

Defined cases: rows without id, label or vector, or with a null or non-finite component, take no
part; nor do rows whose number of components is not the commonest, or whose quantised
components reach 2**23, beyond which scores could leave 64 bits. Rows that agree in id, label
and vector count once. Rows that share an anchor's id are no candidates of it; if they differ,
each is an anchor of its own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.vectors import dimension, finite, gathered, matrix
from tallyloom.session import freeze

GROUP = 8
ANCHORS, CANDIDATES = 256, 2048  # rows of a block
HELD_BYTES = 64 << 20  # of the tables a task holds at once
_LIMIT = 1 << 23


def subset_sums(values: np.ndarray, kind=np.int64) -> np.ndarray:
    """Sums of all subsets of each group of eight components: (rows, groups, 256)."""
    rows, dim = values.shape
    groups = -(-dim // GROUP)
    padded = np.zeros((rows, groups * GROUP), kind)
    padded[:, :dim] = values
    padded = padded.reshape(rows, groups, GROUP)
    table = np.zeros((rows, groups, 1 << GROUP), kind)
    for bit in range(GROUP):
        half = 1 << bit
        table[:, :, half : 2 * half] = table[:, :, :half] + padded[:, :, bit : bit + 1]
    return table


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """The planes of each group as bytes: (planes, groups, rows); the last plane holds signs."""
    rows, dim = values.shape
    groups = -(-dim // GROUP)
    out = np.zeros((planes, groups, rows), np.uint8)
    for plane in range(planes):
        bits = np.zeros((rows, groups * GROUP), np.uint8)
        bits[:, :dim] = (values >> plane) & 1
        out[plane] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products of one anchor, given its subset sums, with all packed candidates."""
    planes, groups, rows = packed.shape
    total = np.zeros(rows, table.dtype)
    for plane in range(planes - 1, -1, -1):
        part = np.zeros(rows, table.dtype)
        for group in range(groups):
            part += table[group].take(packed[plane, group])
        # the sign plane weighs negatively; each further plane is worth half
        total = -part if plane == planes - 1 else (total << 1) + part
    return total


def _pack_candidates(dim: int, planes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, CANDIDATES):
            ids, labels = (part[c].to_numpy().astype(np.int64) for c in ("id", "label"))
            packed = bit_planes(matrix(part["value"], dim, np.int64), planes)
            row = [len(ids), ids.tobytes(), labels.tobytes(), packed.tobytes()]
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["n", "ids", "labels", "planes"]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    return pack


def _pack_anchors(dim: int, with_positives: bool):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("key", "ascending")])
        ids, keys, labels = (group[c].to_numpy().astype(np.int64).tobytes() for c in ("id", "key", "label"))
        values = matrix(group["value"], dim, np.int64).tobytes()
        positives = group["positives"].to_pylist() if with_positives else [[] for _ in range(group.num_rows)]
        return pa.table(
            {
                "a": pa.array([group["a"][0].as_py()], pa.int64()),
                "anchor_ids": pa.array([ids], pa.binary()),
                "anchor_keys": pa.array([keys], pa.binary()),
                "anchor_labels": pa.array([labels], pa.binary()),
                "anchor_values": pa.array([values], pa.binary()),
                "positives": pa.array([[[p["score"] for p in x] for x in positives]], pa.list_(pa.list_(pa.int64()))),
            }
        )

    return pack


_ANCHOR_BLOCK = "a long, anchor_ids binary, anchor_keys binary, anchor_labels binary, anchor_values binary, positives array<array<bigint>>"


class _Anchors:
    """The anchors of a block, their tables, and the best rows found for each (anchor, band)."""

    def __init__(self, row: dict, dim: int, wide: bool) -> None:
        self.ids, self.keys, self.labels = (np.frombuffer(row[f"anchor_{c}"], np.int64) for c in ("ids", "keys", "labels"))
        values = np.frombuffer(row["anchor_values"], np.int64).reshape(len(self.ids), dim)
        self.tables = subset_sums(values, np.int64 if wide else np.int32)
        self.positives = row["positives"]
        none = np.empty(0, np.int64)
        self.best = [[(none, none)] * max(1, len(p)) for p in self.positives]


def first_rows(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties by smaller id."""
    if len(score) > k:
        # all that reach the k-th score, ties included
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        score, ids = score[near], ids[near]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def _positives(anchors: _Anchors, i: int, score: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> None:
    same = np.flatnonzero((labels == anchors.labels[i]) & (ids != anchors.ids[i]))
    held = anchors.best[i][0]
    anchors.best[i][0] = first_rows(np.concatenate([held[0], score[same]]), np.concatenate([held[1], ids[same]]), k)


def _negatives(anchors: _Anchors, i: int, score: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int, low: int, high: int) -> None:
    for j, positive in enumerate(anchors.positives[i]):
        held = anchors.best[i][j]
        hard = (low * positive <= 100 * score) & (100 * score <= high * positive) & (labels != anchors.labels[i])
        if len(held[0]) == k:  # an equal score may still have a smaller id
            hard &= score >= held[0][-1]
        at = np.flatnonzero(hard & (ids != anchors.ids[i]))
        if len(at):
            anchors.best[i][j] = first_rows(np.concatenate([held[0], score[at]]), np.concatenate([held[1], ids[at]]), k)


def _scored(dim: int, planes: int, wide: bool, keep: Callable):
    """Per task: the best rows of each (anchor, band) among the candidate blocks it meets."""
    groups = -(-dim // GROUP)

    def flush(held: _Anchors) -> pa.RecordBatch:
        rows = [(held.ids[i], held.keys[i], j, s, c) for i, bands in enumerate(held.best) for j, b in enumerate(bands) for s, c in zip(*b, strict=True)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor_id", "key", "band", "score", "id"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Anchors] = {}
        most = max(1, HELD_BYTES // (ANCHORS * max(1, groups) * (2048 if wide else 1024)))
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch[c][at] for c in ("ids", "labels", "planes")}
                ids, labels = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "labels"))
                packed = np.frombuffer(row["planes"].as_buffer(), np.uint8).reshape(planes, groups, len(ids)).astype(np.intp)
                a = batch["a"][at].as_py()
                if a not in held:
                    if len(held) == most:
                        yield flush(held.pop(next(iter(held))))
                    held[a] = _Anchors({c: batch[c][at].as_py() for c in batch.schema.names if c.startswith("anchor_") or c == "positives"}, dim, wide)
                anchors = held[a]
                for i in range(len(anchors.ids)):
                    keep(anchors, i, scores(anchors.tables[i], packed).astype(np.int64), ids, labels)
        for rest in held.values():
            yield flush(rest)

    return run


def _quantised(rows: DataFrame, id: str, vector: str, label: str, scale: int) -> tuple[DataFrame, int]:
    """(id, label, value) of the rows that take part, without repeats, and their dimension."""
    small = F.forall("vector", lambda x: F.abs(x.cast("double") * scale) < float(_LIMIT))
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector")))
    dim = dimension(rows, "vector")
    fit = F.when(F.coalesce(small, F.lit(False)), F.col("vector"))
    value = F.transform(fit, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = rows.where(F.size("vector") == dim).select("id", "label", "vector", value.alias("value")).where("value IS NOT NULL")
    return rows.distinct().select("id", "label", "value", F.xxhash64("id", "label", "vector").alias("key")), dim


def _blocks(anchors: DataFrame, count: int, dim: int, positives: bool) -> DataFrame:
    """Anchors dealt into packed blocks of about ``ANCHORS``."""
    n = max(1, -(-count // ANCHORS))
    dealt = anchors.withColumn("a", F.pmod("key", F.lit(n)))
    return dealt.groupBy("a").applyInArrow(_pack_anchors(dim, positives), _ANCHOR_BLOCK)


def _cells(candidates: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Each candidate block with each anchor block; the salt spreads an anchor block over tasks."""
    salts = max(1, -(-int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2 // blocks))
    left = candidates.withColumn("s", F.pmod("block", F.lit(salts)))
    left = left.withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = anchors.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, ["a", "s"]).drop("s", "block", "n")


_BEST = "anchor_id long, key long, band int, score long, id long"


def mine(
    rows: DataFrame,
    anchors: Column | str,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a predicate over ``id``. An anchor's positives are its first rows of the same
    label; for each, the first rows of other labels that score between ``low`` and ``high``
    percent of it.
    """
    found, dim = _quantised(rows, id, vector, label, scale)
    found = freeze(found, "quantised")
    chosen = found.where(F.expr(anchors) if isinstance(anchors, str) else anchors)
    top = F.max(F.array_max(F.transform("value", lambda x: F.greatest(x, -x - 1))))
    most = found.agg(top.alias("top")).first()["top"] or 0
    planes = int(most).bit_length() + 1
    wide = dim * (int(most) + 1) ** 2 * 2 >= 1 << 31
    count = chosen.count()
    blocks = max(1, -(-count // ANCHORS))
    packed = found.select("id", "label", "value").mapInArrow(_pack_candidates(dim, planes), "n int, ids binary, labels binary, planes binary")
    # a block's number is fixed by being written
    packed = freeze(packed.withColumn("block", F.xxhash64(F.monotonically_increasing_id())), "candidates")

    near = _cells(packed, _blocks(chosen, count, dim, False), blocks)
    near = near.mapInArrow(_scored(dim, planes, wide, lambda *x: _positives(*x, positives)), _BEST)
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    listed = F.array_sort(F.collect_list(F.struct((F.col("place") - 1).alias("band"), F.col("id"), F.col("score"))))
    near = freeze(near.groupBy("anchor_id", "key").agg(listed.alias("positives")), "positives")

    armed = chosen.join(near.withColumnRenamed("anchor_id", "id"), ["id", "key"])
    hard = _cells(packed, _blocks(armed, count, dim, True), blocks)
    hard = hard.mapInArrow(_scored(dim, planes, wide, lambda *x: _negatives(*x, negatives, low, high)), _BEST)
    order = Window.partitionBy("anchor_id", "key", "band").orderBy(F.desc("score"), "id")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    each = near.select("anchor_id", "key", F.inline("positives").alias("band", "positive_id", "positive_score"))
    return hard.join(each, ["anchor_id", "key", "band"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
