"""Approximate nearest neighbours from balanced posting lists.

A bounded sample is halved again and again at the median between two means, so all leaves hold
equally many sample rows; their means are the centroids of the lists. Every row is posted to
the list of its nearest centroid and, near a boundary, to further lists whose centroid is at
most ``CLOSURE`` times as far, up to ``REPLICAS`` lists. Lists are cut into blocks of bounded
size, so a list that many equal rows share is many small blocks.

A query walks an in-memory graph of the centroids (near neighbours, a ring, a few long links)
from several entries, always expanding the nearest, and takes every list whose centroid is at
most ``ratio`` times as far as the nearest one, and further ones if those hold too few rows.
That ratio is measured on the sample when the
index is built: it is the one that reaches ``TARGET`` of the exact neighbours of held-out sample
rows. Neighbours in a sample are farther off than in the whole table, so this errs upwards.
Each (list, block) scores its queries exactly and returns its ``k`` best; the best of all are
ranked.

The sample, the centroids and their graph are bounded by ``SAMPLE_BYTES`` and ``LIST_BYTES``
whatever the size of the table; every row is posted.

Defined cases: rows without an id or vector, with a zero vector or with a null or non-finite
component take no part, nor do rows whose number of components is not the commonest. Rows that
agree in id and vector are one; rows that share a query's id are no candidates of it, and
different query rows of one id are each answered. Fewer candidates than ``k`` give fewer rows, an
empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.vectors import dimension, finite, gathered, matrix, sampled
from tallyloom.session import freeze

LIST_ROWS, MAX_LISTS = 256, 4096
SAMPLE_ROWS = 32_768
SAMPLE_BYTES, LIST_BYTES = 32 << 20, 8 << 20
REPLICAS, CLOSURE = 4, 1.02
TARGET = 0.97
BLOCK_ROWS = 1024  # of a list
QUERY_ROWS = 16_384  # that one block answers at a time
LINKS, LONG_LINKS, ENTRIES, BEAM = 12, 4, 8, 8


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``, up to rounding."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.maximum(d, 0, out=d)


def balanced_means(sample: np.ndarray, lists: int, rounds: int = 5) -> np.ndarray:
    """Means of ``lists`` leaves of equal size, by halving at the median between two means."""
    out, todo = [], [(np.arange(len(sample)), lists)]
    while todo:
        rows, parts = todo.pop()
        if parts == 1:
            out.append(sample[rows].mean(0))
            continue
        points, left = sample[rows], parts // 2
        cut = len(rows) * left // parts
        # from the mean, the row farthest off and the row farthest from that one
        far = points[((points - points.mean(0)) ** 2).sum(1).argmax()]
        ends = [far, points[((points - far) ** 2).sum(1).argmax()]]
        for _ in range(rounds):
            order = np.argsort(points @ (ends[1] - ends[0]), kind="stable")
            ends = [points[order[:cut]].mean(0), points[order[cut:]].mean(0)]
        todo += [(rows[order[cut:]], parts - left), (rows[order[:cut]], left)]
    return np.array(out)


@dataclass(frozen=True)
class Lists:
    """Centroids, the graph between them, and the ratio that selects lists."""

    centroids: np.ndarray
    links: np.ndarray
    ratio: float = 1.0

    def posted(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every posting of ``vectors``."""
        d = np.sqrt(squares(vectors, self.centroids))
        most = min(REPLICAS, d.shape[1])
        near = np.argpartition(d, most - 1, axis=1)[:, :most]
        far = np.take_along_axis(d, near, 1)
        row, at = np.nonzero(far <= CLOSURE * far.min(1, keepdims=True))
        return row, near[row, at]

    def enough(self, query: np.ndarray, taken: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
        """The lists taken, with the next nearest ones until they hold ``least`` postings."""
        if counts[taken].sum() >= least:
            return taken
        order = np.argsort(squares(query[None], self.centroids)[0], kind="stable")
        order = np.concatenate([taken, order[~np.isin(order, taken)]])
        full = np.flatnonzero(np.cumsum(counts[order]) >= least)
        return order[: full[0] + 1] if len(full) else order

    def selected(self, queries: np.ndarray) -> list[np.ndarray]:
        """The lists of each query, by a walk over the graph."""
        n, lists = len(queries), len(self.centroids)
        d = np.full((n, lists), np.inf)
        open_ = np.zeros((n, lists), bool)
        entries = np.unique(np.linspace(0, lists - 1, min(ENTRIES, lists)).astype(int))
        d[:, entries] = np.sqrt(squares(queries, self.centroids[entries]))
        open_[:, entries] = True
        beam = min(BEAM, lists)
        while True:
            bound = np.maximum(self.ratio * d.min(1), np.partition(d, beam - 1, axis=1)[:, beam - 1])
            q, c = np.nonzero(open_ & (d <= bound[:, None]) & np.isfinite(d))
            if not len(q):
                break
            open_[q, c] = False
            new = np.zeros((n, lists), bool)
            new[np.repeat(q, self.links.shape[1]), self.links[c].ravel()] = True
            q, c = np.nonzero(new & np.isinf(d))
            d[q, c] = np.sqrt(((queries[q] - self.centroids[c]) ** 2).sum(1))
            open_[q, c] = True
        taken = d <= self.ratio * d.min(1, keepdims=True)
        return [np.flatnonzero(x) for x in taken]


def graph(centroids: np.ndarray) -> np.ndarray:
    """Links of each centroid: its nearest ones, its neighbours on a ring and a few long ones."""
    n = len(centroids)
    near = min(LINKS, n - 1)
    links = np.empty((n, near + 2 + LONG_LINKS), np.int64)
    for start in range(0, n, 512):
        d = squares(centroids[start : start + 512], centroids)
        d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
        if near:
            links[start : start + 512, :near] = np.argpartition(d, near - 1, axis=1)[:, :near]
    at = np.arange(n)
    links[:, near], links[:, near + 1] = (at + 1) % n, (at - 1) % n
    links[:, near + 2 :] = np.random.default_rng(7).integers(0, n, (n, LONG_LINKS))
    return links


def fit(sample: np.ndarray, lists: int, k: int) -> Lists:
    """Lists from a sample, with the ratio that finds ``TARGET`` of the exact neighbours in it."""
    sample = np.unique(sample, axis=0)
    lists = max(1, min(lists, len(sample)))
    built = Lists(balanced_means(sample, lists), np.empty((0, 0)))
    built = Lists(built.centroids, graph(built.centroids))
    row, posted = built.posted(sample)
    first = np.searchsorted(row, np.arange(len(sample) + 1))
    # rows spread over the sample stand in for queries
    asked = np.unique(np.linspace(0, len(sample) - 1, min(256, len(sample))).astype(int))
    need = []
    for start in range(0, len(asked), 32):
        chosen = asked[start : start + 32]
        d = squares(sample[chosen], sample)
        d[np.arange(len(chosen)), chosen] = np.inf
        most = min(k, len(sample) - 1)
        if not most:
            break
        to = np.sqrt(squares(sample[chosen], built.centroids))
        nearest = np.maximum(to.min(1), 1e-12)
        for i, rows in enumerate(np.argpartition(d, most - 1, axis=1)[:, :most]):
            need += [to[i, posted[first[r] : first[r + 1]]].min() / nearest[i] for r in rows]
    ratio = max(1.0, float(np.quantile(need, TARGET))) if need else 1.0
    return Lists(built.centroids, built.links, ratio * (1 + 1e-9))


def _post(index, dim: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, 1024):
            row, lists = index.value.posted(matrix(part["vector"], dim))
            taken = part.take(pa.array(row))
            columns = [taken["id"].combine_chunks(), pa.array(lists, pa.int32()), taken["vector"].combine_chunks()]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "list", "vector"])

    return post


def _blocks(counts: np.ndarray) -> np.ndarray:
    """The number of blocks of lists that hold so many postings."""
    return np.maximum(1, -(-counts // BLOCK_ROWS))


def _ask(index, counts, dim: int, k: int):
    """The queries, once for each block of each list they select."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row has REPLICAS postings at most, so these hold k rows besides the query
        least = REPLICAS * (k + 1)
        for part in gathered(batches, 256):
            queries = matrix(part["vector"], dim)
            chosen = index.value.selected(queries)
            chosen = [index.value.enough(q, x, counts.value, least) for q, x in zip(queries, chosen, strict=True)]
            row = np.repeat(np.arange(len(chosen)), [len(x) for x in chosen])
            lists = np.concatenate(chosen)
            count = _blocks(counts.value[lists])
            row, lists = np.repeat(row, count), np.repeat(lists, count)
            block = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            for start in range(0, len(row), 4096):
                cut = slice(start, start + 4096)
                taken = part.take(pa.array(row[cut]))
                columns = [taken[c].combine_chunks() for c in ("query_id", "query_key", "vector")]
                columns += [pa.array(lists[cut], pa.int32()), pa.array(block[cut], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query_key", "query", "list", "block"])

    return ask


def nearest_in(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest of some rows, their distances exact: rows that rounding may hide are measured."""
    keep = ids != own
    near = np.where(keep, sizes + query @ query - 2 * (vectors @ query), np.inf)
    some = min(k, int(keep.sum()))
    if not some:
        return ids[:0], sizes[:0]
    reach = np.partition(near, some - 1)[some - 1] + 1e-9 * (sizes.max() + query @ query)
    at = np.flatnonzero(near <= reach)
    exact = np.sqrt(((vectors[at] - query) ** 2).sum(1))
    order = np.lexsort((ids[at], exact))[:k]
    return ids[at][order], exact[order]


def _search(dim: int, k: int):
    names, kinds = ["query_id", "query_key", "vec_id", "score"], (pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def search(posted: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if posted.num_rows and asked.num_rows:
            ids, vectors = posted["id"].to_numpy().astype(np.int64), matrix(posted["vector"], dim)
            sizes = (vectors * vectors).sum(1)
            queries = matrix(asked["query"], dim)
            for query_id, key, query in zip(asked["query_id"].to_pylist(), asked["query_key"].to_pylist(), queries, strict=True):
                found, score = nearest_in(vectors, ids, query, query_id, k, sizes)
                out += [(query_id, key, i, s) for i, s in zip(found.tolist(), score.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return search


def nearest(rows: DataFrame, queries: Column | str, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row that ``queries`` (over ``id``) picks."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    dim = dimension(rows, "vector")
    rows = rows.where(F.size("vector") == dim)
    total = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    most = max(1, min(MAX_LISTS, LIST_BYTES // (8 * dim)))
    size = max(most, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    order = F.xxhash64("id", "vector", F.monotonically_increasing_id())
    sample = sampled(rows.withColumn("order", order), total, size).select("vector").toArrow()
    built = fit(matrix(sample["vector"], dim), min(most, -(-total // LIST_ROWS)), k)
    index = spark.sparkContext.broadcast(built)

    # the index: written once, so the salt that deals a list into blocks stays
    posted = rows.distinct().mapInArrow(_post(index, dim), "id long, list int, vector array<double>")
    posted = freeze(posted.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "postings")
    counts = np.zeros(len(built.centroids), np.int64)
    for row in posted.groupBy("list").count().collect():  # one row a list
        counts[row["list"]] = row["count"]
    per_list = spark.sparkContext.broadcast(counts)
    dealt = f"pmod(salt, element_at(array({', '.join(map(str, _blocks(counts)))}), list + 1))"
    posted = posted.withColumn("block", F.expr(dealt).cast("int"))

    asked = rows.where(F.expr(queries) if isinstance(queries, str) else queries).distinct()
    asked = freeze(asked.select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("query_key"), "vector"), "queries")
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    kinds = "query_id long, query_key long, query array<double>, list int, block int"
    asked = asked.mapInArrow(_ask(index, per_list, dim, k), kinds).withColumn("part", F.pmod("query_key", F.lit(parts)).cast("int"))
    posted = posted.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    keys = ["list", "block", "part"]
    found = posted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search(dim, k), "query_id long, query_key long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
