"""Periodic runs of words: stretches that repeat with a period, over four times or more.

A run is a stretch with smallest period ``q`` (words ``q`` apart are equal) of at least
``max(min_words, min_periods * q)`` words that no neighbouring word extends. Periods are
searched by octave, from ``2**k`` to ``2**(k+1) - 1``. The stretch of places that equal the
place a period on is at least ``3 * 2**k`` long, so it meets a boundary that lies on a grid of
that step. A tile is the boundary with ``5 * 2**k`` words before it and ``3 * 2**k`` after; two
Z-functions over it give, for each lag of the octave, how far the text agrees with itself
forwards from the boundary and backwards from it. Tiles with no lag under which the words
around the boundary agree are passed over by array comparison. A lag whose period is itself a
power of a shorter word is left out, since the shorter period gives the run. What a tile finds
is a fragment, cut off at its reach; fragments of neighbouring tiles touch.

A document of up to ``PIECE`` words is one piece and its tiles are solved where it is read. A
longer one is exploded, for every three octaves, into overlapping pieces eight times as long as
those before, which are dealt to all tasks. Fragments that may go on in a neighbouring piece
are shuffled by document and period, and those that touch are stitched.

A word is dropped if a run contains it after the run's first period.

Defined cases: words are runs of other bytes than ASCII white space; a null or empty text has
none, and no runs. Rows are told apart by id and text; identical rows get the same result, as
often as they stand there. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import freeze

MIN_WORDS, MIN_PERIODS = 6, 4
PIECE = 8192  # words of the smallest pieces
BLOCK_WORDS = 1 << 18  # that are compared at once
_STEP, _BEFORE = 3, 5  # a tile's step and reach, times 2**octave
_AGREE = 16  # words compared before a tile is solved

Fragment = tuple[int, int, int]  # period, start, stop


def z_values(s: list) -> list[int]:
    """For each place, how many elements from there on agree with the start."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def octaves(n_words: int) -> int:
    """The number of octaves whose shortest period can repeat often enough."""
    return max(0, (n_words // MIN_PERIODS).bit_length())


@dataclass
class Pieces:
    """Pieces one after the other, each followed by an element that equals no other."""

    ids: np.ndarray
    first: np.ndarray  # bounds of each piece, its separator included

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> Pieces:
        sizes = np.array([len(p) + 1 for p in parts])
        first = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.empty(first[-1], np.int64)
        for i, part in enumerate(parts):
            ids[first[i] : first[i + 1] - 1] = part
        ids[first[1:] - 1] = -1 - np.arange(len(parts))
        return cls(ids, first)

    def promising(self, octave: int) -> dict[int, list[int]]:
        """Boundaries and lags of the octave under which the words around the boundary agree."""
        ids, size, n = self.ids, 1 << octave, len(self.ids)
        step = _STEP * size
        piece = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        grid = np.arange(step, n, step)
        bounds, lags = [], []
        for start in range(0, len(grid), max(1, (1 << 20) // size)):
            b = grid[start : start + max(1, (1 << 20) // size)]
            lag = np.arange(size, 2 * size)
            back = b[:, None] - lag[None]
            i, j = np.nonzero((ids[b][:, None] == ids[np.maximum(back, 0)]) & (back >= 0))
            bounds.append(b[i])
            lags.append(lag[j])
        b = np.concatenate(bounds) if bounds else np.empty(0, np.int64)
        lag = np.concatenate(lags) if lags else b
        same = piece[b] == piece[b - lag]
        b, lag = b[same], lag[same]
        # a run goes on for half a step to one side of the boundary at least
        most = min(_AGREE, step // 2)
        ahead, behind = np.ones(len(b), bool), np.ones(len(b), bool)
        for t in range(1, most):
            at = np.minimum(b + t, n - 1)
            ahead &= (ids[at] == ids[at - lag]) & (b + t < n)
        for t in range(1, most + 1):
            at = b - t
            behind &= (at - lag >= 0) & (ids[np.maximum(at, 0)] == ids[np.maximum(at - lag, 0)])
        tiles = defaultdict(list)
        for x, y in zip(b[ahead | behind].tolist(), lag[ahead | behind].tolist(), strict=True):
            tiles[x].append(y)
        return tiles

    def solve(self, octave: int) -> Iterator[tuple[int, Fragment]]:
        """(piece, fragment) of every tile of the octave, at places of the block."""
        size = 1 << octave
        step, most = _STEP * size, 2 * size - 1
        for b, lags in self.promising(octave).items():
            piece = int(np.searchsorted(self.first, b, "right")) - 1
            low, high = int(self.first[piece]), int(self.first[piece + 1]) - 1
            right = self.ids[b : min(b + step, high)].tolist()
            left = self.ids[max(low, b - most - step) : b].tolist()
            ahead = z_values([*right, None, *left[-most:], *right])[len(right) + 1 :]
            behind = z_values(left[::-1])
            near = min(most, len(left))
            # shorter periods under which the words before the boundary repeat
            roots: list[int] = []
            for q in range(1, near + 1):
                if q < len(behind) and behind[q] >= q and not any(q % r == 0 and behind[r] + r >= q for r in roots):
                    roots.append(q)
            for p in lags:
                if any(r < p and p % r == 0 and behind[r] + r >= p for r in roots):
                    continue
                after = min(ahead[near - p], step)
                before = min(behind[p], step) if p < len(behind) else 0
                if after:
                    yield piece, (p, b - p - before, b + after)


def joined(fragments: list[Fragment]) -> list[Fragment]:
    """Fragments of one text, with those that touch as one: they share a period's length."""
    out: list[Fragment] = []
    for p, start, stop in sorted(fragments):
        if out and out[-1][0] == p and start <= out[-1][2] - p:
            out[-1] = (p, out[-1][1], max(out[-1][2], stop))
        else:
            out.append((p, start, stop))
    return out


def fragments(parts: list[np.ndarray], low: int, high: int, min_words: int, min_periods: int, open_: list[tuple[bool, bool]]) -> list[list[Fragment]]:
    """Fragments of each piece by octaves ``low`` to ``high``; short ones that end inside it are left out.

    ``open_`` says whether the text goes on before and after a piece.
    """
    pieces = Pieces.of(parts)
    found: list[list[Fragment]] = [[] for _ in parts]
    for octave in range(low, high):
        for piece, (p, start, stop) in pieces.solve(octave):
            base = int(pieces.first[piece])
            found[piece].append((p, start - base, stop - base))
    out = []
    for part, (before, after), listed in zip(parts, open_, found, strict=True):
        n = len(part)
        out.append([(p, s, e) for p, s, e in joined(listed) if e - s >= max(min_words, min_periods * p) or (s == 0 and before) or (e == n and after)])
    return out


def cuts(n_words: int, piece_words: int = PIECE) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, octave after the last, start, stop) of the pieces of a long text."""
    last, low, size = octaves(n_words), 0, piece_words
    while low < last:
        top = (size // 16).bit_length() - 1  # a piece is 16 times its longest octave
        high = min(top + 1, last)
        for start in range(0, n_words, size):
            yield low, high, max(0, start - (_BEFORE << top)), min(n_words, start + size + (_STEP << top))
        low, size = high, size * 8


_FRAGMENT = pa.struct([("period", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
_PIECE = pa.struct([("low", pa.int32()), ("high", pa.int32()), ("start", pa.int32()), ("n_words", pa.int32()), ("ids", pa.binary())])
_FRAGMENT_SQL = "struct<period:int,start:int,stop:int>"
_PIECE_SQL = "struct<low:int,high:int,start:int,n_words:int,ids:binary>"


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _read(min_words: int, min_periods: int, texts: bool, piece_words: int):
    """Each document with its fragments, or, if it is long, without them and followed by its pieces.

    The words go along where they are asked for or where runs are still to be cut out.
    """
    names = ["doc", "n_words", "text", "sha256", "fragments", "piece"]

    def batch_of(docs: list, source: pa.Array, rows: list[dict]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(_FRAGMENT), _PIECE)
        columns = [pa.array([r.get(c) for r in rows], k) for c, k in zip(names[1:], kinds, strict=True)]
        return pa.RecordBatch.from_arrays([source.take(pa.array(docs)), *columns], names=names)

    def solved(source: pa.Array, held: list[tuple[int, list[bytes], np.ndarray]]) -> pa.RecordBatch:
        parts = [ids for _, _, ids in held]
        most = octaves(max(map(len, parts)))
        found = fragments(parts, 0, most, min_words, min_periods, [(False, False)] * len(parts))
        rows = []
        for (_, words, _), listed in zip(held, found, strict=True):
            row = {"n_words": len(words), "sha256": _digest(words), "fragments": [{"period": p, "start": s, "stop": e} for p, s, e in listed]}
            if texts or listed:
                row["text"] = b" ".join(words).decode()
            rows.append(row)
        return batch_of([i for i, _, _ in held], source, rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, held, size = batch["doc"], [], 0
            numbers: dict[bytes, int] = defaultdict(lambda: len(numbers))
            for i, text in enumerate(batch["text"]):
                words = (text.as_py() or "").encode().split()
                ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                if len(words) > piece_words:
                    yield batch_of([i], source, [{"n_words": len(words), "sha256": _digest(words), "text": b" ".join(words).decode()}])
                    for low, high, start, stop in cuts(len(words), piece_words):
                        piece = {"low": low, "high": high, "start": start, "n_words": len(words), "ids": ids[start:stop].astype(np.int32).tobytes()}
                        yield batch_of([i], source, [{"piece": piece}])
                    continue
                held.append((i, words, ids))
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield solved(source, held)
                    held, size = [], 0
                    numbers.clear()
            if held:
                yield solved(source, held)

    return read


def _solve_pieces(min_words: int, min_periods: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows = [], []
            for i, piece in enumerate(batch["piece"].to_pylist()):
                ids = np.frombuffer(piece["ids"], np.int32).astype(np.int64)
                start, n = piece["start"], piece["n_words"]
                open_ = (start > 0, start + len(ids) < n)
                found = fragments([ids], piece["low"], piece["high"], min_words, min_periods, [open_])[0]
                docs += [i] * len(found)
                rows += [{"period": p, "start": s + start, "stop": e + start} for p, s, e in found]
            yield pa.RecordBatch.from_arrays([batch["doc"].take(pa.array(docs, pa.int64())), pa.array(rows, _FRAGMENT)], names=["doc", "fragment"])

    return solve


def _collapse(texts: bool):
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_texts, digests = [], []
            for text, runs in zip(batch["text"], batch["runs"], strict=True):
                words = text.as_py().encode().split()
                keep = np.ones(len(words), bool)
                for run in runs.as_py() or ():
                    keep[run["start"] + run["period"] : run["start"] + run["length"]] = False
                kept = [words[i] for i in np.flatnonzero(keep)]
                kept_texts.append(b" ".join(kept).decode() if texts else None)
                digests.append(_digest(kept))
            columns = [batch["doc"], batch["n_words"], batch["runs"], pa.array(kept_texts, pa.string()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "runs", "collapsed", "collapsed_sha256"])

    return collapse


def _doc(id: str, text: str) -> Column:
    return F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))


def stitched(found: DataFrame, min_words: int, min_periods: int) -> DataFrame:
    """(doc, runs): fragments (doc, fragment) that touch under one period joined, short results left out."""
    rows = found.select("doc", "fragment.*").distinct()
    before = Window.partitionBy("doc", "period").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("reach", F.max(F.col("stop") - F.col("period")).over(before))
    so_far = Window.partitionBy("doc", "period").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    new = F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), 1).otherwise(0)
    rows = rows.withColumn("part", F.sum(new).over(so_far))
    runs = rows.groupBy("doc", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    runs = runs.where((F.col("stop") - F.col("start")) >= F.greatest(F.lit(min_words), min_periods * F.col("period")))
    runs = runs.select("doc", *[F.col(c).cast("long").alias(c) for c in ("start", "period", "stop")])
    listed = runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "period", "stop"))).alias("runs"))
    run = F.transform("runs", lambda x: F.struct(x["start"].alias("start"), (x["stop"] - x["start"]).alias("length"), x["period"].alias("period")))
    return listed.select("doc", run.alias("runs"))


def periodic_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, id: str = "doc_id", text: str = "text", texts: bool = True, piece_words: int = PIECE
) -> DataFrame:
    """(id, n_words, runs, collapsed, collapsed_sha256) of every row.

    ``runs`` is array<struct<start, length, period>> by start, then period. ``collapsed`` is the
    kept words joined by a space, null if not asked for by ``texts``. ``piece_words`` is a power
    of two of 16 at least.
    """
    if min_periods < 4:
        raise ValueError("tiles find runs of four periods and more")
    rows = docs.select(_doc(id, text).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_words long, text string, sha256 string, fragments array<{_FRAGMENT_SQL}>, piece {_PIECE_SQL}"
    read = freeze(rows.mapInArrow(_read(min_words, min_periods, texts, piece_words), schema), "periodic")
    near = read.select("doc", F.explode("fragments").alias("fragment"))
    pieces = read.where("piece IS NOT NULL").select("doc", "piece").repartition("doc", "piece.low", "piece.start")
    found = pieces.mapInArrow(_solve_pieces(min_words, min_periods), f"doc {kind}, fragment {_FRAGMENT_SQL}")
    runs = stitched(near.union(found), min_words, min_periods)

    whole = read.where("piece IS NULL")
    result = f"doc {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string, collapsed_sha256 string"
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    settled = F.coalesce(F.size("fragments") == 0, F.lit(False))
    plain = whole.where(settled).select("doc", "n_words", none.alias("runs"), F.col("text").alias("collapsed"), F.col("sha256").alias("collapsed_sha256"))
    # only documents with runs, or long ones, take their words through a join
    rest = whole.where(~settled).join(runs, "doc", "left").select("doc", "n_words", "text", F.coalesce("runs", none).alias("runs"))
    done = plain.union(rest.mapInArrow(_collapse(texts), result))
    return done.select(F.col("doc.id").alias(id), "n_words", "runs", "collapsed", "collapsed_sha256")
