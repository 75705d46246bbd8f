"""Word arithmetic on Arrow string batches, without a Python step per word.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``). A block of
texts is one byte buffer; words, their hashes and the hashes of k-word windows come out of
prefix sums over it, so the cost is a fixed number of passes per byte and per word. Blocks
are cut by bytes, so memory does not depend on how many rows an Arrow batch holds; a single
text longer than a block makes a block of its own.

A word's hash is the sum of a mixed value for each pair of a byte and its place in the word. A
polynomial of the bytes modulo 2**64 would not do: words of a thousand letters can be made, and
occur in generated text, on which all such polynomials agree. Windows are polynomials of word
hashes, over fewer words than such a construction needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_STEP = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i in 0..n-1; ``base`` is odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Block:
    """Some texts as words. Word arrays run over all texts; ``first`` bounds each text's words."""

    row: int  # of the first text in its batch
    texts: int
    data: np.ndarray  # bytes, lower-cased if asked for
    start: np.ndarray  # byte bounds of each word in data
    end: np.ndarray
    first: np.ndarray  # texts + 1 entries: index of each text's first word
    hash: np.ndarray  # of each word

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def windows(self, k: int, base: int = _WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all k-word windows that lie in one text, and their hashes."""
        n = len(self.hash)
        if n < k:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        hashes = sequence_hash(self.hash, np.arange(n - k + 1), k, base)
        left = np.repeat(self.first[1:], np.diff(self.first))[: n - k + 1] - np.arange(n - k + 1)
        at = np.flatnonzero(left >= k)
        return at, hashes[at]


def prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


def sequence_hash(
    values: np.ndarray, start: np.ndarray, length: np.ndarray | int, base: int = _WORD_BASE
) -> np.ndarray:
    """Hashes of the runs of ``values`` that begin at ``start`` and are ``length`` long."""
    sums, down = prefix(values, base)
    raw = (sums[start + length] - sums[start]) * down[start]
    return mix(raw + np.uint64(0x165667B19E3779F9) * np.asarray(length).astype(np.uint64))


def blocks(texts: pa.Array, lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """``texts`` cut into blocks; a null text has no words. ``lower`` maps A-Z to a-z."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1)
        data = whole[offsets[row] : offsets[stop]]
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        yield _block(row, data, offsets[row : stop + 1] - offsets[row])
        row = stop


def _block(row: int, data: np.ndarray, bounds: np.ndarray) -> Block:
    texts = len(bounds) - 1
    none = np.empty(0, np.int64)
    if not len(data):
        return Block(row, texts, data, none, none, np.zeros(texts + 1, np.int64), np.empty(0, np.uint64))
    inside = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = _word_hashes(data, start, end)
    return Block(row, texts, data, start, end, np.searchsorted(start, bounds), hashes)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    if not len(start):
        return np.empty(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(first, length)
    letters = data[place + np.repeat(start, length)]
    # place and byte are one number, spread by an odd factor before the bits are mixed
    values = mix((place.astype(np.uint64) << np.uint64(8) | letters) * np.uint64(_BYTE_STEP) + np.uint64(1))
    return mix(np.add.reduceat(values, first) + length.astype(np.uint64))


def distinct_per_text(texts: int, doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``values`` of each text, ascending, and the texts + 1 bounds of each text's part."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    doc, values = doc[new], values[new]
    return values, np.searchsorted(doc, np.arange(texts + 1))
