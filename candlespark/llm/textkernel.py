"""Vectorised word, line and shingle hashing over Arrow string columns.

Whole texts are hashed on their UTF-8 bytes with numpy, a megabyte at a time,
so that no Python object exists per word and a worker stays small. A word is a run of bytes outside
``[\\x20\\x09-\\x0D]``; these are ASCII, so byte and character views agree.

The hash of a span is a polynomial over its bytes modulo 2**64, taken from
prefix sums and then mixed. Spans are cut at word ends only, so a text longer
than a slice hashes as if it were held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: A slice takes some tens of times its bytes: about twenty arrays of a number for each byte or word.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for the positions of one slice."""
    if not _powers:
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(SLICE_BYTES + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span; equal bytes, equal hash.

    Starts and ends ascend. Prefix sums are taken a slice at a time, so a very
    long text takes no more memory than a slice.
    """
    up, down = _power_tables()
    at_start, at_end = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(ends), dtype=np.uint64)
    carry = np.zeros(1, dtype=np.uint64)
    for k, lo in enumerate(range(0, len(data) + 1, SLICE_BYTES)):
        part = data[lo : lo + SLICE_BYTES]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        sums = sums * np.uint64(pow(_BASE, k * SLICE_BYTES, 1 << 64)) + carry
        for positions, values in ((starts, at_start), (ends, at_end)):
            i, j = np.searchsorted(positions, [lo, lo + SLICE_BYTES])
            values[i:j] = sums[positions[i:j] - lo]
        carry = sums[-1:]
    whole = np.array([pow(_BASE_INVERSE, k * SLICE_BYTES, 1 << 64) for k in range(len(data) // SLICE_BYTES + 1)], dtype=np.uint64)
    raw = (at_end - at_start) * down[starts % SLICE_BYTES] * whole[starts // SLICE_BYTES]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``limit`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


@dataclass
class Words:
    """Words of some documents in reading order."""

    row: np.ndarray  # int64, the document's index in the slice
    start: np.ndarray  # int64, byte position in the slice
    end: np.ndarray
    hash: np.ndarray  # uint64


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """All words of the documents data[offsets[i]:offsets[i + 1]]; offsets start at 0."""
    n = len(data)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(row, start, end, span_hashes(data, start, end))


def shingles(w: Words, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every document's distinct ``size``-word shingles, sorted by both.

    A document with fewer words gives its whole sequence as one; without words, none.
    """
    counts = np.bincount(w.row, minlength=n_rows)
    first = np.zeros(n_rows + 1, dtype=np.int64)
    np.cumsum(counts, out=first[1:])
    total = len(w.hash)
    left = first[w.row + 1] - np.arange(total)  # words from here to the document's end
    take = np.minimum(counts[w.row], size)  # words in this document's shingles
    begins = np.flatnonzero(left >= take)
    acc = np.full(len(begins), 0x51ED270B0A1F39C1, dtype=np.uint64)
    length = take[begins]
    for k in range(size):
        has = length > k
        nxt = np.where(has, w.hash[np.minimum(begins + k, total - 1)] if total else 0, np.uint64(k + 1))
        acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + nxt.astype(np.uint64))
    acc = mix(acc + length.astype(np.uint64))
    row = w.row[begins]
    order = np.lexsort((acc, row))
    row, acc = row[order], acc[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (acc[1:] != acc[:-1])
    return row[fresh], acc[fresh]
