"""Canonical length-limited Huffman codes, and blocks of coded ids.

A block is independent of all others::

    magic 4s | documents u32 | ids u64 | checkpoints u32 | payload bytes u64 | crc32 u32
    document ids i64[documents], null flags u8[documents], id counts u64[documents]
    checkpoints u64[checkpoints]: the bit at which every CHECKPOINT-th id begins
    payload

The crc covers what follows the header. Decoding walks all checkpoints of a
block in step, one table look-up for an id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MAGIC, HEADER = b"HUFB", struct.Struct("<4sIQIQI")
CHECKPOINT = 256
MAX_BITS = 18
#: Codes are written some at a time, so that memory stays small.
_STEP = 1 << 16


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    n = len(leaves)
    # level by level: which of the merged items are leaves, from the least weight up
    merged, is_leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        by_weight = np.argsort(both, kind="stable")
        merged = both[by_weight]
        is_leaf.append(by_weight < n)
    take = 2 * (n - 1)
    for level in reversed(is_leaf):
        taken_leaves = int(level[:take].sum())
        lengths[order[:taken_leaves]] += 1
        take = 2 * (take - taken_leaves)
    return lengths


@dataclass
class Code:
    """A canonical code: lengths alone define it."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        self.words = np.zeros(len(self.lengths), dtype=np.uint64)
        self.bits = int(self.lengths.max(initial=1))
        spans = np.left_shift(1, self.bits - self.lengths[order])  # places of a full table that a code takes
        begins = np.concatenate([[0], np.cumsum(spans)[:-1]]) if len(order) else np.zeros(0, dtype=np.int64)
        self.words[order] = (begins >> (self.bits - self.lengths[order])).astype(np.uint64)
        self.table_id = np.zeros(1 << self.bits, dtype=np.uint32)
        self.table_length = np.zeros(1 << self.bits, dtype=np.uint8)
        self.table_id[: spans.sum()] = np.repeat(order, spans)
        self.table_length[: spans.sum()] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(payload, bit position of each CHECKPOINT-th id)."""
        lengths = self.lengths[ids]
        if len(ids) and not lengths.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(lengths)
        begins = ends - lengths
        n_bits = int(ends[-1]) if len(ids) else 0
        out = np.zeros(n_bits // 32 + 2, dtype=np.uint64)  # 32 bits each
        for lo in range(0, len(ids), _STEP):
            part = slice(lo, lo + _STEP)
            at = begins[part]
            # a code lies in one or two words: put it at its place in both, codes of a word add up
            both = self.words[ids[part]] << (64 - lengths[part] - (at & 31)).astype(np.uint64)
            word = at >> 5
            first = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[first]] += np.add.reduceat(both >> np.uint64(32), first)
            out[word[first] + 1] += np.add.reduceat(both & np.uint64(0xFFFFFFFF), first)
        return out.astype(">u4").tobytes()[: (n_bits + 7) // 8], begins[::CHECKPOINT].astype(np.uint64)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids of a payload."""
        out = np.zeros(len(checkpoints) * CHECKPOINT, dtype=np.uint32)
        data = np.concatenate([np.frombuffer(payload, dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
        # four bytes from each byte on, so that a look-up needs one load
        four = (data[:-4].astype(np.uint32) << 24) | (data[1:-3].astype(np.uint32) << 16) | (data[2:-2].astype(np.uint32) << 8) | data[3:-1]
        left = n - np.arange(len(checkpoints)) * CHECKPOINT
        at = checkpoints.astype(np.int64)
        grid = out.reshape(-1, CHECKPOINT)
        shift = np.uint32(32 - self.bits)
        for k in range(min(CHECKPOINT, n)):
            live = int(np.searchsorted(-left, -k, side="left"))  # all but the last are full
            pos = at[:live]
            code = (four[pos >> 3] << (pos & 7).astype(np.uint32)) >> shift
            grid[:live, k] = self.table_id[code]
            at[:live] = pos + self.table_length[code]
        return out[:n]


def write_block(code: Code, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    whole = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
    payload, checkpoints = code.encode(whole)
    body = b"".join(
        [
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
            np.array([len(x) for x in ids], dtype="<u8").tobytes(),
            checkpoints.astype("<u8").tobytes(),
            payload,
        ]
    )
    return HEADER.pack(MAGIC, len(ids), len(whole), len(checkpoints), len(payload), zlib.crc32(body)) + body


def read_blocks(code: Code, stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of every document of a file, block by block."""
    while head := stream.read(HEADER.size):
        magic, docs, n, points, size, crc = HEADER.unpack(head)
        body = stream.read(docs * 17 + points * 8 + size)
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("a damaged block")
        doc_ids, nulls, counts, checkpoints = np.frombuffer(body, "<i8", docs), np.frombuffer(body, np.uint8, docs, docs * 8), np.frombuffer(body, "<u8", docs, docs * 9), np.frombuffer(body, "<u8", points, docs * 17)
        ids = code.decode(body[docs * 17 + points * 8 :], checkpoints, n)
        ends = np.cumsum(counts).astype(np.int64)
        for i in range(docs):
            yield None if nulls[i] else int(doc_ids[i]), ids[int(ends[i] - counts[i]) : int(ends[i])]
