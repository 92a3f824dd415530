"""Statistics of whole documents, computed with numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.llm import textkernel as K

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: What a score may see of a document: ratios and logarithms of counts, from its text alone.
FEATURES = [
    "log_words", "word_length", "symbols_per_char", "upper_per_char", "digits_per_char", "points_per_char", "bangs_per_char", "others_per_char",
    "wide_per_char", "lines_per_word", "dup_lines", "repeat_words", "distinct_words", "top_word", "upper_words", "short_words", "long_words", "words_with_symbol", "words_per_point", "log_line_words",
]

SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"

REPEAT_WINDOW = 5


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


_SYMBOL, _POINT, _BANG = _class("#*$%&|<>"), _class(".,;:?"), _class("!")
_DIGIT, _UPPER = _class("0123456789"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class("abcdefghijklmnopqrstuvwxyz")
_STOP = _class(".?!")


def _repeated(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the (row, hash) pairs are there twice or more."""
    key = K.mix(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(row), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(COUNTS by name, FEATURES as a matrix) of the documents data[offsets[i]:offsets[i + 1]]."""
    n = len(offsets) - 1

    def totals(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    w = K.words(data, offsets)
    n_words = np.bincount(w.row, minlength=n)
    heads = (data & 0xC0) != 0x80  # first bytes of characters
    upto = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(heads, out=upto[1:])
    n_chars = upto[offsets[1:]] - upto[offsets[:-1]]
    lengths = upto[w.end] - upto[w.start]
    word_chars = np.bincount(w.row, weights=lengths, minlength=n).astype(np.int64)
    symbol = _SYMBOL[data]
    n_symbols = totals(symbol)

    # lines: cut at \n and at documents' ends; those with a word, equal to an earlier one
    newline = data == 0x0A
    begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(newline) + 1]))
    begins = begins[begins < len(data)]
    limits = np.append(begins[1:], len(data))
    ends = np.where(newline[limits - 1], limits - 1, limits) if len(begins) else limits[:0]
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, begins)
    begins, ends = begins[has_word], ends[has_word]
    line_row = np.searchsorted(offsets, begins, side="right") - 1
    line_hash = K.mix(K.span_hashes(data, begins, ends) ^ (line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, first = np.unique(line_hash, return_index=True)
    n_lines = np.bincount(line_row, minlength=n)
    n_dup_lines = n_lines - np.bincount(line_row[first], minlength=n)

    # words in windows that are there twice or more
    ahead = np.cumsum(n_words)[w.row] - np.arange(len(w.row))
    at = np.flatnonzero(ahead >= REPEAT_WINDOW)
    acc = np.zeros(len(at), dtype=np.uint64)
    for k in range(REPEAT_WINDOW):
        acc = K.mix(acc * np.uint64(0x2545F4914F6CDD1D) + w.hash[at + k])
    edge = np.zeros(len(w.row) + 1, dtype=np.int32)
    twice = at[_repeated(w.row[at], acc)]
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + REPEAT_WINDOW, -1)
    n_repeat_words = np.bincount(w.row[np.cumsum(edge[:-1]) > 0], minlength=n)

    # distinct words and the most frequent one
    key = K.mix(w.hash ^ (w.row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    _, first, runs = np.unique(key, return_index=True, return_counts=True)
    distinct = np.bincount(w.row[first], minlength=n)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, w.row[first], runs)

    ends_in = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(symbol, out=ends_in[1:])
    with_symbol = np.bincount(w.row[ends_in[w.end] > ends_in[w.start]], minlength=n)
    upper = _UPPER[data]
    many = lambda flags: np.bincount(w.row[flags], minlength=n)
    plain = upper | _LOWER[data] | _DIGIT[data] | symbol | _POINT[data] | _BANG[data] | (data <= 0x20) | (data >= 0x80)
    chars, some = np.maximum(n_chars, 1), np.maximum(n_words, 1)
    features = np.column_stack([
        np.log1p(n_words), word_chars / some, n_symbols / chars, totals(upper) / chars, totals(_DIGIT[data]) / chars, totals(_POINT[data]) / chars, totals(_BANG[data]) / chars, totals(~plain) / chars,
        totals(heads & (data >= 0x80)) / chars, n_lines / some, n_dup_lines / np.maximum(n_lines, 1), n_repeat_words / some, distinct / some, top / some, many(upper[w.start]) / some, many(lengths <= 3) / some, many(lengths >= 12) / some, with_symbol / some,
        np.log1p(n_words / np.maximum(totals(_STOP[data]), 1)), np.log1p(n_words / np.maximum(n_lines, 1)),
    ])
    counts = dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), strict=True))
    return counts, features


def statistics_batches(keep: Sequence[str] = ()):
    """Arrow batches of (doc_id, text, ...) to SCHEMA and the columns to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.string_parts(batch.column("text"))
            for lo, hi in K.slices(offsets):
                counts, features = statistics(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, features.size + 1, len(FEATURES), dtype=np.int32)), pa.array(features.ravel()))
                columns = [batch.column("doc_id").slice(lo, hi - lo), *[pa.array(counts[c].astype(np.int64)) for c in COUNTS], lists]
                yield pa.RecordBatch.from_arrays([*columns, *[batch.column(c).slice(lo, hi - lo) for c in keep]], names=["doc_id", *COUNTS, "features", *keep])

    return run


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """SCHEMA for every document, and the columns to keep; a null text is an empty one, other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(statistics_batches(keep), SCHEMA + "".join(f", {c} {dict(docs.dtypes)[c]}" for c in keep))


def matrix(column: pa.Array) -> np.ndarray:
    """A features column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES)) if len(column) else np.zeros((0, len(FEATURES)))


def labelled(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(doc_id, features, label) of documents that have a label; several labels of one id are averaged."""
    known = labels.select("doc_id", F.col(label_col).cast("double").alias("label")).filter("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    return stats.select("doc_id", "features").join(known, "doc_id")


def bounded(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled rows: those that come first by a hash of their id."""
    return rows.orderBy(F.xxhash64("doc_id", F.lit("train")), "doc_id").limit(limit) if rows.limit(limit + 1).count() > limit else rows
