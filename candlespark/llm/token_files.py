"""Token ids in Huffman-coded files: tokenise, count, code, write in id order, read back."""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlespark.llm import huffman
from candlespark.llm.staging import scratch, staged

#: Ids of a block, about; memory of encoding and decoding follows it.
BLOCK_IDS = 1 << 18
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 900_000
#: Bytes of coded ids in a file, about.
FILE_BYTES = 64 << 20

#: Bytes of text whose pieces are looked up at a time, and of the Arrow batches that bring them (and a row more).
TEXT_BYTES = 8 << 20
BATCH_BYTES = TEXT_BYTES * 7 // 8
#: Characters of the longest piece that is remembered.
LONGEST = 64

TOKENS = "doc_id long, n_tokens long, ids binary, counts binary"
MANIFEST = "part int, path string, n_tokens long, n_docs long"
READ = "path string, doc_id long, at long, n_tokens long, ids_crc32 long"

#: Marks that, behind letters, are one piece of their own however many they are.
_MARKS = ".,;:!?#$%&*|"


def id_type(largest: int) -> str:
    """How ids are held between tasks."""
    return "<u2" if largest < 1 << 16 else "<u4"


class Pieces:
    """Ids of pieces of text by piece, each with ``before`` in front; what is missing is encoded.

    Letters and the marks behind them are single pieces to the tokenizer's
    splitting, so they go straight to its model; everything else goes through
    the tokenizer. What was asked for lately is remembered in two halves: a full
    one takes the place of the older, so frequent pieces stay.
    """

    def __init__(self, encoder: Encoder, before: str) -> None:
        self.encoder, self.before = encoder, before
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getitem__(self, piece: str) -> bytes:
        ids = self.recent.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = self.made(piece)
            if len(piece) <= LONGEST:
                if len(self.recent) >= REMEMBERED // 2:
                    self.older, self.recent = self.recent, {}
                self.recent[piece] = ids
        return ids

    def all(self, pieces: list[str]) -> list[bytes]:
        """The ids of many pieces."""
        found = list(map(self.recent.get, pieces))
        encoder, code, tokenize = self.encoder, self.encoder.code, self.encoder.tokenize
        before = encoder.shown[32] if self.before else ""
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            # most of what is missing are letters: as __getitem__ does, without its calls
            if piece.isascii() and piece.isalpha() and len(piece) <= LONGEST and len(self.recent) < REMEMBERED // 2:
                ids = self.older.get(piece)
                if ids is None:
                    ids = array(code, [t.id for t in tokenize(before + piece)]).tobytes()
                found[i] = self.recent[piece] = ids
            else:
                found[i] = self[piece]
        return found

    def made(self, piece: str) -> bytes:
        encoder, before = self.encoder, self.before
        if piece.isalpha():
            return encoder.letters(before, piece)
        word = piece.rstrip(_MARKS)
        if word.isalpha():
            return self[word] + encoder.marks(piece[len(word) :])
        return encoder.whole([before + piece])[0]


class Encoder:
    """Ids of texts by a tokenizer file, remembering those of pieces between spaces.

    A byte-level tokenizer with its usual splitting cuts before a single space,
    so a text's ids are those of its pieces, each with its space. Texts where a
    run of white space could cross such a cut, those that hold a special token,
    and all texts of other kinds of tokenizers are encoded whole.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = id_type(max(self.tokenizer.get_vocab_size() - 1, end_id))
        self.tokenize, self.code = self.tokenizer.model.tokenize, {"<u2": "H", "<u4": "I"}[self.dtype]
        self.end = np.array([end_id], dtype=self.dtype).tobytes()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        splits = self.tokenizer.pre_tokenizer
        self.by_piece = isinstance(splits, pre_tokenizers.ByteLevel) and splits.use_regex and not splits.add_prefix_space and self.tokenizer.normalizer is None
        if self.by_piece:
            # how a byte-level vocabulary writes each byte
            shown = sorted(set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256)))
            others = iter(range(256, 512))
            self.shown = {b: chr(b) if b in shown else chr(next(others)) for b in range(256)}
            self.spaced, self.bare, self.mark_ids = Pieces(self, " "), Pieces(self, ""), {}
            self.newline = self.model("\n")

    def model(self, piece: str) -> bytes:
        """Ids of one piece, by the tokenizer's model alone."""
        return self.modelled(piece.encode().decode("latin-1").translate(self.shown))

    def modelled(self, shown: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenize(shown)]).tobytes()

    def letters(self, before: str, word: str) -> bytes:
        """model of before and letters; those of ASCII are written as they are."""
        return self.modelled((self.shown[32] if before else "") + word) if word.isascii() else self.model(before + word)

    def marks(self, piece: str) -> bytes:
        if piece not in self.mark_ids:
            if len(self.mark_ids) > 10_000:
                self.mark_ids.clear()
            self.mark_ids[piece] = self.model(piece)
        return self.mark_ids[piece]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with the end id, as little-endian numbers."""
        return self.blobs(pa.array(texts, type=pa.string())).to_pylist()

    def blobs(self, texts: pa.Array) -> pa.Array:
        """encode of an Arrow array without nulls; each distinct piece is looked up once.

        A line break between other than white space is cut out too.
        """
        if not len(texts) or not self.by_piece:
            return self.wholes(texts)
        whole = np.zeros(len(texts), dtype=bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if whole.any():
            return _merged([self.blobs(texts.filter(pa.array(~whole))), self.wholes(texts.filter(pa.array(whole)))], whole)
        lines = pc.split_pattern(texts, "\n")
        n_lines = pc.list_value_length(lines).to_numpy()
        of = np.repeat(np.arange(len(texts)), n_lines)  # each line's text
        lines = lines.flatten()
        size = pc.binary_length(lines).to_numpy()
        rough = (size == 0) | (pc.binary_length(pc.utf8_trim_whitespace(lines)).to_numpy() != size)
        uncut = np.zeros(len(texts), dtype=bool)
        uncut[of[rough]] = True
        uncut &= n_lines > 1
        if uncut.any():
            found = [self.pieced(texts.filter(pa.array(uncut)), np.ones(int(uncut.sum()), dtype=np.int64)), self.pieced(lines.filter(pa.array(~uncut[of])), n_lines[~uncut])]
            return _merged(found, ~uncut)
        return self.pieced(lines, n_lines)

    def pieced(self, lines: pa.Array, n_lines: np.ndarray) -> pa.Array:
        """The ids of texts of so many lines each, with the end id."""
        if not len(lines):
            return pa.array([], type=pa.large_binary())
        split = pc.split_pattern(lines, " ")
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        coded = split.flatten().dictionary_encode()
        at, pieces = coded.indices.to_numpy(), coded.dictionary
        firsts = starts[:-1]
        later = np.ones(len(at), dtype=bool)
        later[firsts] = False
        whole = self.not_by_piece(pieces, at, starts, later)
        last = np.cumsum(n_lines)  # behind each text's last line
        if whole.any():
            whole = np.add.reduceat(whole, last - n_lines) > 0
            of = np.repeat(whole, n_lines)
            texts = ["\n".join(_strings(lines.slice(last[i] - n_lines[i], n_lines[i]))) for i in np.flatnonzero(whole)]
            return _merged([self.pieced(lines.filter(pa.array(~of)), n_lines[~whole]), self.wholes(pa.array(texts, type=lines.type))], whole)
        spaced, place = self.looked_up(self.spaced, pieces, at[later])
        bare, first_place = self.looked_up(self.bare, pieces, at[firsts])
        values = pa.concat_arrays([spaced, bare, pa.array([self.newline, self.end], type=pa.large_binary())])
        ends = starts[1:] + np.arange(len(lines))  # where what closes each line goes
        closing = np.full(len(lines), len(values) - 2, dtype=np.int32)
        closing[last - 1] += 1
        begun = np.empty(len(at), dtype=np.int32)
        begun[later], begun[firsts] = place, first_place + len(spaced)
        order, kept = np.empty(len(at) + len(lines), dtype=np.int32), np.ones(len(at) + len(lines), dtype=bool)
        kept[ends] = False
        order[kept], order[ends] = begun, closing
        _, offsets, data = values.take(pa.array(order)).buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[np.concatenate([[0], ends[last - 1] + 1])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n_lines), [None, pa.py_buffer(bounds), data])

    def looked_up(self, known: Pieces, pieces: pa.Array, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(the ids of the distinct pieces that ``at`` names, its places in them); letters are looked up without the marks behind them."""
        used = np.zeros(len(pieces), dtype=bool)
        used[at] = True
        names = pieces.filter(pa.array(used))
        words = pc.utf8_rtrim(names, characters=_MARKS)
        n_marks = (pc.binary_length(names).to_numpy() - pc.binary_length(words).to_numpy()) * pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        foreign = np.flatnonzero((n_marks > 0) & ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
        n_marks[foreign] *= np.array([word.isalpha() for word in _strings(words.take(pa.array(foreign)))], dtype=n_marks.dtype)
        whole = pc.if_else(pa.array(n_marks > 0), words, names).dictionary_encode()
        ids = pa.array(known.all(_strings(whole.dictionary)), type=pa.large_binary()).take(whole.indices)
        # the marks, each of one byte, from the ends of the names
        bounds = np.concatenate([[0], np.cumsum(n_marks)]).astype(np.int32)
        name_ends = np.cumsum(pc.binary_length(names).to_numpy().astype(np.int64))
        _, _, data = pc.cast(names, pa.string()).buffers()
        found = np.frombuffer(data or b"", dtype=np.uint8)[np.arange(bounds[-1]) + np.repeat(name_ends - bounds[1:], n_marks)]
        marks = pa.StringArray.from_buffers(len(names), pa.py_buffer(bounds), pa.py_buffer(found)).dictionary_encode()
        behind = pa.array([self.marks(m) if m else b"" for m in _strings(marks.dictionary)], type=pa.large_binary()).take(marks.indices)
        return pc.binary_join_element_wise(ids, behind, pa.scalar(b"", pa.large_binary())), (np.cumsum(used, dtype=np.int32) - 1)[at]

    def wholes(self, texts: pa.Array) -> pa.Array:
        return pa.array([ids + self.end for text in texts.to_pylist() for ids in self.whole([text])], type=pa.large_binary())

    def not_by_piece(self, pieces: pa.Array, at: np.ndarray, starts: np.ndarray, later: np.ndarray) -> np.ndarray:
        """Which lines have a space with white space on both sides, or the end behind it."""
        out = np.zeros(len(starts) - 1, dtype=bool)
        size = pc.binary_length(pieces).to_numpy()
        odd = np.flatnonzero((size == 0) | (pc.binary_length(pc.utf8_trim_whitespace(pieces)).to_numpy() != size))
        if len(odd):
            begins, ends = np.zeros(len(pieces), dtype=bool), np.zeros(len(pieces), dtype=bool)
            for code, piece in zip(odd, _strings(pieces.take(pa.array(odd))), strict=True):
                begins[code], ends[code] = not piece or piece[0].isspace(), not piece or piece[-1].isspace()
            across = np.flatnonzero(later[1:] & begins[at[1:]] & ends[at[:-1]]) + 1
            out[np.searchsorted(starts, across, side="right") - 1] = True
        return out


def _merged(parts: list[pa.Array], second: np.ndarray) -> pa.Array:
    """The rows of two arrays, each in order, as ``second`` says which is whose."""
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.argsort(second, kind="stable"), kind="stable")))


def _strings(pieces: pa.Array) -> list[str]:
    return pieces.to_numpy(zero_copy_only=False).tolist()


@lru_cache(maxsize=1)
def encoder_of(path: str, end_id: int) -> Encoder:
    """The worker's encoder, which keeps what it remembers from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end_id)


def tokenised(path: str, end_id: int):
    """Arrow batches of (doc_id, text) to TOKENS: a row for each document, then one with how often the partition has each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, end_id)
        width = np.dtype(encoder.dtype).itemsize
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TEXT_BYTES, side="right")))
                ids = encoder.blobs(texts.slice(lo, hi - lo))
                sizes = pc.binary_length(ids).to_numpy().astype(np.int64) // width
                part = np.bincount(_numbers(ids, encoder.dtype))
                if len(part) > len(total):
                    part, total = total, part
                total[: len(part)] += part
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes), ids.cast(pa.binary()), pa.nulls(hi - lo, pa.binary())], names=["doc_id", "n_tokens", "ids", "counts"])
                lo = hi
        if len(total):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], type=pa.binary())], names=["doc_id", "n_tokens", "ids", "counts"])

    return run


def _numbers(blobs: pa.Array, dtype: str) -> np.ndarray:
    """The ids of all blobs, one after the other."""
    _, offsets, data = blobs.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[blobs.offset :]
    return np.frombuffer(data or b"", dtype=np.uint8)[bounds[0] : bounds[len(blobs)]].view(dtype)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of counts by id to (id, n), summed over the partition."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for blob in batch.column("counts"):
            part = np.frombuffer(blob.as_buffer(), dtype=np.int64)
            if len(part) > len(total):
                part, total = total, part.copy()
            total[: len(part)] += part
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "n"])


def open_shared(path: str):
    """(file system, path in it) of a URI under the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def written(lengths: np.ndarray, folder: str, dtype: str):
    """Arrow batches of sorted (doc_id, ids) to a file for each partition and MANIFEST.

    An attempt writes a file of its own name; only those in the manifest count,
    so a task that is run again leaves nothing wrong behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = huffman.Code(lengths), TaskContext.get().partitionId()
        system, base = open_shared(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.huf"
        n_tokens = n_docs = held = 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        with system.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                    doc_ids.append(doc_id)
                    ids.append(np.frombuffer(blob.as_buffer(), dtype=dtype))
                    held, n_docs = held + len(ids[-1]), n_docs + 1
                    if held >= BLOCK_IDS:
                        out.write(huffman.write_block(code, doc_ids, ids))
                        n_tokens, held, doc_ids, ids = n_tokens + held, 0, [], []
            if ids:
                out.write(huffman.write_block(code, doc_ids, ids))
                n_tokens += held
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"], "n_tokens": pa.array([n_tokens], pa.int64()), "n_docs": pa.array([n_docs], pa.int64())})

    return run


def read_files(lengths: np.ndarray):
    """Arrow batches of file paths to READ: each document's place, count and crc32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = huffman.Code(lengths)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                at, rows = 0, []
                system, name = open_shared(path)
                with system.open_input_stream(name) as stream:
                    for doc_id, ids in huffman.read_blocks(code, stream):
                        rows.append((path, doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=["path", "doc_id", "at", "n_tokens", "ids_crc32"])


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """Write the ids of all documents to files; (manifest, code lengths).

    The manifest has one row for each file: part, path, n_tokens, n_docs,
    files_before (ids of all files before it). Files and the documents in them
    ascend by identifier, null first; equal identifiers by their ids' bytes. A
    null or empty text is one end id. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    dtype = Encoder(tokenizer, end_id).dtype
    tokens = staged(rows.mapInArrow(tokenised(tokenizer, end_id), TOKENS), "tokens-ids", "zstd", BATCH_BYTES)
    counts = tokens.select("counts").filter("counts is not null").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(int(max(counts.column("id").to_numpy(), default=0)) + 1, dtype=np.int64)
    total[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    lengths = huffman.code_lengths(total)
    parts = max(1, int(lengths @ total) // 8 // FILE_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", "key"]
    ranged = tokens.filter("counts is null").select("doc_id", "ids").withColumn("key", F.xxhash64("ids")).repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids")
    out = folder or scratch(spark, "token-files")
    files = staged(ranged.select("doc_id", "ids").mapInArrow(written(lengths, out, dtype), MANIFEST), "tokens-manifest").filter("n_docs > 0")
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return staged(files.withColumn("files_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "tokens-manifest"), lengths


def read_token_files(manifest: DataFrame, lengths: np.ndarray) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, from the files of a manifest."""
    spread = manifest.select("path").repartition(max(1, manifest.count()), "path")
    found = spread.mapInArrow(read_files(lengths), READ)
    return found.join(manifest.select("path", "files_before"), "path").select("doc_id", (F.col("files_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def decode_token_files(manifest: DataFrame, lengths: np.ndarray) -> DataFrame:
    """(doc_id, ids) of every document of the files of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = huffman.Code(lengths)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = open_shared(path)
                with system.open_input_stream(name) as stream:
                    for doc_id, ids in huffman.read_blocks(code, stream):
                        yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int64).tolist()], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return manifest.select("path").mapInArrow(run, "doc_id long, ids array<long>")
