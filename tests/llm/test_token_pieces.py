"""Looking up the pieces of many texts at once, against the library text by text."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from candlespark.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", " ", "\n", "\t", " ", "　", "\x1c", "\x1f", "\x85", "​", "a", "B", "é", "ß", "23", "'s", "'ll", ".", ",", "!!", "<|endoftext|>", "漢", "́", "\U0001f600", "ab", "the", "\r\n", "_", "٣", "\x00"]


def library(texts):
    return [[*e.ids, 2] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def numbers(blobs):
    return [np.frombuffer(b, "<u2").tolist() for b in blobs]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_many_texts_at_once_equal_the_library(kind, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 40)
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(4_000)]
    encoder = token_files.Encoder(PATH, 2)
    assert numbers(encoder.blobs(pa.array(["x", *texts], kind).slice(1)).to_pylist()) == library(texts)
    assert all(len(half) <= 20 for pieces in (encoder.spaced, encoder.bare) for half in (pieces.recent, pieces.older))


def test_special_tokens_across_lines_and_spaces(tmp_path):
    tokenizer, path = Tokenizer.from_file(PATH), str(tmp_path / "tokenizer.json")
    tokenizer.add_special_tokens(["<a>\n<b>", "<c> <d>"])
    tokenizer.save(path)
    texts = ["x <a>\n<b> y", "one\ntwo", "x <c> <d>.\ny", "", "<a>\n<c> <d", "x\n\ny z"]
    expected = [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert numbers(token_files.Encoder(path, 2).encode(texts)) == expected


def test_a_word_goes_to_the_model_once_whatever_stands_behind_it():
    encoder, asked = token_files.Encoder(PATH, 2), []
    model = encoder.tokenize
    encoder.tokenize = lambda shown: asked.append(shown) or model(shown)
    text = "so querulant. querulant, querulant! querulant\nand querulant"
    assert numbers(encoder.encode([text])) == library([text])
    assert sum("querulant" in shown for shown in asked) == 1


def test_ids_are_counted_as_they_are_made(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES", 50)
    texts = ["one two", None, "", "three\nfour five. " * 30, "six  seven", "<|endoftext|>"]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(6), pa.int64()), "text": pa.array(texts)})]
    rows = [r for b in token_files.tokenised(PATH, 2)(iter(batches)) for r in b.to_pylist()]
    ids = library([t or "" for t in texts])
    assert [(r["doc_id"], r["n_tokens"], r["counts"]) for r in rows[:-1]] == [(i, len(x), None) for i, x in enumerate(ids)]
    assert numbers(r["ids"] for r in rows[:-1]) == ids
    assert np.frombuffer(rows[-1]["counts"], np.int64).tolist() == np.bincount(np.concatenate(ids)).tolist()
    assert list(token_files.tokenised(PATH, 2)(iter([]))) == []
