from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from candlespark.llm import boosted_rules, docstats, huffman, kernel_classifier, licences, packing, pseudonyms, token_files, warc
from tests.llm import cases


@pytest.fixture(scope="module")
def rows():
    return cases.corpus(seed=2)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, cases.DOCS)


@pytest.fixture(scope="module")
def labels(spark, rows):
    marked = [(r[0], int(not re.search(r"###|\$\$\$", r[1] or "")), 0) for r in rows if r[0] is not None] + [(None, 1, 0), (9, None, 0)]
    return spark.createDataFrame(marked, "doc_id long, quality int, toxic int")


def base(text):
    w, t = cases.words(text), text or ""
    repeats = cases.repeated_words(text)
    failed = len(w) < 10 or 100 * repeats > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), cases.duplicate_lines(text), repeats, failed


def test_rules_match_brute_force(docs, rows, labels):
    got = boosted_rules.quality_rules(docs, labels).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((r[0], *base(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in boosted_rules.quality_rules(docs, none).collect())
    assert boosted_rules.quality_rules(spark.createDataFrame([], cases.DOCS), none).count() == 0
    assert {r.score for r in kernel_classifier.quality_scores(docs, none).collect()} == {0.5}
    assert kernel_classifier.quality_scores(spark.createDataFrame([], cases.DOCS), none).count() == 0


def test_forest_is_monotonic_and_flat_scoring_equals_a_walk():
    rng = np.random.default_rng(0)
    x = rng.random((600, len(docstats.FEATURES)))
    y = ((x[:, 2] < 0.5) ^ (rng.random(600) < 0.1)).astype(float)
    forest = boosted_rules.grow(x, y, boosted_rules.MONOTONE, trees=20)

    def walk(row):
        total = forest.bias
        for t in range(len(forest.feature)):
            i = 0
            for _ in range(forest.depth):
                i = 2 * i + 1 + int(row[forest.feature[t, i]] > forest.threshold[t, i])
            total += forest.value[t, i]
        return total

    assert np.allclose(forest.margin(x), [walk(r) for r in x])
    assert ((forest.score(x) > 0.5) == (x[:, 2] < 0.5)).mean() > 0.95
    for name, sign in boosted_rules.MONOTONE.items():
        grid = np.repeat(x[:50], 30, axis=0)
        grid[:, docstats.FEATURES.index(name)] = np.tile(np.linspace(0, 1, 30), 50)
        steps = np.diff(forest.margin(grid).reshape(50, 30), axis=1)
        assert (steps * sign >= -1e-9).all()


def test_long_texts_hash_as_short_ones():
    """A text beyond a slice has the same words and statistics as its repetitions say."""
    text = ("wort für wort\n" * 400_000).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    counts, _ = docstats.statistics(data, np.array([0, len(data)]))
    assert counts["n_words"][0] == 1_200_000 and counts["n_dup_lines"][0] == 399_999 and counts["n_repeat_words"][0] == 1_200_000
    assert counts["word_chars"][0] == 400_000 * 11


def test_scores_are_learnt_and_held_out(docs, rows, labels):
    got = kernel_classifier.quality_scores(docs, labels).collect()
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((r[0], zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert kernel_classifier.accepted_documents(docs, labels).columns == docs.columns


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    found = kernel_classifier.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    marked = found.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in marked) >= 0.9 * len(marked)


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    raw = rng.random(500)
    xs, ys = kernel_classifier.isotonic(raw, (rng.random(500) < raw).astype(float))
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and abs(np.interp(0.5, xs, ys) - 0.5) < 0.2


@pytest.mark.parametrize("distinct", [3, 40, 10_000])
def test_isotonic_equals_the_plain_formula(distinct):
    """At each raw score, the greatest over left ends of the least mean up to any right end."""
    rng = np.random.default_rng(distinct)
    raw = rng.integers(0, distinct, 120) / distinct
    y = (rng.random(120) < raw).astype(float)
    points = sorted(set(raw))
    mean = {p: max(min(y[(raw >= a) & (raw <= b)].mean() for b in points if b >= p) for a in points if a <= p) for p in points}
    xs, ys = kernel_classifier.isotonic(raw, y)
    for p in points:
        same = np.isin(raw, [q for q in points if abs(mean[q] - mean[p]) < 1e-12])
        assert abs(np.interp(p, xs, ys) - (y[same].sum() + 0.5 * y.mean()) / (same.sum() + 0.5)) < 1e-12


def test_copies_with_both_labels_score_their_rate():
    raw, y = np.repeat([0.2, 0.5, 0.9], [10, 40, 10]), np.concatenate([np.zeros(10), np.tile([0.0, 1.0], 20), np.ones(10)])
    xs, ys = kernel_classifier.isotonic(raw, y)
    assert abs(np.interp(0.5, xs, ys) - 0.5) < 1e-9


def test_summed_equations_equal_a_direct_solve(spark):
    rng = np.random.default_rng(3)
    x = rng.random((900, len(docstats.FEATURES)))
    y = (x[:, 0] + 0.3 * rng.random(900) > 0.6).astype(float)
    rows = spark.createDataFrame([(i, list(map(float, a)), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "doc_id long, features array<double>, label double").repartition(7)
    model = kernel_classifier.fit(rows, waves=24, ridge=1e-2)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, x.std(axis=0))
    folds = rows.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'fold'), 5) AS fold").collect()
    learnt = sorted(r.doc_id for r in folds if r.fold > 0)
    z = model.lift(x[learnt])
    penalty = np.diag([0.0] + [1e-2 * len(learnt)] * (z.shape[1] - 1)) + 1e-9 * np.eye(z.shape[1])
    assert np.allclose(model.beta, np.linalg.solve(z.T @ z + penalty, z.T @ y[learnt]), atol=1e-8)
    # ridge as least squares over the rows and one row for each penalty
    direct, *_ = np.linalg.lstsq(np.vstack([z, np.sqrt(penalty)]), np.concatenate([y[learnt], np.zeros(z.shape[1])]), rcond=None)
    assert np.allclose(model.beta, direct, atol=1e-6)


@pytest.mark.parametrize("n_ids", [1, 2, 3, 50, 5000])
def test_huffman_round_trip(n_ids):
    rng = np.random.default_rng(n_ids)
    ids = np.minimum(rng.geometric(0.05 if n_ids > 2 else 0.6, 40_000) - 1, n_ids - 1).astype(np.uint32)
    counts = np.bincount(ids, minlength=n_ids)
    lengths = huffman.code_lengths(counts)
    assert sum(2.0 ** -int(n) for n in lengths[lengths > 0]) <= 1 and lengths.max() <= huffman.MAX_BITS
    code = huffman.Code(lengths)
    for part in (ids[:0], ids[:1], ids[:255], ids[:256], ids[:257], ids):
        payload, checkpoints = code.encode(part)
        assert (code.decode(payload, checkpoints, len(part)) == part).all()


def test_limited_lengths_are_optimal():
    """Against all length vectors of a small alphabet."""
    import itertools

    rng = random.Random(5)
    for _ in range(20):
        counts = np.array([rng.randint(1, 60) ** 2 for _ in range(5)])
        best = min(sum(c * n for c, n in zip(counts, ls, strict=True)) for ls in itertools.product(range(1, 4), repeat=5) if sum(2.0**-n for n in ls) <= 1)
        assert int(huffman.code_lengths(counts, 3) @ counts) == best


def test_token_files_round_trip(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    manifest, lengths = token_files.write_token_files(docs, path, end_id=2)
    got = token_files.read_token_files(manifest, lengths).orderBy("start").collect()
    ids = [(r[0], [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    decoded = token_files.decode_token_files(manifest, lengths).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in decoded) == Counter((d, tuple(x)) for d, x in ids)


@pytest.mark.parametrize("text", ["a  b", "a   b", "  a", "a  ", "a \n b", "a\n\n b", "\n a", "x<|endoftext|>y", "it's we'll", " ", "", "a  b", "1 2  3\t 4", "über straße　   z", "foo.\nBar baz"])
def test_encoder_equals_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = np.frombuffer(token_files.Encoder(path, 2).encode([text])[0], "<u2").tolist()
    assert ids == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]


def test_token_files_of_an_empty_table(spark):
    import public_tokenizers

    manifest, lengths = token_files.write_token_files(spark.createDataFrame([], cases.DOCS), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(manifest, lengths).count() == 0


def test_archives_round_trip(spark):
    big = "<p>" + "ö" * 600 + "</p>"
    pages = [(1, "http://a/", big, "x"), (2, "http://b/\r\nX: y", big, "x"), (3, None, big, "x"), (3, None, big, "x"), (4, "u", "small", "x"), (5, "u", "small", "x"), (6, "u", None, "x"), (7, "u", "", "x"), (None, "n", big, "x"), (8, "v", "z" * 999, "x"), (9, "v", "z" * 999, "x"), (10, "v", "y" * 1000, "x"), (11, "v", "y" * 1000, "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, digest string")
    got = warc.resolved(warc.write_archives(table)).collect()
    import hashlib

    expected, done = Counter(), set()
    for page_id, url, html, _ in pages:
        raw = (html or "").encode()
        best = max((p[0] for p in pages if p[2] == html and p[0] is not None), default=None)
        # repeated rows of the response's page are revisits too
        revisit = len(raw) >= 1000 and (page_id != best or html in done)
        done |= {html} if page_id == best else set()
        expected[(page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected
    assert warc.resolved(warc.write_archives(spark.createDataFrame([], table.schema))).count() == 0


@pytest.mark.parametrize("cut", ["in a record", "after a record"])
def test_archives_cut_short_are_refused(spark, tmp_path, cut):
    table = spark.createDataFrame([(i, "u", "x" * i) for i in range(900, 1100)], "page_id long, url string, html string").coalesce(1)
    written = warc.write_archives(table, folder=f"file://{tmp_path}")
    assert len({r.record_id for r in written.mapInArrow(warc.read_archives(payloads=True), warc.RECORDS).collect()}) == 200
    (archive,) = tmp_path.glob("*.warc.gz")
    raw = archive.read_bytes()
    archive.write_bytes(raw[:-7] if cut == "in a record" else raw[: raw.rfind(b"\x1f\x8b\x08")])
    with pytest.raises(Exception, match="the archive ends within a record" if cut == "in a record" else "199 records, not 200"):
        warc.resolved(written).collect()


def test_long_payloads_go_through_whole(spark):
    html = "é<p>" * 3_000_000
    got = warc.resolved(warc.write_archives(spark.createDataFrame([(1, "u", html), (2, "v", html)], "page_id long, url string, html string"))).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [(1, 15_000_000, "revisit", 2), (2, 15_000_000, "response", None)]


def test_boundaries_are_optimal():
    import itertools

    rng = random.Random(8)
    for _ in range(60):
        lengths = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 5)

        def cost(ends, lengths=lengths, counts=counts):
            return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts, strict=True))

        options = [(*c, lengths[-1]) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1)]
        assert cost(packing.boundaries(lengths, counts, k)) == min(map(cost, options))


def test_batches_hold_their_budget(docs, rows, spark):
    got = packing.pack(docs, buckets=4, batch_tokens=500).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r[0], len(cases.words(r[1]))) for r in rows)
    batches = {}
    for r in got:
        assert 0 <= r.padding == r.bucket_tokens - r.n_tokens
        batches.setdefault((r.bucket, r.bucket_tokens, r.batch), []).append(r.place)
    short = Counter()
    for (bucket, size, _), places in batches.items():
        room = max(1, 500 // max(size, 1))
        assert sorted(places) == list(range(len(places))) and len(places) <= room
        short[bucket] += len(places) < room
    assert max(short.values()) <= 1
    assert packing.pack(spark.createDataFrame([], cases.DOCS)).count() == 0


def test_long_lengths_are_exact(spark):
    lengths = [3, 70_001, 70_001, 70_003, 200_001, 200_017]
    docs = spark.createDataFrame([(i, "a " * n, "x") for i, n in enumerate(lengths)], "doc_id long, text string, bucket string")
    got = sorted((r.n_tokens, r.bucket_tokens, r.padding) for r in packing.pack(docs, buckets=3).collect())
    assert got == [(3, 3, 0), (70_001, 70_003, 2), (70_001, 70_003, 2), (70_003, 70_003, 0), (200_001, 200_017, 16), (200_017, 200_017, 0)]


PRIVATE = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005"],
    "phone": ["+1 (389) 555-5010", "212-555-0187", "(212) 555-0187"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["2024-02-29", "31/12/1999", "01.02.2003"],
    "ipv4": ["192.168.0.1", "8.8.8.8"],
    "email": ["the.99@mail9.example.com"],
    "secret": ["0123456789abcdef0123456789abcdef01234567"],
}
NOT_PRIVATE = ["4111111111111112", "2024-02-30", "999.1.1.1", "666-45-6789", "DE88370400440532013000", "0000000000000000", "version 2.0.1", "2024", "deadbeef"]


def test_pseudonyms_keep_their_format_and_invert():
    forth, back = pseudonyms.Pseudonymiser(b"k"), pseudonyms.Pseudonymiser(b"k", back=True)
    for kind, values in PRIVATE.items():
        for value in values:
            text, counts = forth.rewrite(f"Call {value}, now.")
            new = text.removeprefix("Call ").removesuffix(", now.")
            assert counts == {kind: 1} and new != value
            if kind != "ipv4":
                assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", new))) == re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", value))) or kind == "secret"
            assert back.rewrite(text)[0] == f"Call {value}, now."
    linked = [re.sub(r"\D", "", forth.rewrite(v)[0]) for v in PRIVATE["card"][:2]]
    assert linked[0] == linked[1]
    for value in NOT_PRIVATE:
        assert forth.rewrite(f"see {value} there")[0] == f"see {value} there"


def random_value(kind, rng):
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "card":
        while True:
            body = rng.choice("345") + d(14)
            if len(set(body)) > 1:
                return body + pseudonyms.luhn_digit(body)
    if kind == "iban":
        account = d(18)
        return "DE" + pseudonyms.iban_check("DE", account) + account
    if kind == "ssn":
        return f"{rng.choice([a for a in range(1, 900) if a != 666]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
    if kind == "phone":
        return f"{rng.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}"
    if kind == "date":
        return f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    if kind == "ipv4":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "email":
        return f"{rng.choice('abcxyz')}{d(6)}.{rng.choice('abcxyz')}@mail.example.com"
    return "".join(rng.choice("0123456789abcdef") for _ in range(39)) + "0a"


@pytest.mark.parametrize("kind", pseudonyms.KINDS)
def test_ten_thousand_values_invert_and_stay_apart(kind):
    rng, forth, back = random.Random(kind), pseudonyms.Pseudonymiser(b"k"), pseudonyms.Pseudonymiser(b"k", back=True)
    values = {random_value(kind, rng) for _ in range(10_000)}
    images = {v: forth.rewrite(v) for v in values}
    assert all(counts == {kind: 1} for _, counts in images.values())
    assert len({new for new, _ in images.values()}) == len(values)
    assert all(back.rewrite(new)[0] == v for v, (new, _) in images.items())


def test_documents_equal_their_values_replaced_one_by_one(spark):
    """A plain version: words stay and each value among them becomes what it becomes alone."""
    rng, alone = random.Random(12), pseudonyms.Pseudonymiser(b"k")
    rows, expected = [], {}
    for i in range(300):
        parts = [rng.choice(["see", "and", "über", "n. 7,", "v2.0;", "(x)"]) if rng.random() < 0.7 else random_value(rng.choice(pseudonyms.KINDS), rng) for _ in range(rng.randint(0, 40))]
        parts = [p for pair in zip(parts, ["then"] * len(parts), strict=True) for p in pair]  # so that no value stands beside another
        rows.append((i, " ".join(parts)))
        expected[i] = " ".join(alone.rewrite(p)[0] if any(c.isdigit() for c in p) else p for p in parts)
    got = pseudonyms.pseudonyms(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()
    assert {r.doc_id: r.text for r in got} == expected
    assert pseudonyms.pseudonyms(spark.createDataFrame([], "doc_id long, text string"), b"k").count() == 0


def test_a_directory_takes_time_in_proportion():
    import time

    line = "Call 212-555-0187 or 2024-02-29. "
    took = []
    for n in (1_000, 10_000):
        began = time.process_time()
        assert pseudonyms.Pseudonymiser(b"k").rewrite(line * n)[1] == {"phone": n, "date": n}
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0]


def test_feistel_is_a_permutation():
    f = pseudonyms.Feistel(b"key")
    for n in (1, 2, 3, 10, 97, 1000):
        image = [f.permute("x", n, i) for i in range(n)]
        assert sorted(image) == list(range(n))
        assert [f.permute("x", n, i, back=True) for i in image] == list(range(n))


def test_pseudonyms_of_documents(docs, rows, spark):
    mail = spark.createDataFrame([(1, "mail the.99@mail9.example.com", "x"), (2, None, "x"), (3, "", "x"), (1, "mail the.99@mail9.example.com", "x")], "doc_id long, text string, n_found string")
    got = pseudonyms.pseudonyms(mail, b"k").collect()
    assert sorted((r.doc_id, r.n_found, r.text is None) for r in got) == [(1, 1, False), (1, 1, False), (2, 0, True), (3, 0, False)]
    assert Counter((r.doc_id, r.text) for r in pseudonyms.pseudonyms(docs, b"k").filter("n_found = 0").collect()) <= Counter((r[0], r[1]) for r in rows)


MIT = """Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


@pytest.mark.parametrize(
    ("text", "ids", "names"),
    [
        (None, "", ""),
        ("", "", ""),
        ("software without terms", "", ""),
        (MIT, "MIT_GRANT;MIT_NOTICE", "MIT"),
        ("no end mark\nReleased under the MIT License.\nmore", "MIT_SHORT", "MIT"),
        ("Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.", "APACHE_SHORT;CC_BY_NC_4", "Apache-2.0;CC-BY-NC-4.0"),
        ("Released under the MIT License. Released under the MIT License.", "MIT_SHORT;MIT_SHORT", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL_3_SHORT", "GPL-3.0-only"),
        ("See the GNU General Public License for more details.", "GPL_SEE", "GPL"),
    ],
)
def test_licences(spark, text, ids, names):
    table = spark.createDataFrame([(1, text, "ids", "left"), (1, text, "ids", "left")], "doc_id long, text string, ids string, `left` string")
    got = licences.licence_scan(table).collect()
    assert [(r.sentence_ids, r.licences, r.n_licences) for r in got] == [(ids, names, len(names.split(";")) if names else 0)] * 2


def test_every_known_sentence_can_be_found():
    import inspect

    assert inspect.isfunction(licences.known_sentences)
    for said in licences.SENTENCES.values():
        assert re.search(licences.TRIGGER, said) and re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", said)
    assert {n.strip("()?") for _, rule in licences.RULES for item in rule.split() for n in item.split("|")} <= set(licences.SENTENCES)


GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def scanned(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.sentence_ids, r.licences) for r in licences.licence_scan(table).orderBy("doc_id").collect()]


def test_licences_in_their_original_wording(spark):
    expected = {
        "SPDX-License-Identifier: MIT": ("MIT_SPDX", "MIT"),
        "# SPDX-License-Identifier: Apache-2.0\nimport os\n": ("APACHE_SPDX", "Apache-2.0"),
        "SPDX-License-Identifier: MIT OR Foo": ("", ""),
        GPL.format(":", 3): ("GPL_3_GRANT;GPL_WARRANTY;GPL_SEE;GPL_COPY", "GPL-3.0-or-later"),
        GPL.format(";", 2): ("GPL_2_GRANT;GPL_WARRANTY;GPL_SEE;GPL_COPY", "GPL-2.0-or-later"),
        APACHE: ("APACHE_GRANT_COMPLY;APACHE_COPY;APACHE_AS_IS;APACHE_SEE", "Apache-2.0"),
        MPL: ("MPL_2", "MPL-2.0"),
        "  Released under the\n\nMIT License.": ("", ""),
    }
    assert scanned(spark, expected) == list(expected.values())
    assert [ids for ids, _ in scanned(spark, licences.SENTENCES.values())] == list(licences.SENTENCES)


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
ENDORSE = """3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement: This product includes software
   developed by the University.
"""


def test_licences_in_comments_and_with_names(spark):
    leads = ["# ", " * ", "// ", ";; ", "-- ", ""]
    texts = ["\n".join((lead + line).rstrip() for line in MIT.split("\n")) for lead in leads]
    assert scanned(spark, texts) == [("MIT_GRANT;MIT_NOTICE", "MIT")] * len(texts)
    bsd = "BSD_GRANT;BSD_SOURCE;BSD_BINARY;"
    expected = {
        "MIT License\n" + MIT.split("\n\n")[1]: ("MIT_GRANT", "MIT"),
        MPL + "\nReleased under the MIT License\nLicensed under CC BY 4.0\n": ("MPL_2;MIT_SHORT;CC_BY_4", "MIT;CC-BY-4.0;MPL-2.0"),
        BSD.format("", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"): (bsd + "BSD_AS_IS", "BSD-2-Clause"),
        BSD.format(ENDORSE.format("Google Inc."), "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"): (bsd + "BSD_ENDORSE;BSD_AS_IS", "BSD-3-Clause"),
        BSD.format(ENDORSE.format("the copyright holder"), "THE REGENTS AND CONTRIBUTORS"): (bsd + "BSD_ENDORSE;BSD_AS_IS", "BSD-3-Clause"),
        BSD.format(ADVERT + ENDORSE.format("the University"), "THE REGENTS AND CONTRIBUTORS"): (bsd + "BSD_ADVERT;BSD_ENDORSE;BSD_AS_IS", "BSD-4-Clause"),
        "// SPDX-License-Identifier: GPL-2.0-or-later": ("GPL_2_LATER_SPDX", "GPL-2.0-or-later"),
        "/* SPDX-License-Identifier: BSD-3-Clause */": ("BSD_3_SPDX", "BSD-3-Clause"),
    }
    assert scanned(spark, expected) == list(expected.values())


BESIDE = {  # text: kind, and what stays of it
    "4111 1111 1111 1111 12/25": ("card", r"\d{4} \d{4} \d{4} \d{4} 12/25"),
    "4111111111111111 123": ("card", r"\d{16} 123"),
    "no 7 4111111111111111": ("card", r"no 7 \d{16}"),
    "12 34 4111 1111 1111 1111": ("card", r"12 34 \d{4} \d{4} \d{4} \d{4}"),
    "378282 246310005 99 1": ("card", r"\d{6} \d{9} 99 1"),
    "BE68 5390 0754 7034 BIC GEBABEBB": ("iban", r"BE\d\d \d{4} \d{4} \d{4} BIC GEBABEBB"),
    "BE68539007547034 EUR 20": ("iban", r"BE\d{14} EUR 20"),
    "AB12 CDEF GHIJ BE68539007547034": ("iban", r"AB12 CDEF GHIJ BE\d{14}"),
    "due 12/25/2020": ("date", r"due (0\d|1[0-2])/(1[3-9]|[23]\d)/\d{4}"),
    "+15551234567": ("phone", r"\+1\d{10}"),
    "5551234567": ("phone", r"[2-9]\d{9}"),
    "+44 20 7946 0958": ("phone", r"\+44 \d\d \d{4} \d{4}"),
    "+45 32 12 34 56": ("phone", r"\+45( \d\d){4}"),
    "+15551234567 2024-01-02": ("phone", r"\+1\d{10} \d{4}-\d\d-\d\d"),
}


def test_pseudonyms_beside_other_digits_and_capitals():
    for key in (b"k", b"l", b"m"):
        forth, back = pseudonyms.Pseudonymiser(key), pseudonyms.Pseudonymiser(key, back=True)
        for text, (kind, stays) in BESIDE.items():
            new, counts = forth.rewrite(text)
            assert counts[kind] == 1 and new != text and re.fullmatch(stays, new), (text, new)
            assert back.rewrite(new)[0] == text
        two = forth.rewrite("4111 1111 1111 1111 5500 0000 0000 0004")
        assert two[1] == {"card": 2} and two[0][:19] == forth.rewrite("4111 1111 1111 1111")[0]
        assert forth.rewrite("BE68 5390 0754 7034 BE68539007547034")[1] == {"iban": 2}
    for value in ("1697209500", "13/13/2020", "5551234567.5", "+12345"):
        assert forth.rewrite(f"see {value} there")[0] == f"see {value} there"
