from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlespark.llm import exact_dedup, jaccard_join, mixing
from candlespark.llm.components import connected_components
from tests.llm import cases


@pytest.fixture(scope="module")
def rows():
    return cases.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, cases.DOCS)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_dedup(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    out = Counter()
    for text, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        for r in members:
            out[(r[0], keep[0], len(members), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out, len(groups)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_matches_brute_force(docs, rows, weak):
    """With a digest that clashes the bytes decide."""
    options = {"digest": lambda text: F.length(text).cast("string").cast("binary")} if weak else {}
    got = exact_dedup.exact_dedup(docs, **options).collect()
    expected, n_groups = expected_dedup(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    assert sum(r.kept for r in got) == n_groups


def test_exact_dedup_in_many_batches_is_the_same(docs, rows):
    got = exact_dedup.exact_dedup(docs.repartition(6), bytes_per_batch=1).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_dedup(rows)[0]


def test_a_state_outlives_the_call(spark, tmp_path):
    """Two calls with one state are one call over both tables; a call again changes nothing; a clash across calls is refused."""
    schema = "doc_id long, text string"
    tables = [[(1, "a b"), (2, "ab"), (3, "x")], [(4, "a  b "), (5, "y"), (6, None), (7, "x")], [(8, "ab   "), (9, "y")]]
    got, docs = [], []
    for i, rows in enumerate(tables):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{i}")
        docs.append(spark.read.parquet(f"file://{tmp_path}/{i}"))
        got.append({r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs[-1], state=f"file://{tmp_path}/state", run=f"r{i}").collect()})
    assert got[0] == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True)}
    assert got[1] == {4: (4, 3, True), 5: (5, 1, True), 6: (6, 1, True), 7: (3, 2, False)}
    assert got[2] == {8: (4, 4, False), 9: (5, 2, False)}
    again = exact_dedup.exact_dedup(docs[2], state=f"file://{tmp_path}/state", run="r2").collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again} == got[2]
    weak = {"digest": lambda text: F.length(text).cast("string").cast("binary"), "state": f"file://{tmp_path}/weak"}
    exact_dedup.exact_dedup(docs[0].filter("doc_id = 3"), **weak).collect()
    with pytest.raises(ValueError, match="digest"):
        exact_dedup.exact_dedup(docs[1].filter("doc_id = 5"), **weak)


def test_kept_documents_have_all_columns(docs, rows):
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == expected_dedup(rows)[1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], cases.DOCS)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (1, 70)])
def test_jaccard_components_match_brute_force(docs, rows, n, num):
    got = jaccard_join.jaccard_components(docs, jaccard_join.Rule(n, num, 100)).collect()
    expected = cases.components(rows, n, num)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((r[0], len(cases.shingles(r[1], n)), expected[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (1, 70)])
def test_rounds_of_pivots_lose_nothing(docs, rows, monkeypatch, n, num):
    """Leaves, chunks and pivots so few that every region takes rounds, windows and many chunks."""
    for name, value in {"LEAF_DOCS": 3, "CHUNK_DOCS": 5, "PIVOTS": 2, "GROWTH": 1}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    stats = {}
    got = jaccard_join.jaccard_components(docs, jaccard_join.Rule(n, num, 100), stats=stats).collect()
    expected = cases.components(rows, n, num)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((r[0], expected[i]) for i, r in enumerate(rows))
    assert stats["rounds"]


def test_very_long_texts_take_rounds_of_their_own(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF_SHINGLES", 300)
    got = jaccard_join.jaccard_components(docs, jaccard_join.Rule(3, 90, 100)).collect()
    expected = cases.components(rows, 3, 90)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((r[0], expected[i]) for i, r in enumerate(rows))


def drifting_copies(k: int, seed: int) -> list[tuple[int, str]]:
    """Copies of one text with up to 14 % of its words changed: some link with it, some only with each other, some with none."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    rows, chain = [], list(base)
    for i in range(k):
        copy = list(chain if i % 10 == 9 else base)
        for _ in range(rng.randint(0, 28 if i % 3 else 10)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        if i % 10 == 9:
            chain = copy  # each is a near copy of the one before
        rows.append((i, " ".join(copy)))
    return rows


def test_a_group_of_five_thousand_near_copies(spark):
    """Pivots part a group that no task holds whole; brute force over 1-word sets agrees."""
    rows, stats = drifting_copies(5000, 7), {}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, jaccard_join.Rule(1, 80, 100), stats=stats).collect()}
    names = {w: i for i, w in enumerate(dict.fromkeys(w for _, t in rows for w in t.split()))}
    held = np.zeros((len(rows), 201), dtype=np.float32)  # base words, and how many others
    others = [frozenset(names[w] for w in t.split() if w[0] == "x") for _, t in rows]
    for i, (_, t) in enumerate(rows):
        for w in t.split():
            if w[0] == "w":
                held[i, int(w[1:])] = 1
    sizes = held.sum(axis=1) + np.array([len(o) for o in others])
    by_word = {}
    for i, o in enumerate(others):
        for x in o:
            by_word.setdefault(x, []).append(i)
    shared = held @ held.T
    for members in by_word.values():
        for i in members:
            for j in members:
                shared[i, j] += 1
    linked = 100 * shared >= 80 * (sizes[:, None] + sizes[None, :] - shared)
    label = np.arange(len(rows))
    while True:
        least = np.where(linked, label[None, :], len(rows)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    assert [got[i] for i in range(len(rows))] == label.tolist()
    assert len(set(label.tolist())) > 1
    assert stats["rounds"][0]["largest"] > 10 * jaccard_join.LEAF_DOCS


def test_components_of_keys(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(150), rng.randrange(400)) for _ in range(350)] + [(1000 + i, 1000 + i + d) for i in range(60) for d in (0, 1)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for key, node in rows:
        parent[root(("k", key))] = root(("n", node))
    groups = {}
    for _, node in rows:
        groups.setdefault(root(("n", node)), set()).add(node)
    expected = {node: min(g) for g in groups.values() if len(g) > 1 for node in g}
    got = connected_components(spark.createDataFrame(rows, "key long, node long"))
    assert {r.node: r.root for r in got.collect()} == expected
    assert connected_components(spark.createDataFrame([], "key long, node long")).count() == 0


def test_one_document_of_each_component_stays(docs, rows):
    kept = jaccard_join.kept_documents(docs)
    assert kept.columns == docs.columns
    sets = [frozenset(cases.shingles(r[1], 5)) for r in rows]
    parent = cases.components([(i, r[1]) for i, r in enumerate(rows)], 5, 80)
    assert kept.count() == len(set(parent.values()))
    assert sets


def test_mix_comes_near_targets(docs, rows):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(cases.words(r[1]))
    names = sorted([s for s in sizes if s is not None]) + [None]
    weights = dict(zip(names, [5, 2, 1] * 3, strict=False))
    targets, free = {}, set(names)
    budget = 1.5 * sum(sizes.values())
    while True:
        left = budget - sum(2 * sizes[s] for s in names if s not in free)
        targets = {s: left * weights[s] / sum(weights[f] for f in free) if s in free else 2 * sizes[s] for s in names}
        over = {s for s in free if targets[s] > 2 * sizes[s] + 1e-9}
        if not over:
            break
        free -= over
    by_size = {sizes[s]: targets[s] for s in names}
    for r in got:
        assert r.target == pytest.approx(by_size[r.source_size])
        assert 0 <= r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
    assert sum(r.taken for r in got) <= budget
    again = mixing.mix_sources(docs.repartition(7)).collect()
    pick = lambda found: Counter((r.doc_id, r.size, r.taken) for r in found)
    assert pick(again) == pick(got)
    copies = mixing.mixed_documents(docs)
    assert copies.count() == sum(r.copies for r in got) and copies.columns == docs.columns


def test_the_mix_in_its_order(docs):
    got = mixing.mix_order(docs).collect()
    assert [(r.finish, r.rank) for r in got] == sorted((r.finish, r.rank) for r in got)
    copies = Counter((r.doc_id, r.size) for r in got)
    cut = Counter()
    for r in mixing.mix_sources(docs).collect():
        cut[r.doc_id, r.size] += r.copies
    assert copies == +cut
    upto = {}
    for r in got:
        # finish times rise within a source, first all documents, then all again
        assert upto.get(r.rank, (0, 0.0)) <= (r.copy, r.finish)
        upto[r.rank] = (r.copy, r.finish)
