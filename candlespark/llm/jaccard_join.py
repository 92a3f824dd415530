"""Exact n-gram Jaccard join in the metric space of shingle sets.

Unrelated texts all lie at distance 1 from one another and from any pivot, where
the triangle inequality says nothing. So the outermost regions come from the
symmetric difference, which is a metric too: the shingle universe is cut by hash
into m classes, and two sets within the join radius differ in at most d
shingles, so they agree on at least m - d classes. A document therefore enters
the regions of its d + 1 rarest class contents, which holds for every linked
pair one region in common; regions that share a document are one.

In a region pivots part what meets there. Every document goes to the Voronoi
cell of its nearest pivot, cut at the join radius, so that a cell's documents
are linked with its pivot. Two documents of different components can only link
if one of them lies within twice the radius of the other's pivot (the triangle
inequality), so a cell's window takes those in and meets the cell's documents.
Documents in no cell make the region that is joined next, with new pivots,
until a region is small enough to be joined pair by pair. All regions do this
at once, one Spark round after the other; a round deals a region in chunks, so
no task sees a whole one. Nothing is sampled or capped; the result is exact up
to 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlespark.llm import staging
from candlespark.llm import textkernel as K
from candlespark.llm.components import connected_components
from candlespark.llm.staging import PLACE, TEXT_BATCH_BYTES, at_places, from_files, located, release, staged, sweep

#: A region that one task joins pair by pair: documents, and shingles in all.
LEAF_DOCS, LEAF_SHINGLES = 64, 2_000_000
#: Documents of a larger region that one task compares with its pivots.
CHUNK_DOCS = 384
#: Pivots of a region in the first round, by how much they grow in each round, and their most.
PIVOTS, GROWTH, MOST_PIVOTS = 16, 4, 1024
#: Bytes of documents' places and sizes that are sent to all executors rather than have the texts shuffled to them.
BROADCAST_BYTES = 32 << 20
#: Tasks that the rows of one region or cell are dealt over when they get its sizes.
SALTS = 16

PROFILE = "doc_id long, __doc_file string, __doc_row long, n_shingles long, ka long, kb long, keep0 int, m0 int, sigs0 array<long>, keep1 int, m1 int, sigs1 array<long>"


@dataclass(frozen=True)
class Rule:
    """Words a shingle, and the least similarity as num / den."""

    words: int = 5
    num: int = 80
    den: int = 100

    def __post_init__(self) -> None:
        if not (self.words >= 1 and 2 * self.den <= 3 * self.num <= 3 * self.den):
            raise ValueError("the similarity must lie between 2/3 and 1")

    @property
    def radius(self) -> float:
        return 1 - self.num / self.den

    def linked(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.den * shared >= self.num * (a + b - shared)


def band_table(rule: Rule, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size, classes m, differences d) of each band of set sizes up to ``largest``.

    A band holds the pairs whose smaller set has a size in it; d is the most
    shingles in which such a linked pair can differ. m leaves three sixteenths of
    d over, which the most frequent class contents of a document fill.
    """
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, -(-first[-1] * 3 // 2)))
    small = np.array(first[1:], dtype=np.int64) - 1
    together = small + small * rule.den // rule.num
    d = together * (rule.den - rule.num) // (rule.den + rule.num)
    return np.array(first[:-1], dtype=np.int64), np.where(d > 0, d + 1 + (3 * d + 15) // 16, 0), d


def class_contents(row: np.ndarray, h: np.ndarray, sizes: np.ndarray, which: np.ndarray, bands: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, signatures): of each document, one for every class of its band; -1 has none."""
    m = np.where(which >= 0, bands[1][which], 0)
    base = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(m, out=base[1:])
    sums = np.zeros(base[-1], dtype=np.uint64)
    has = m[row] > 0
    row, h = row[has], h[has]
    np.add.at(sums, base[row] + (h % m[row].astype(np.uint64)).astype(np.int64), K.mix(h ^ np.uint64(0xA0761D6478BD642F)))
    owner = np.repeat(np.arange(len(sizes)), m)
    number = np.arange(base[-1]) - base[owner]
    sums += number.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB) + (which[owner] + 1).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
    return base, K.mix(sums).view(np.int64)


def set_keys(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every document's set."""
    keys = []
    for salt in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F):
        sums = np.zeros(n, dtype=np.uint64)
        np.add.at(sums, row, K.mix(h ^ np.uint64(salt)))
        keys.append(sums.view(np.int64))
    return keys[0], keys[1]


def profiles(rule: Rule):
    """Arrow batches of (doc_id, text, __doc_file, __doc_row) to PROFILE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.string_parts(batch.column("text"))
            for lo, hi in K.slices(offsets):
                n = hi - lo
                w = K.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
                row, h = K.shingles(w, n, rule.words)
                sizes = np.bincount(row, minlength=n).astype(np.int64)
                bands = band_table(rule, int(sizes.max(initial=1)))
                top = np.searchsorted(bands[0], sizes, side="right") - 1
                low = np.searchsorted(bands[0], -(-sizes * rule.num // rule.den), side="right") - 1
                low = np.where(low < top, low, -1)
                ka, kb = set_keys(row, h, n)
                columns = [batch.column("doc_id").slice(lo, n), batch.column("__doc_file").slice(lo, n), batch.column("__doc_row").slice(lo, n), pa.array(sizes), pa.array(ka), pa.array(kb)]
                for which in (top, low):
                    base, sigs = class_contents(row, h, sizes, which, bands)
                    columns.append(pa.array(np.where(which >= 0, bands[2][which] + 1, 0).astype(np.int32)))
                    columns.append(pa.array(np.diff(base).astype(np.int32)))
                    columns.append(pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), pa.array(sigs)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "__doc_file", "__doc_row", "n_shingles", "ka", "kb", "keep0", "m0", "sigs0", "keep1", "m1", "sigs1"])

    return run


def sets_of(rule: Rule, carried: list[str]):
    """Arrow batches of (text, the carried columns) to (the carried columns, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.string_parts(batch.column("text"))
            for lo, hi in K.slices(offsets):
                n = hi - lo
                w = K.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
                row, h = K.shingles(w, n, rule.words)
                ends = np.searchsorted(row, np.arange(n + 1))
                blobs = pa.array([h[ends[i] : ends[i + 1]].tobytes() for i in range(n)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, n) for c in carried), blobs], names=[*carried, "shingles"])

    return run


class Sets:
    """Shingle sets held in one task: their distances, and the components of those that link."""

    def __init__(self, nodes: np.ndarray, blobs: pa.Array, rule: Rule) -> None:
        sets = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in blobs]
        self.nodes, self.rule, self.sizes = nodes, rule, np.array([len(s) for s in sets], dtype=np.int64)
        #: Of each set the place of one that is linked with it, in the end that of its component's least node.
        self.parent = np.arange(len(sets))
        values = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        _, codes, counts = np.unique(values, return_inverse=True, return_counts=True)
        seen = counts[codes] > 1  # a shingle of one document is shared with none
        owner = np.repeat(np.arange(len(sets)), self.sizes)[seen]
        self.codes = codes[seen]
        self.starts = np.searchsorted(owner, np.arange(len(sets) + 1))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def union(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            low, high = (a, b) if self.nodes[a] <= self.nodes[b] else (b, a)
            self.parent[high] = low

    def roots(self, members: np.ndarray) -> np.ndarray:
        return np.array([self.root(int(i)) for i in members], dtype=np.int64)

    def _flat(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.starts[members + 1] - self.starts[members]
        at = np.repeat(self.starts[members] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        return np.repeat(np.arange(len(members)), lengths), self.codes[at]

    def shared(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Sizes of all intersections, by products of blocks of the incidence matrices."""
        (ra, ca), (rb, cb) = self._flat(left), self._flat(right)
        used = np.intersect1d(ca, cb)
        out = np.zeros((len(left), len(right)), dtype=np.float64)
        if not len(used):
            return out.astype(np.int64)
        ka, kb = np.searchsorted(used, ca), np.searchsorted(used, cb)
        oka = used[np.minimum(ka, len(used) - 1)] == ca
        okb = used[np.minimum(kb, len(used) - 1)] == cb
        ra, ka, rb, kb = ra[oka], ka[oka], rb[okb], kb[okb]
        for lo in range(0, len(used), 4096):
            width = min(4096, len(used) - lo)
            a = np.zeros((len(left), width), dtype=np.float32)
            b = np.zeros((len(right), width), dtype=np.float32)
            ina, inb = (ka >= lo) & (ka < lo + width), (kb >= lo) & (kb < lo + width)
            a[ra[ina], ka[ina] - lo] = 1
            b[rb[inb], kb[inb] - lo] = 1
            out += a @ b.T
        return np.rint(out).astype(np.int64)

    def link(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join all pairs of left and right: (which link, their distances)."""
        if not (len(left) and len(right)):
            return np.zeros((len(left), len(right)), dtype=bool), np.zeros((len(left), len(right)))
        shared = self.shared(left, right)
        a, b = self.sizes[left][:, None], self.sizes[right][None, :]
        linked = self.rule.linked(shared, a, b)
        open_ = linked
        while open_.any():
            # each row's first link, then what these leave apart
            for i in np.flatnonzero(open_.any(axis=1)):
                self.union(int(left[i]), int(right[open_[i].argmax()]))
            open_ = linked & (self.roots(left)[:, None] != self.roots(right)[None, :])
        return linked, 1 - shared / np.maximum(a + b - shared, 1)


CHUNK = "region long, node long, root long, pivot boolean, home long, at double, cells array<long>, afar array<double>, score double, n long, shingles binary"


def measured(rule: Rule):
    """A chunk of a region with all its pivots to CHUNK rows, one for each document and pivot.

    ``root`` is the least node linked with it here, ``home`` the nearest pivot if
    within the radius, ``at`` its distance; ``cells`` are the pivots whose windows
    take the document in, ``afar`` their distances. Of two cells only the one of
    the lesser pivot takes in documents of the other.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        nodes = table.column("node").to_numpy()
        pivot = table.column("pivot").to_numpy(zero_copy_only=False)
        sets = Sets(nodes, table.column("shingles").combine_chunks(), rule)
        pivots, others = np.flatnonzero(pivot), np.flatnonzero(~pivot)
        sets.link(pivots, pivots)
        linked, far = sets.link(others, pivots)
        roots = sets.roots(np.arange(len(nodes)))
        near = far.argmin(axis=1) if len(others) and len(pivots) else np.zeros(len(others), dtype=np.int64)
        has = linked.any(axis=1)
        before = np.arange(len(pivots))[None, :] < np.where(has, near, len(pivots))[:, None]
        window = ~linked & before & (far <= 2 * rule.radius + 1e-9) & (roots[others][:, None] != roots[pivots][None, :])
        home, at = np.full(len(nodes), -1, dtype=np.int64), np.zeros(len(nodes))
        if len(pivots):
            home[others[has]] = nodes[pivots[near[has]]]
            at[others[has]] = far[np.flatnonzero(has), near[has]]
        counts = np.zeros(len(nodes) + 1, dtype=np.int64)
        counts[others + 1] = window.sum(axis=1)
        offsets, (which, cell) = pa.array(np.cumsum(counts).astype(np.int32)), np.nonzero(window)
        none = pa.array(home < 0)
        columns = {
            "region": table.column("region"),
            "node": table.column("node"),
            "root": pa.array(nodes[roots]),
            "pivot": table.column("pivot"),
            "home": pa.compute.if_else(none, pa.scalar(None, pa.int64()), pa.array(home)),
            "at": pa.array(at),
            "cells": pa.ListArray.from_arrays(offsets, pa.array(nodes[pivots][cell])),
            "afar": pa.ListArray.from_arrays(offsets, pa.array(far[which, cell])),
            **{c: table.column(c) for c in ("score", "n", "shingles")},
        }
        return pa.table(columns)

    return run


def joined_leaf(rule: Rule):
    """A leaf's (node, side, shingles) to (node, root): every node and the least node of its component there.

    Without a side all pairs are joined, otherwise those of the two sides.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        nodes, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        sets = Sets(nodes, table.column("shingles").combine_chunks(), rule)
        everything = np.arange(len(nodes))
        if side.any():
            sets.link(everything[side == 1], everything[side == 2])
        else:
            sets.link(everything, everything)
        return pa.table({"node": nodes, "root": nodes[sets.roots(everything)]})

    return run


def spread(docs: Column, shingles: Column, most_docs: int) -> Column:
    """Parts of about ``most_docs`` documents and LEAF_SHINGLES shingles each."""
    return F.greatest(F.lit(1), F.ceil(docs / F.lit(most_docs)), F.ceil(shingles / F.lit(LEAF_SHINGLES))).cast("int")


def beside(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with the columns of their key's one row in ``table``; a key with most of the rows is dealt over SALTS tasks."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, [key, "_salt"]).drop("_salt")


def voronoi_round(regions: DataFrame, rule: Rule, turn: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """One round for all large regions: (links (node, root), leaves of windows, what is left of the regions).

    ``regions`` are REGION rows. The hub, whose contents most others share, is
    always a pivot; the other pivots are drawn by hash. Each pivot is compared
    with its whole region, so none is left afterwards.
    """
    most = F.greatest(F.lit(1), F.least(F.lit(min(MOST_PIVOTS, PIVOTS * GROWTH**turn)), F.floor(F.lit(LEAF_SHINGLES) * F.col("docs") / F.col("all_shingles"))))
    drawn = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)) < most / F.col("docs") * F.lit(float(1 << 30))
    dealt = regions.withColumn("pivot", (F.col("node") == F.col("hub")) | drawn).withColumn("chunks", spread(F.col("docs"), F.col("all_shingles"), CHUNK_DOCS))
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    own = F.array(F.pmod(F.xxhash64("node", F.lit(~turn)), F.col("chunks")).cast("int"))
    dealt = dealt.select("region", "node", "score", "n", "shingles", "pivot", F.explode(F.when(F.col("pivot"), everywhere).otherwise(own)).alias("chunk"))
    out = staged(dealt.groupBy("region", "chunk").applyInArrow(measured(rule), CHUNK), "jaccard-round")
    links = out.filter("node != root").select("node", "root")
    left = out.filter("not pivot and home is null").select("region", "node", "score", "n", "shingles")

    # windows: a cell's documents meet those that may link with one of them
    cores = out.filter("home is not null").groupBy(F.col("home").alias("cell")).agg(F.max("at").alias("cover"), F.count(F.lit(1)).alias("docs"), F.sum("n").alias("all_n"))
    seen = out.filter(F.size("cells") > 0).select("node", "n", F.explode(F.arrays_zip("cells", "afar")).alias("c")).select("node", "n", F.col("c.cells").alias("cell"), F.col("c.afar").alias("afar"))
    window = staged(beside(seen, cores, "cell").filter(F.col("afar") <= F.col("cover") + F.lit(rule.radius + 1e-9)).select("cell", "node", "n", "docs", "all_n"), "jaccard-windows")
    if window.isEmpty():
        return links, None, left
    sized = window.groupBy("cell", "docs", "all_n").agg(F.count(F.lit(1)).alias("guests"), F.sum("n").alias("guest_n"))
    plan = sized.select("cell", spread(F.col("docs"), F.col("all_n"), CHUNK_DOCS).alias("chunks"), spread(F.col("guests"), F.col("guest_n"), CHUNK_DOCS).alias("blocks"))
    core = beside(out.filter("home is not null").select(F.col("home").alias("cell"), "node", F.lit(1).alias("side")), plan, "cell")
    core = core.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    guests = beside(window.select("cell", "node", F.lit(2).alias("side")), plan, "cell")
    guests = guests.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    places = core.select("cell", "chunk", "block", "node", "side").unionByName(guests.select("cell", "chunk", "block", "node", "side"))
    blobs = out.filter("not pivot").select("node", "shingles")  # one row for each
    return links, places.join(blobs, "node").select(F.concat_ws(":", F.lit(f"w{turn}"), "cell", "chunk", "block").alias("leaf"), "node", "side", "shingles"), left


REGION = ["region", "node", "score", "n", "docs", "all_shingles", "hub"]


def with_sizes(rows: DataFrame) -> DataFrame:
    """rows (region, node, score, n, ...) of regions of more than one document, with docs, all_shingles and hub of their region."""
    hub = F.max_by("node", F.struct("score", F.xxhash64("node")))
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("all_shingles"), hub.alias("hub"))
    return beside(rows, sizes.filter("docs > 1"), "region")


def is_large() -> Column:
    return (F.col("docs") > F.lit(LEAF_DOCS)) | (F.col("all_shingles") > F.lit(LEAF_SHINGLES))


def components_of_regions(active: DataFrame, texts: DataFrame, rule: Rule, stats: dict | None = None) -> DataFrame:
    """(node, root) of the documents of candidate regions, by their exact links.

    ``active`` are (region, node, score, n, file, row), ``texts`` the texts by
    (file, row). Small regions are leaves at once; the others go through rounds
    of pivots until they are small.
    """
    placed = staged(with_sizes(active), "jaccard-placed")

    def sets(chosen: DataFrame, carried: list[str]) -> DataFrame:
        few = chosen.count() * 8 * (2 + len(carried)) <= BROADCAST_BYTES  # rows of numbers alone
        places = chosen.select("file", "row", *carried)
        wanted = texts.join(F.broadcast(places) if few else places, ["file", "row"]).select("text", *carried)
        kinds = ", ".join(f"{c} {'double' if c == 'score' else 'long'}" for c in carried)
        return wanted.mapInArrow(sets_of(rule, carried), f"{kinds}, shingles binary")

    def leaf(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.concat_ws(":", F.lit(name), "region").alias("leaf"), "node", F.lit(0).alias("side"), "shingles")

    # one reading of the texts for all; they are shuffled once at most
    held = staged(sets(placed, REGION), "jaccard-sets", batch_bytes=TEXT_BATCH_BYTES)
    together = leaf(held.filter(~is_large()), "r")
    regions, turn = held.filter(is_large()), 0
    links: list[DataFrame] = []
    if not regions.isEmpty():
        while True:
            if stats is not None:
                stats.setdefault("rounds", []).append(regions.agg(F.count_distinct("region").alias("regions"), F.count(F.lit(1)).alias("docs"), F.max("docs").alias("largest")).first().asDict())
            edges, windows, left = voronoi_round(regions, rule, turn)
            links.append(edges)
            if windows is not None:
                together = together.unionByName(windows)
            rest = staged(with_sizes(left), "jaccard-left")
            together = together.unionByName(leaf(rest.filter(~is_large()), f"t{turn}"))
            regions, turn = rest.filter(is_large()), turn + 1
            if regions.isEmpty():
                break
    stars = staged(together.groupBy("leaf").applyInArrow(joined_leaf(rule), "node long, root long"), "jaccard-links")
    if not links:
        return stars
    for more in links:
        stars = stars.unionByName(more)
    stars = stars.filter("node != root")
    return connected_components(stars.select(F.col("root").alias("key"), "node").unionByName(stars.select(F.col("root").alias("key"), F.col("root").alias("node"))))


def shared_contents(seen: DataFrame, copies: DataFrame) -> DataFrame:
    """(sig, node, score): the contents through whose regions a node must go.

    ``copies`` are the nodes of sets that another node stands for. A content's
    rows carry no more than the node and its band; what else the choice needs is
    joined to the few that a second document shares. ``score`` is how often the
    node's contents occur, on average.
    """
    chosen = seen.select("node", "sigs0", "sigs1").join(copies, "node", "left_anti")
    cells = chosen.select((F.col("node") * 2).alias("owner"), F.explode("sigs0").alias("sig")).unionByName(chosen.select((F.col("node") * 2 + 1).alias("owner"), F.explode("sigs1").alias("sig")))
    often = staged(cells.groupBy("sig").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "jaccard-often")
    release(seen.sparkSession)
    shared = staged(cells.join(often, "sig"), "jaccard-shared")
    release(seen.sparkSession)
    limits = seen.select((F.col("node") * 2).alias("owner"), F.col("keep0").alias("keep"), F.col("m0").alias("m")).unionByName(seen.select((F.col("node") * 2 + 1).alias("owner"), F.col("keep1").alias("keep"), F.col("m1").alias("m")).filter("m > 0"))
    own = Window.partitionBy("owner")
    # contents that no other document has come first, then the others from the rarest
    at = F.col("m") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("often", "sig"))
    score = F.sum("often").over(own) / F.col("m")
    placed = shared.join(limits, "owner").withColumn("at", at).withColumn("score", score).filter("at <= keep")
    return placed.select("sig", F.shiftright("owner", 1).alias("node"), "score")


def jaccard_components(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text", stats: dict | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, __doc_file, __doc_row.

    component_id is the smallest identifier reachable by links of at least the
    rule's similarity; in each component one document is kept, the first with
    that identifier. Words are lower-cased (A-Z only). A document of fewer words
    than a shingle has its whole sequence as one; one without words or with a null
    text has none, links with nothing and is kept. A null identifier is never a
    component's unless all of its documents have none. Equal sets, repeated rows
    among them, are one node. An empty table gives no rows. Other columns are
    ignored, whatever their names. ``stats``, if given, gets ``rounds``: of each
    round of pivots its regions, their documents and the largest one's.
    """
    spark = docs.sparkSession
    source = located(docs if {id_col, text_col} == {"doc_id", "text"} else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    source = source.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "__doc_file", "__doc_row")
    begun = len(staging._named)
    full = staged(source.mapInArrow(profiles(rule), PROFILE).withColumn("node", F.monotonically_increasing_id()), "jaccard-profiles", batch_bytes=TEXT_BATCH_BYTES)
    seen = full.select("doc_id", "__doc_file", "__doc_row", "n_shingles", "ka", "kb", "node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("node").alias("node"))).alias("first")
    nodes = staged(seen.filter("n_shingles > 0").groupBy("ka", "kb", "n_shingles").agg(first), "jaccard-nodes")
    alike = ["ka", "kb", "n_shingles"]
    copies = staged(seen.filter("n_shingles > 0").select("node", *alike).join(nodes, alike).filter("node != first.node").select("node"), "jaccard-copies")
    contents = staged(shared_contents(full, copies), "jaccard-contents")
    # class contents are most of what has been written, and done with
    seen = staged(seen, "jaccard-seen")
    sweep(spark, begun, contents, seen, nodes)
    regions = connected_components(contents, "sig", "node")
    release(spark)

    scores = contents.groupBy("node").agg(F.max("score").alias("score"))
    # a file's name by its hash, so that few bytes go with a document's place
    place = [F.xxhash64("__doc_file").alias("file"), F.col("__doc_row").alias("row")]
    placed = regions.join(scores, "node").join(seen.select("node", F.col("n_shingles").alias("n"), *place), "node")
    active = staged(placed.select(F.col("root").alias("region"), "node", "score", "n", "file", "row"), "jaccard-active")
    roots = components_of_regions(active, source.select("text", *place), rule, stats)

    named = nodes.select(F.col("first.node").alias("node"), *alike, "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = staged(named.select(*alike, "root", "first"), "jaccard-named")
    chosen = named.groupBy("root").agg(F.min("first").alias("first"))
    of = named.select(*alike, "root").join(chosen, "root").drop("root")
    alone = F.col("first").isNull()
    return seen.select("doc_id", "__doc_file", "__doc_row", "node", *alike).join(of, alike, "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("first.node") == F.col("node"))).alias("kept"),
        "__doc_file",
        "__doc_row",
    )


def kept_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    docs = from_files(docs)
    begun = len(staging._named)
    dropped = staged(jaccard_components(docs, rule).filter("not kept").select(*PLACE), "jaccard-dropped")
    sweep(docs.sparkSession, begun, dropped)
    release(docs.sparkSession)
    return at_places(docs, dropped, "left_anti").select(*docs.columns)
