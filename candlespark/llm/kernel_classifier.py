"""Quality classifier: random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.llm.docstats import FEATURES, bounded, document_statistics, labelled, matrix
from candlespark.llm.staging import PLACE, TEXT_BATCH_BYTES, at_places, from_files, located, staged

#: Tasks that sum the normal equations, and those that add up their sums.
SUM_TASKS, ADD_TASKS = 32, 4


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    beta: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        """A constant, the standardised statistics, and the cosines of random projections of them."""
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.ones(len(z)), z, np.sqrt(2 / len(self.phases)) * np.cos(z @ self.waves + self.phases)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Ridge scores, rounded so that equal statistics score alike wherever they stand in a batch."""
        return np.round(np.concatenate([self.lift(x[i : i + 2048]) @ self.beta for i in range(0, len(x), 2048)] or [np.zeros(0)]), 9)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0, 1)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ascending raw scores and the calibrated value at each.

    Equal raw scores are one block from the start, whatever their labels. A block's value holds from its first to its last raw score; between blocks it
    is interpolated. Blocks are drawn half a row towards the overall rate, so
    that a pure block is not certain.
    """
    points, which = np.unique(raw, return_inverse=True)
    blocks: list[list[float]] = []  # first, last, sum, count
    for r, v, n in zip(points, np.bincount(which, weights=y), np.bincount(which), strict=True):
        blocks.append([r, r, v, float(n)])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    rate = y.mean()
    xs = np.array([p for b in blocks for p in b[:2]])
    ys = np.repeat([(b[2] + 0.5 * rate) / (b[3] + 0.5) for b in blocks], 2)
    return xs, np.maximum.accumulate(ys)


def _sums(model: Model):
    """Arrow batches of (features, label) to one row: the partition's normal equations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 + len(model.mean) + len(model.phases)
        both = np.zeros((size, size + 1))
        for batch in batches:
            x, y = matrix(batch.column("features")), batch.column("label").to_numpy(zero_copy_only=False)
            for i in range(0, len(x), 2048):
                z = model.lift(x[i : i + 2048])
                both[:, :-1] += z.T @ z
                both[:, -1] += z.T @ y[i : i + 2048]
        yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], type=pa.binary())], names=["sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column("sums"):
            part = np.frombuffer(blob.as_buffer(), dtype=np.float64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["sums"])


def fit(rows: DataFrame, waves: int = 256, width: float = 1.0, ridge: float = 1e-3, seed: int = 7) -> Model | None:
    """Fit on (doc_id, features, label); None unless both labels are there.

    Standardisation and normal equations are sums over partitions; a fifth of
    the rows, chosen by a hash of the id, is left to calibrate the scores.
    """
    rows = staged(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5))), "classifier-rows")
    parts = [f(F.element_at("features", i + 1)) for i in range(len(FEATURES)) for f in (F.avg, F.stddev_pop)]
    moments = rows.agg(F.count_distinct("label"), *parts).first()
    if moments[0] < 2:
        return None
    mean, spread = np.array(moments[1::2], dtype=float), np.array(moments[2::2], dtype=float)
    rng = np.random.default_rng(seed)
    scale = 1 / (width * np.sqrt(len(FEATURES)))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), rng.standard_normal((len(FEATURES), waves)) * scale, rng.uniform(0, 2 * np.pi, waves))
    train = rows.filter("fold > 0").select("features", "label").repartition(SUM_TASKS)
    summed = train.mapInArrow(_sums(model), "sums binary").repartition(ADD_TASKS).mapInArrow(_added, "sums binary").toArrow()
    size = 1 + len(mean) + waves
    both = sum(np.frombuffer(b.as_buffer(), dtype=np.float64).reshape(size, size + 1) for b in summed.column("sums"))
    gram, right, n = both[:, :-1], both[:, -1], max(both[0, 0], 1.0)
    model.beta = np.linalg.solve(gram + ridge * n * np.eye(size) * (np.arange(size) > 0) + 1e-9 * np.eye(size), right)
    held = rows.filter("fold = 0").orderBy("doc_id").select("features", "label").toArrow()
    if len(np.unique(held.column("label").to_numpy())) < 2:  # too few rows to set some aside
        held = rows.orderBy("doc_id").select("features", "label").toArrow()
    model.steps = isotonic(model.raw(matrix(held.column("features"))), held.column("label").to_numpy())
    return model


def scored(model: Model | None, keep: Sequence[str]):
    """Arrow batches of features and the columns to keep, with a score for each; 0.5 without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("features"))
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], names=[*keep, "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learnt from: crc32 of its id as text is 1 modulo 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def quality_scores(docs: DataFrame, labels: DataFrame, *, train_rows: int = 200_000, waves: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score is the calibrated probability that the label is 1, from statistics
    of the whole text alone; a null text is an empty one and is scored too.
    Learns from at most ``train_rows`` labelled rows that are not held out;
    several labels of one id are averaged, null ones ignored. Without labels of
    both kinds every score is 0.5. Other columns are ignored.
    """
    stats = staged(document_statistics(docs, id_col, text_col).select("doc_id", "features", held_out(F.col("doc_id")).alias("held_out")), "classifier-statistics", batch_bytes=TEXT_BATCH_BYTES)
    model = fit(bounded(labelled(stats.filter("not held_out"), labels), train_rows), waves)
    found = stats.mapInArrow(scored(model, ["doc_id", "held_out"]), "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted_documents(docs: DataFrame, labels: DataFrame, *, train_rows: int = 200_000, waves: int = 256) -> DataFrame:
    """The documents with a score of 0.5 or more, with all their columns.

    Learns and scores as quality_scores does; what is rejected is told by its
    place in the files, so that identifiers may be null or repeated.
    """
    docs = from_files(docs)
    stats = staged(document_statistics(located(docs), keep=PLACE).select("doc_id", "features", *PLACE), "classifier-statistics", batch_bytes=TEXT_BATCH_BYTES)
    model = fit(bounded(labelled(stats.filter(~held_out(F.col("doc_id"))), labels), train_rows), waves)
    scores = stats.mapInArrow(scored(model, PLACE), "__doc_file string, __doc_row long, score double")
    rejected = staged(scores.filter("score < 0.5").select(*PLACE), "classifier-rejected")
    return at_places(docs, rejected, "left_anti").select(*docs.columns)
