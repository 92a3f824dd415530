"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on binned features with monotonic constraints and flattened
into node arrays; scoring walks all documents of a batch and all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlespark.llm.docstats import COUNTS, FEATURES, bounded, document_statistics, labelled, matrix
from candlespark.llm.staging import staged

#: +1: a score may only rise with the feature; -1: only fall.
MONOTONE = {"symbols_per_char": -1, "words_with_symbol": -1, "bangs_per_char": -1, "dup_lines": -1, "repeat_words": -1, "top_word": -1}

BASE_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"


@dataclass
class Forest:
    """Trees as arrays of shape (trees, nodes); the children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Summed leaf values, documents and trees walked in step."""
        trees = np.arange(self.feature.shape[0])[None, :]
        node = np.zeros((len(x), self.feature.shape[0]), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[trees, node]
            down = 2 * node + 1 + (x[rows, feature] > self.threshold[trees, node])
            node = down
        return self.bias + self.value[trees, node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def grow(x: np.ndarray, y: np.ndarray, monotone: dict[str, int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smoothing: float = 5.0, least: int = 5) -> Forest:
    """Boost ``trees`` complete trees of logistic loss on features x and labels y (0 or 1).

    A split on a constrained feature is refused when its sides' values run
    against the constraint, and the values below it are held on their side of
    the middle, so that the whole score is monotonic.
    """
    sign = np.array([monotone.get(f, 0) for f in FEATURES])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p / (1 - p)))
    inner, total = 2**depth - 1, 2 ** (depth + 1) - 1
    feature, threshold, value = np.zeros((trees, total), dtype=np.int64), np.full((trees, total), np.inf), np.zeros((trees, total))
    margin = np.full(len(x), bias)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - prob, np.maximum(prob * (1 - prob), 1e-6)
        node = np.zeros(len(x), dtype=np.int64)
        low, high = np.full(total, -np.inf), np.full(total, np.inf)
        value[t, 0] = np.clip(gradient.sum() / (hessian.sum() + smoothing), -4, 4)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            best = (1e-6, None)
            if len(rows) >= 2 * least:
                g, h = gradient[rows], hessian[rows]
                whole = g.sum() ** 2 / (h.sum() + smoothing)
                for f in range(x.shape[1]):
                    b = binned[rows, f]
                    width = len(edges[f]) + 1
                    if width < 2:
                        continue
                    gl, hl, nl = (np.cumsum(np.bincount(b, weights=v, minlength=width))[:-1] for v in (g, h, np.ones(len(b))))
                    gr, hr, nr = g.sum() - gl, h.sum() - hl, len(b) - nl
                    vl, vr = np.clip(gl / (hl + smoothing), low[at], high[at]), np.clip(gr / (hr + smoothing), low[at], high[at])
                    gain = gl**2 / (hl + smoothing) + gr**2 / (hr + smoothing) - whole
                    gain[(nl < least) | (nr < least) | (sign[f] * (vr - vl) < 0)] = -1
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (f, k, vl[k], vr[k]))
            left, right = 2 * at + 1, 2 * at + 2
            low[[left, right]], high[[left, right]] = low[at], high[at]
            if best[1] is None:
                value[t, [left, right]] = value[t, at]
                node[rows] = left  # a threshold of infinity sends all to the left
                continue
            f, k, vl, vr = best[1]
            feature[t, at], threshold[t, at] = f, edges[f][k]
            value[t, left], value[t, right] = vl, vr
            middle = (vl + vr) / 2
            if sign[f] > 0:
                high[left], low[right] = middle, middle
            elif sign[f] < 0:
                low[left], high[right] = middle, middle
            node[rows] = np.where(binned[rows, f] <= k, left, right)
        value[t, :inner] = 0
        value[t] *= rate
        margin += value[t, node]
    return Forest(feature, threshold, value, bias, depth)


def judged(forest: Forest | None, least_words: int, repeat_percent: int, threshold: float):
    """Arrow batches of statistics to BASE_SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, repeats = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_words", "n_repeat_words"))
            failed = (words < least_words) | (100 * repeats > repeat_percent * words)
            x = matrix(batch.column("features"))
            score = np.concatenate([forest.score(x[i : i + 4096]) for i in range(0, len(x), 4096)] or [np.zeros(0)]) if forest else np.ones(len(x))
            columns = [batch.column("doc_id"), *[batch.column(c) for c in COUNTS], pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return run


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    least_words: int = 10,
    repeat_percent: int = 20,
    threshold: float = 0.5,
    train_rows: int = 20_000,
    monotone: dict[str, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, COUNTS, base_failed, kept, score.

    A document fails the base rules with fewer than ``least_words`` words or with
    more than ``repeat_percent`` per cent of its words in repeated windows; of the
    others the trees keep those that score ``threshold`` or more. The trees learn
    from at most ``train_rows`` labelled documents; labels and identifiers are
    no input of a score. Without labels of both kinds nothing but the base
    rules decides. A null text is an empty one and fails them; repeated rows are
    judged one by one. Other columns are ignored.
    """
    stats = staged(document_statistics(docs, id_col, text_col), "rules-statistics")
    table = bounded(labelled(stats, labels), train_rows).orderBy("doc_id").toArrow()
    y = table.column("label").to_numpy()
    forest = grow(matrix(table.column("features")), y, MONOTONE if monotone is None else monotone) if len(np.unique(y)) == 2 else None
    return stats.mapInArrow(judged(forest, least_words, repeat_percent, threshold), BASE_SCHEMA)
