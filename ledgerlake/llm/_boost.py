"""Small gradient-boosted trees (logistic loss) on binned features.

``fit`` works on arrays; ``fit_rows`` grows the same kind of trees from all rows of a frame,
whose tasks sum gradients per node, feature and bin. Only these sums, whose number does not
depend on the rows, reach the driver. They are whole numbers (steps of 1 / ``UNIT``), so
neither partitions nor order change a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 20
MANTISSA = 8  # bits of a feature's value that tell where a cut may lie


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 24, penalty: float = 1.0) -> dict:
    """Trees as flat arrays: feature and cut of 2**depth - 1 nodes, 2**depth leaves."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(n, base)
    model = {"base": base, "feature": [], "cut": [], "leaf": [], "depth": depth}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, dtype=int), np.full(2**depth - 1, np.inf)
        node = np.zeros(n, dtype=int)
        for k in range(2**depth - 1):
            rows = node == k
            if rows.sum() >= 10:
                sg, sh = g[rows].sum(), h[rows].sum()
                best = 1e-6
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    size = len(e) + 1
                    cg = np.cumsum(np.bincount(binned[rows, j], weights=g[rows], minlength=size))[:-1]
                    ch = np.cumsum(np.bincount(binned[rows, j], weights=h[rows], minlength=size))[:-1]
                    gain = cg**2 / (ch + penalty) + (sg - cg) ** 2 / (sh - ch + penalty) - sg**2 / (sh + penalty)
                    if gain.max() > best:
                        best, feature[k], cut[k] = gain.max(), j, e[int(gain.argmax())]
            node[rows] = 2 * k + 1 + (x[rows, feature[k]] > cut[k])
        leaf = node - (2**depth - 1)
        value = np.bincount(leaf, weights=g, minlength=2**depth) / (np.bincount(leaf, weights=h, minlength=2**depth) + penalty) * rate
        margin += value[leaf]
        model["feature"].append(feature.tolist())
        model["cut"].append(cut.tolist())
        model["leaf"].append(value.tolist())
    return model


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.float32).reshape(len(column), -1).astype(float)


def _rounded(x: np.ndarray) -> np.ndarray:
    m, e = np.frexp(x)
    return np.ldexp(np.rint(np.ldexp(m, MANTISSA)), e - MANTISSA)


def _value_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows (x, w): how often each feature has each rounded value."""
    for batch in batches:
        x, w = _rounded(matrix(batch.column(0))), batch.column(1).to_numpy()
        for j in range(x.shape[1]):
            value, at = np.unique(x[:, j], return_inverse=True)
            held = np.bincount(at, weights=w, minlength=len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), j, np.int32)), pa.array(value), pa.array(held)], names=["feature", "value", "w"])


def _edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Cuts of each feature: quantiles of all its values, rounded to ``MANTISSA`` bits."""
    counts = rows.select("x", "w").mapInArrow(_value_counts, "feature int, value double, w long").groupBy("feature", "value").agg(F.sum("w").alias("w"))
    held: dict[int, list] = {}
    for r in counts.orderBy("feature", "value").collect():  # bounded by the rounding, not by the rows
        held.setdefault(r.feature, []).append((r.value, r.w))
    out = []
    for j in range(len(held)):
        value, w = (np.array(c) for c in zip(*held[j], strict=True))
        reach = np.cumsum(w)
        out.append(np.unique(value[np.searchsorted(reach, np.arange(1, bins) * reach[-1] / bins, side="left").clip(0, len(value) - 1)]))
    return out


def _node_sums(model: dict, edges: list[np.ndarray], feature: list[int], cut: list[float], first: int):
    """Of a task's rows (x, y, w): sums of gradients and curvatures per node from ``first`` on, feature and bin."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(map(len, edges)) + 1
        sums = np.zeros((2, (first + 1) * len(edges) * size), np.int64)
        for batch in batches:
            x, y, w = matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            p = predict(model, x)
            g, h = np.rint((y - p) * UNIT).astype(np.int64) * w, np.rint(p * (1 - p) * UNIT).astype(np.int64) * w
            node, at = np.zeros(len(x), dtype=int), np.arange(len(x))
            while len(node) and node.min() < first:
                node = 2 * node + 1 + (x[at, np.array(feature)[node]] > np.array(cut)[node])
            for j, e in enumerate(edges):
                cell = ((node - first) * len(edges) + j) * size + np.searchsorted(e, x[:, j], side="left")
                np.add.at(sums[0], cell, g)
                np.add.at(sums[1], cell, h)
        cell = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(sums[0, cell]), pa.array(sums[1, cell])], names=["cell", "g", "h"])

    return task


def fit_rows(rows: DataFrame, trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 24, penalty: float = 1.0) -> dict:
    """Trees as of ``fit`` from all ``rows``: x (float32 features as bytes), y (0 or 1) and w, how often the row counts."""
    rows = rows.select("x", "y", "w")
    edges = _edges(rows, bins)
    width, size = len(edges), max(map(len, edges)) + 1
    mean = rows.agg(F.sum(F.col("y") * F.col("w")).alias("y"), F.sum("w").alias("w")).first()
    prior = float(np.clip(mean.y / mean.w, 1e-3, 1 - 1e-3))
    model: dict = {"base": float(np.log(prior / (1 - prior))), "feature": [], "cut": [], "leaf": [], "depth": depth}
    for _ in range(trees):
        feature, cut = [0] * (2**depth - 1), [np.inf] * (2**depth - 1)
        value = np.zeros(2**depth)
        for level in range(depth):
            first = 2**level - 1
            sums = np.zeros((2, (first + 1) * width * size))
            for r in rows.mapInArrow(_node_sums(model, edges, feature[:first], cut[:first], first), "cell int, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                sums[:, r.cell] = r.g / UNIT, r.h / UNIT
            g, h = np.cumsum(sums.reshape(2, first + 1, width, size), axis=3)
            sg, sh = g[:, 0, -1], h[:, 0, -1]
            gain = g**2 / (h + penalty) + (sg[:, None, None] - g) ** 2 / (sh[:, None, None] - h + penalty) - (sg**2 / (sh + penalty))[:, None, None]
            for j, e in enumerate(edges):
                gain[:, j, len(e) :] = 0
            for k in range(first + 1):
                j, at = np.unravel_index(int(gain[k].argmax()), gain[k].shape)
                if gain[k, j, at] > 1e-6:
                    feature[first + k], cut[first + k] = int(j), float(edges[j][at])
                if level == depth - 1:
                    low = (g[k, j, at], h[k, j, at]) if gain[k, j, at] > 1e-6 else (sg[k], sh[k])
                    value[2 * k : 2 * k + 2] = low[0] / (low[1] + penalty) * rate, (sg[k] - low[0]) / (sh[k] - low[1] + penalty) * rate
        model["feature"].append(feature)
        model["cut"].append(cut)
        model["leaf"].append(value.tolist())
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    margin = np.full(len(x), model["base"])
    rows = np.arange(len(x))
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"], strict=True):
        feature, cut = np.array(feature), np.array(cut)
        node = np.zeros(len(x), dtype=int)
        for _ in range(model["depth"]):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        margin += np.array(leaf)[node - len(feature)]
    return 1 / (1 + np.exp(-margin))
