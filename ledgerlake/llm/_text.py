"""Whole-array text helpers used inside Arrow tasks.

A task gets Arrow batches of documents. ``slices`` cuts them into runs of whole
documents of bounded size, and the functions below work on the bytes of one run
at once, so that the cost per word is a few array operations. A document larger
than the bound is a run of its own; nothing is ever cut or skipped.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
SLICE_BYTES = 1 << 20
SLICE_DOCS = 1024  # so that a document's number within a run fits DOC_BITS
DOC_BITS = 10
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 * SLICE_BYTES  # of an Arrow batch on its way to a worker, besides its last row

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256).astype(U64) * U64(2) + U64(1)
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=U64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finish)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Run:
    """Whole documents: ``data`` their bytes, ``offsets`` where each begins."""

    def __init__(self, column: pa.Array) -> None:
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, at, data = column.buffers()
        at = np.frombuffer(at, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        self.data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = at - at[0]
        self.n = len(column)
        self._sum: dict[bool, np.ndarray] = {}

    def sums(self, lower: bool = False) -> np.ndarray:
        """Running polynomial sums; a stretch's hash is a difference of two."""
        if lower not in self._sum:
            up, _ = powers(len(self.data))
            s = np.zeros(len(self.data) + 1, dtype=U64)
            np.cumsum((_LOWER_BYTE if lower else _BYTE)[self.data] * up[: len(self.data)], out=s[1:])
            self._sum[lower] = s
        return self._sum[lower]

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hashes of byte stretches, equal for equal bytes anywhere."""
        s, (_, down) = self.sums(lower), powers(len(self.data))
        return mix((s[end] - s[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word ``[^\\x20\\x09-\\x0D]+``: document number, start, end."""
        solid = ~_SPACE[self.data]
        edge = np.zeros(len(solid) + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.ones(len(solid) + 1, dtype=bool)
        before[1:] = ~solid
        start = np.flatnonzero(solid & (before[:-1] | edge[:-1]))
        after = np.ones(len(solid) + 1, dtype=bool)
        after[:-1] = ~solid
        end = np.flatnonzero(solid & (after[1:] | edge[1:])) + 1
        return self.owner(start), start, end

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The document numbers of ascending positions."""
        counts = np.diff(np.searchsorted(at, self.offsets))
        return np.repeat(np.arange(self.n), counts)

    def chars(self) -> np.ndarray:
        """Running count of code points before each byte position."""
        out = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def shingles(word: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and their documents, in order.

    A document of fewer words gives its whole sequence as one; one without
    words gives none.
    """
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    n = len(word)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    padded = np.concatenate([word, np.zeros(size, U64)])
    acc = np.zeros(n, U64)
    left = counts[doc] - (np.arange(n) - first[doc])  # words from here to the document's end
    for k in range(size):
        acc = np.where(left > k, mix(acc * U64(0x9FB21C651E98DF25) + padded[k : k + n]), acc)
    keep = (left >= size) | ((counts[doc] < size) & (left == counts[doc]))
    return acc[keep], doc[keep]


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, 54-bit value) of a run, sorted; ``doc`` < SLICE_DOCS."""
    key = np.sort((doc.astype(U64) << U64(64 - DOC_BITS)) | (value >> U64(DOC_BITS)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return (key >> U64(64 - DOC_BITS)).astype(np.int64), key & U64((1 << (64 - DOC_BITS)) - 1)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Run]]:
    """Runs of whole rows of about ``limit`` bytes of text at most; null is empty."""
    text = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(total, total[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + SLICE_DOCS, batch.num_rows)
        part = batch.slice(i, j - i)
        yield part, Run(pc.fill_null(text.slice(i, j - i), ""))
        i = j


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, whatever their folder.

    A cluster that ships the package itself (``--py-files``) is not affected.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    bound_batches(spark)


def bound_batches(spark: SparkSession) -> None:
    """Batches to Python workers hold ``BATCH_BYTES``, not Spark's 64 MB or 10,000 rows.

    Such a batch lies in the executor's direct memory, grown by doubling, and again in the worker;
    every task here works on runs of ``SLICE_BYTES`` or row by row, so more at a time gains nothing.
    A session that has a setting of its own keeps it.
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


def give_back() -> None:
    """What a task has freed goes back to the system: Spark reuses its workers, and stages that need little would hold it on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def map_runs(docs: DataFrame, columns: list[str], fn: Callable, schema: str, setup: Callable | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """``fn(batch, run[, state])`` -> columns of ``schema`` for every run of documents.

    Only ``columns`` (with ``text`` among them) are read; other columns of the
    input, whatever their names, are left out. ``setup()`` is called once a task;
    ``limit`` is the bytes of text of a run.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (setup(),) if setup else ()
        for batch in batches:
            for part, run in slices(batch, limit=limit):
                out = fn(part, run, *state)
                if out is not None:
                    yield out
        batch = part = run = out = None
        give_back()

    workers_find_package(docs.sparkSession)
    return docs.select(*columns).mapInArrow(task, schema)


def record(**columns) -> pa.RecordBatch:
    """A record batch from arrays, by name."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
