"""Finding keys that occur more than once, without moving a row per occurrence.

Tasks send, per run of documents and key bucket, one packed row of 64-bit keys
with their documents and positions. A key met several times within a run sends one
representative marked as repeated; its other places are only marked. So
a key held by a third of all documents costs one entry a run, and a bucket's
size follows the number of distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
OPEN, REPEATED, MARKED = 0, 1, 2  # of an entry: its key was met once in its run; several times; not sent again
PACKED = "bucket int, rows binary, ids binary, counts binary, keys binary, at binary"
STATE_BITS = 30  # a position shares its number with its entry's state


def bucket_count(spark: SparkSession) -> int:
    """Key buckets: several a shuffle partition, so that one is small even when partitions are large."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, a number that equal rows share and others do not."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def split(order_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    edge = np.flatnonzero(np.concatenate([[True], order_key[1:] != order_key[:-1]])) if len(order_key) else np.zeros(0, np.int64)
    return edge, np.diff(np.concatenate([edge, [len(order_key)]]))


def packed(row: np.ndarray, ids: np.ndarray | None, doc: np.ndarray, key: np.ndarray, at: np.ndarray, state: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch | None:
    """One row per bucket from entries; ``row`` and ``ids`` are by document number."""
    if not len(doc):
        return None
    if int(at.max()) >> STATE_BITS:
        raise ValueError(f"a document has positions beyond 2**{STATE_BITS}")
    order = np.lexsort((at, doc, bucket))
    doc, key, bucket = doc[order], key[order], bucket[order]
    at = (at[order].astype(np.uint32)) | (state[order].astype(np.uint32) << np.uint32(STATE_BITS))
    key = np.where(state[order] == MARKED, U64(0), key)
    out: list[list] = [[] for _ in range(6)]
    for b, n in zip(*split(bucket), strict=True):
        d = doc[b : b + n]
        first, count = split(d)
        if count.max() > 0xFFFF:  # a document of very many entries is listed several times
            pieces = -(-count // 0xFFFF)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, count = np.repeat(first, pieces) + nth * 0xFFFF, np.minimum(np.repeat(count, pieces) - nth * 0xFFFF, 0xFFFF)
        whole = (int(bucket[b]), row[d[first]].tobytes(), b"" if ids is None else ids[d[first]].tobytes(), count.astype(np.uint16).tobytes(), key[b : b + n].tobytes(), at[b : b + n].tobytes())
        for column, value in zip(out, whole, strict=True):
            column.append(value)
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["bucket", "rows", "ids", "counts", "keys", "at"])


def unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    """row, id, key, position and state of every entry of a bucket; without ids, rows stand for them."""

    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), dtype=kind)

    counts, rows, ids, at = joined("counts", np.uint16), joined("rows", np.int64), joined("ids", np.int64), joined("at", np.uint32)
    state = (at >> np.uint32(STATE_BITS)).astype(np.uint8)
    return np.repeat(rows, counts), np.repeat(ids if len(ids) else rows, counts), joined("keys", U64), at & np.uint32((1 << STATE_BITS) - 1), state


def local_state(key: np.ndarray) -> np.ndarray:
    """States of a run's entries when any second occurrence counts: the first of a key stands for it."""
    order = np.argsort(key, kind="stable")
    edge, n = split(key[order])
    state = np.full(len(key), MARKED, dtype=np.uint8)
    state[order[edge]] = np.where(n > 1, REPEATED, OPEN)
    return state


def repeated(key: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Which entries of a bucket hold a key that occurs elsewhere too."""
    hit = state != OPEN
    live = np.flatnonzero(state != MARKED)
    order = live[np.argsort(key[live], kind="stable")]
    edge, n = split(key[order])
    again = (n > 1) | (np.add.reduceat(hit[order], edge) > 0 if len(edge) else np.zeros(0, bool))
    hit[order] |= np.repeat(again, n)
    return hit


def resolve(entries: DataFrame, decide: Callable) -> DataFrame:
    """(row, at) of the entries that ``decide(id, key, state)`` marks, bucket by bucket."""

    def task(table: pa.Table) -> pa.Table:
        row, ids, key, at, state = unpacked(table)
        keep = decide(ids, key, state)
        return pa.table({"row": pa.array(row[keep]), "at": pa.array(at[keep].astype(np.int64))})

    return entries.groupBy("bucket").applyInArrow(task, "row long, at long")


def attached(rows: DataFrame, marks: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``marks``, the list of its marks' columns, or null."""
    lists = marks.groupBy("row").agg(F.collect_list(F.struct(*columns) if len(columns) > 1 else F.col(columns[0])).alias("marks"))
    return rows.join(lists, "row", "left")
