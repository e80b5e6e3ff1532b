"""Packing: byte-level BPE ids cut into pieces and packed shortest pack first.

Every document becomes its token ids and a closing id 0, cut into pieces of at
most ``MAX_LENGTH``. The counts of piece lengths are a histogram of at most
MAX_LENGTH numbers, whatever the corpus; on it, lengths are placed longest
first, each into the shortest pack (most room left) that takes it, and packs are
kept as patterns with counts, so the packing costs the same for any number
of documents. Pieces then learn their place by rank: the r-th piece of a length
takes the r-th slot for that length.

Tokenising uses that white space followed by a word is a token boundary's
unit: the tokenizer's splitting pattern never looks back, so a unit's ids do
not depend on its surroundings. A worker encodes distinct units once, up to ``CACHE_UNITS``, and keeps them in arrays
(some 40 bytes a unit; they stay with the worker after the stage). Texts
with white space other than ASCII's are encoded whole. The tokenizer is used as its file
has it: the string of a special token in a text becomes that token.

Defined results: a null or empty text is the single id 0; a document's last
piece may be short, all others are MAX_LENGTH; ids and ranks are
ordered by (doc_id, start), null ids first; repeated rows give repeated pieces, each with
its own place; an empty table packs into nothing. Sequences are gapless from
offset 0. Other columns are dropped.

Scale: texts are read once; only 40 bytes a piece are written and shuffled.
Ranks are taken in blocks of ``RANK_BLOCK`` expected pieces of a length, so that
a length holding a third of the pieces is not one task's work, and a block's
offset is added from block counts.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm._store import stored
from ledgerlake.llm._text import Run, map_runs, workers_find_package

MAX_LENGTH = 1024
END = 0
RANK_BLOCK = 500
CACHE_UNITS = 1_000_000
_loaded: dict = {}
# Second bytes and after of white space that is not ASCII, in UTF-8 (fixed values).
_WIDE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80", *[bytes([0xE2, 0x80, 0x80 + k]) for k in range(11)]]


class Units:
    """A tokenizer with the ids of the units met so far."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes of units, ascending, and their numbers
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 1
        self.start, self.length, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 1
        self.ids[0], self.length[0] = END, 1  # unit 0 closes a document

    def _add(self, ids: list[int]) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        if self.count == len(self.start):
            self.start, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[self.count], self.length[self.count] = self.used, len(ids)
        self.used += len(ids)
        self.count += 1

    def encode(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents in a row, and each document's number of ids."""
        if self.count > CACHE_UNITS:
            self.clear()
        doc, start, end = units(run)
        key = run.hashes(start, end)
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = np.append(self.keys, np.uint64(0))[at] == uniq
        known[at == len(self.keys)] = False
        place = np.append(self.place, np.int32(0))[at].astype(np.int64)
        new = np.flatnonzero(~known)
        for a in range(0, len(new), 8192):
            some = new[a : a + 8192]
            texts = [run.data[start[i] : end[i]].tobytes().decode("utf-8", "replace") for i in first[some]]
            for k, got in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                place[k] = self.count
                self._add(got.ids)
        self.keys, self.place = np.insert(self.keys, at[new], uniq[new]), np.insert(self.place, at[new], place[new])
        unit = np.insert(place[inverse], np.searchsorted(doc, np.arange(run.n), side="right"), 0)
        owner = np.sort(np.concatenate([doc, np.arange(run.n)]))
        size = self.length[unit]
        begin = np.cumsum(size) - size
        ids = self.ids[np.repeat(self.start[unit] - begin, size) + np.arange(size.sum())]
        return ids, np.bincount(owner, weights=size, minlength=run.n).astype(np.int64)


def units(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of text that encode alike anywhere: document, start, end.

    White space and the word after it; white space at a text's end; a text
    with wide white space or separator controls as a whole.
    """
    doc, _, end = run.words()
    tail = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=run.n))])
    last = np.where(np.diff(tail) > 0, end[np.maximum(tail[1:] - 1, 0)] if len(end) else 0, run.offsets[:-1])
    rest = np.flatnonzero(last < run.offsets[1:])  # documents that end in white space
    doc = np.concatenate([doc, rest])
    end = np.concatenate([end, run.offsets[1:][rest]])
    order = np.lexsort((end, doc))
    doc, end = doc[order], end[order]
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    start = np.maximum(start, run.offsets[doc])
    suspect = np.zeros(run.n, dtype=bool)
    data = run.data
    if ((data >= 0x1C) & (data <= 0x1F)).any():
        suspect[run.owner(np.flatnonzero((data >= 0x1C) & (data <= 0x1F)))] = True
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        text = data.tobytes()
        wide = [k for k in lead.tolist() if text[k : k + 2] in _WIDE_SPACES or text[k : k + 3] in _WIDE_SPACES]
        if wide:
            suspect[run.owner(np.array(wide))] = True
    if suspect.any():
        keep = ~suspect[doc]
        whole = np.flatnonzero(suspect)
        doc, start, end = np.concatenate([doc[keep], whole]), np.concatenate([start[keep], run.offsets[whole]]), np.concatenate([end[keep], run.offsets[whole + 1]])
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
    return doc, start, end


def _units(tokenizer: str) -> Units:
    """One for all tasks of a worker: units met in one task are known in the next."""
    if tokenizer not in _loaded:
        _loaded[tokenizer] = Units(tokenizer)
    return _loaded[tokenizer]


def pieces(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, with_ids: bool = False) -> DataFrame:
    """Every document's pieces: doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for."""

    def cut(part: pa.RecordBatch, run: Run, known: Units) -> pa.RecordBatch:
        ids, counts = known.encode(run)
        begin = np.concatenate([[0], np.cumsum(counts)])
        n = -(-counts // max_length)
        owner = np.repeat(np.arange(run.n), n)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * max_length
        length = np.minimum(counts[owner] - start, max_length)
        at = begin[owner] + start
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = np.array([zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)], dtype=np.int64)
        columns = [part.column(0).take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc), pa.array(counts[owner])]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([at, begin[-1:]]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return map_runs(docs, ["doc_id", "text"], cut, schema, setup=lambda: _units(tokenizer))


def shortest_pack_first(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[int, list[int]]]:
    """Packing patterns (count, lengths) that hold every piece of the histogram.

    Lengths are placed longest first. Packs are kept by used length; each
    length goes to the shortest packs while they have room, splitting a
    pattern's count where it runs out, and into new packs else.
    """
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    for length in sorted((k for k, c in histogram.items() if c), reverse=True):
        left = histogram[length]
        placed: list[tuple[int, list[int]]] = []
        for used in sorted(open_):
            if used + length > max_length:
                break
            while left and open_[used]:
                count, pattern = open_[used].pop()
                take = min(count, left)
                if take < count:
                    open_[used].append((count - take, pattern))
                placed.append((take, [*pattern, length]))
                left -= take
            if not left:
                break
        # a pack that has room for it may take the same length again
        again = [p for p in placed if sum(p[1]) + length <= max_length] if left else []
        while left and again:
            again.sort(key=lambda p: -sum(p[1]))
            count, pattern = again.pop()
            placed.remove((count, pattern))
            take = min(count, left)
            if take < count:
                placed.append((count - take, pattern))
            grown = (take, [*pattern, length])
            placed.append(grown)
            left -= take
            if sum(grown[1]) + length <= max_length:
                again.append(grown)
        if left:
            fits = max_length // length
            if left >= fits:
                placed.append((left // fits, [length] * fits))
            if left % fits:
                placed.append((1, [length] * (left % fits)))
        for count, pattern in placed:
            open_.setdefault(sum(pattern), []).append((count, pattern))
    return [p for used in sorted(open_, reverse=True) for p in open_[used]]


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length its slots in order of rank: (first rank, first sequence, offset)."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            out.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + count
            offset += length
        sequence += count
    return out


def ranked(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with ``rank``, 0 to count - 1 within their length, in blocks."""
    blocks = F.element_at(F.create_map(*[F.lit(x) for k, c in counts.items() for x in (int(k), -(-int(c) // RANK_BLOCK))]), F.col("length"))
    split = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), blocks).cast("int"))
    sizes = split.groupBy("length", "block").agg(F.count("*").alias("size"))
    before = sizes.select("length", "block", (F.sum("size").over(Window.partitionBy("length").orderBy("block")) - F.col("size")).alias("before"))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    return split.withColumn("within", F.row_number().over(order) - 1).join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("within")).drop("block", "before", "within")


def pack(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """All pieces with their sequence_id and offset there."""
    spark = docs.sparkSession
    workers_find_package(spark)
    cut = stored(pieces(docs, tokenizer, max_length), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most max_length rows
    if not counts:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    where = slots(shortest_pack_first(counts, max_length))
    flat = [(k, *s) for k in sorted(where) for s in where[k]]
    table = np.array(flat, dtype=np.int64)
    key = table[:, 0] * (1 << 48) + table[:, 1]
    rows = ranked(cut, counts)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(table[i, 2] + rank - table[i, 1]), pa.array(table[i, 3])], names=[*names, "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select(*names, "rank").mapInArrow(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
