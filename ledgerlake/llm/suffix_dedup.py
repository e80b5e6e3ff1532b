"""Suffix-array dedup: every byte inside a string of ``LENGTH`` bytes that starts twice goes.

Sorting all suffixes of a corpus together would move each byte LENGTH times, so
text is first divided into regions that can be sorted apart:

1. Every window of LENGTH bytes is represented by its least ``GRAM``-byte gram
   (by hash; leftmost of equals). Equal windows have equal grams. Grams that occur
   once anywhere rule out all windows they represent.
2. For each shared gram, the stretch of text that covers its windows goes to the gram's
   bucket: all equal windows meet there. Stretches of equal content are
   repeats at once; one of them stands for all.
3. A bucket's distinct stretches form texts of up to ``PART`` bytes, whole grams each.
   A gram with more is divided by longer grams, as the corpus was by short ones: equal
   windows have equal ones again, and those that occur once rule out theirs.
   A text's suffixes are sorted in two stages: those smaller than their successor are sorted directly, by LENGTH
   bytes; the others are induced from them by scanning the first-byte buckets.
   Neighbours in suffix order with a common prefix of LENGTH bytes are
   repeated windows.
4. The bytes of repeated windows are removed.

Texts are UTF-8 bytes; matches stay within documents; overlaps count; strings are judged
on the input, and all copies go.

Defined results: a null or empty text has no bytes; a text shorter than LENGTH
keeps all; repeated rows repeat each other's strings, so both lose them; doc_id may be null;
other columns are ignored by ``find_repeats`` and kept by ``drop_repeats``, where what
remains is decoded with replacement of broken characters; an empty table gives an empty result.

Scale: see ``_repeats``; grams and stretches travel packed, hot ones once a
run of documents. Texts are shuffled twice, to meet their shared grams and their
marks. What is sorted at once is bounded by ``PART``, however many distinct stretches one
gram has; they are held besides, each byte once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import _repeats as rep
from ledgerlake.llm._text import Run, map_runs, mix, powers, workers_find_package

U64 = np.uint64
LENGTH = 200
GRAM = 40
PART = 1 << 18
STRETCHES = "bucket int, rows binary, starts binary, sizes binary, keys binary, state binary, bytes binary"


def windows(run: Run, length: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and document of each window, and the start of the gram of ``length`` bytes that represents it."""
    n = len(run.data)
    size = np.diff(run.offsets)
    none = np.zeros(0, np.int64)
    if n < LENGTH or (size < LENGTH).all():
        return none, none, none
    s, (_, down) = run.sums(), powers(n)
    grams = n - length + 1
    bits = U64(max(int(grams).bit_length(), 1))
    value = (mix((s[length:] - s[:-length]) * down[:grams]) >> bits << bits) | np.arange(grams, dtype=U64)
    # least of LENGTH - length + 1 neighbouring grams, by doubling
    width, span = LENGTH - length + 1, 1
    least = value
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    count = np.maximum(size - LENGTH + 1, 0)
    doc = np.repeat(np.arange(run.n), count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + run.offsets[doc]
    return start, doc, (least[start] & U64((1 << int(bits)) - 1)).astype(np.int64)


def _grams_of(buckets: int):
    def task(part: pa.RecordBatch, run: Run) -> pa.RecordBatch | None:
        start, doc, gram = windows(run)
        if not len(start):
            return None
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        doc, gram = doc[first], gram[first]
        key = run.hashes(gram, gram + GRAM)
        return rep.packed(part.column(1).to_numpy(), None, doc, key, gram - run.offsets[doc], rep.local_state(key), (key % U64(buckets)).astype(np.int64))

    return task


def _listed(part: pa.RecordBatch, column: int) -> tuple[np.ndarray, pa.Array]:
    marks = part.column(column)
    valid = np.array(marks.is_valid().to_pylist(), dtype=bool)
    sizes = np.where(valid, np.diff(marks.offsets.to_numpy()), 0) if len(marks) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), marks.flatten()


def _packed_bytes(raw: bytes) -> bytes:
    """Size and zstd form: stretches are most of what is shuffled."""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpacked_bytes(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _stretches_of(buckets: int):
    def task(part: pa.RecordBatch, run: Run) -> pa.RecordBatch | None:
        start, doc, gram = windows(run)
        d, at = _listed(part, 2)
        shared = np.zeros(len(run.data) + 1, dtype=bool)
        shared[run.offsets[d] + at.to_numpy(zero_copy_only=False)] = True
        keep = shared[gram] if len(gram) else np.zeros(0, bool)
        start, doc, gram = start[keep], doc[keep], gram[keep]
        if not len(start):
            return None
        edge, n = rep.split(gram)
        begin, end, gram, doc = start[edge], start[edge + n - 1] + LENGTH, gram[edge], doc[edge]
        key, content = run.hashes(gram, gram + GRAM), run.hashes(begin, end)
        state = rep.local_state(content)
        bucket = (key % U64(buckets)).astype(np.int64)
        order = np.lexsort((begin, key, bucket))
        rows, raw = part.column(1).to_numpy(), run.data
        out: list[list] = [[] for _ in range(7)]
        for b, k in zip(*rep.split(bucket[order]), strict=True):
            o = order[b : b + k]
            sent = o[state[o] != rep.MARKED]
            columns = (
                int(bucket[o[0]]), rows[doc[o]].tobytes(), (begin - run.offsets[doc])[o].astype(np.uint32).tobytes(), (end - begin)[o].astype(np.uint32).tobytes(), key[o].tobytes(), state[o].tobytes(),
                _packed_bytes(b"".join(raw[x:y].tobytes() for x, y in zip(begin[sent].tolist(), end[sent].tolist(), strict=True))),
            )
            for column, value in zip(out, columns, strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int32(), *[pa.binary()] * 6], strict=True)], names=["bucket", "rows", "starts", "sizes", "keys", "state", "bytes"])

    return task


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Positions of all non-zero bytes in suffix order, to ``depth`` bytes at least.

    ``text`` has bytes 1 to 255 in parts that each end with a 0, which is
    smaller than all and ends a comparison.
    """
    n = len(text)
    # a suffix is smaller than its successor where its first byte is, or would be at the end of a run of equal bytes
    after = np.concatenate([text[1:], np.zeros(1, text.dtype)])
    differs = np.flatnonzero(text != after)
    small = np.concatenate([(text < after)[differs], [False]])[np.searchsorted(differs, np.arange(n))]
    small &= text != 0
    # stage one: sort those directly
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    chosen = np.flatnonzero(small)
    # what follows a 0 belongs to another part and must not decide
    zero = np.flatnonzero(text == 0)
    rows = view[chosen]
    room = zero[np.searchsorted(zero, chosen)] - chosen if len(chosen) else chosen
    short = np.flatnonzero(room < depth)
    for k in range(0, len(short), 8192):
        some = short[k : k + 8192]
        rows[some] = np.where(np.arange(depth)[None] < room[some][:, None], rows[some], 0)
    direct = chosen[np.argsort(rows.view(f"S{depth}").ravel(), kind="stable")]
    del rows
    # stage two: scan the buckets of first bytes upwards, each inducing the larger suffixes before its own
    direct_byte = text[direct]
    cut = np.searchsorted(direct_byte, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    larger = ~small & (text != 0)

    def induce(found: np.ndarray, c: int) -> np.ndarray:
        """Predecessors that are larger; those of byte ``c`` are returned, others wait in their bucket."""
        before = found[found > 0] - 1
        before = before[larger[before]]
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        edge, k = rep.split(byte[order])
        for e, m in zip(edge, k, strict=True):
            if byte[order[e]] != c:
                waiting[byte[order[e]]].append(before[order[e : e + m]])
        return before[byte == c]

    induce(zero, 0)
    for c in range(1, 256):
        queue = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(queue):
            out.append(queue)
            queue = induce(queue, c)
        own = direct[cut[c] : cut[c + 1]]
        if len(own):
            out.append(own)
            induce(own, c)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_starts(text: np.ndarray, live: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which ``live`` positions start a string of ``length`` bytes that another live one starts too.

    Neighbours in suffix order are compared: equal strings stand together.
    """
    hit = np.zeros(len(text), dtype=bool)
    order = suffix_order(text, length)
    order = order[live[order]]
    if len(order) < 2:
        return hit
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(length, np.uint8)]), length)
    for k in range(0, len(order) - 1, 65536):
        a, b = order[k : min(k + 65536, len(order) - 1)], order[k + 1 : k + 65537]
        # common prefixes, from short to full: most neighbours part early
        same = np.flatnonzero((view[a, length - 1] == view[b, length - 1]) & (text[a] == text[b]))
        same = same[(view[a[same]] == view[b[same]]).all(axis=1)]
        hit[a[same]] = hit[b[same]] = True
    return hit


def _one_of_each(raw: np.ndarray, at: np.ndarray, size: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``some`` stretches have the content of another of them; one of each content.

    Contents that share a hash by chance both stay.
    """
    known: dict[int, int] = {}
    again = np.zeros(len(at), dtype=bool)
    distinct = []
    for i in some.tolist():
        content = raw[at[i] : at[i] + size[i]].tobytes()
        j = known.setdefault(hash(content), i)
        if j != i and raw[at[j] : at[j] + size[j]].tobytes() == content:
            again[i] = again[j] = True
        else:
            distinct.append(i)
    return again, np.array(distinct, dtype=np.int64)


def _divided(raw: np.ndarray, at: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches around grams of ``length`` bytes that several places hold: stretch they are part of, start in it, size, key."""
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, U64))]
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(at):
        j = max(int(np.searchsorted(total, total[i] + PART, side="right")) - 1, i + 1)
        run = Run(pa.array([raw[a : a + n].tobytes() for a, n in zip(at[i:j].tolist(), size[i:j].tolist(), strict=True)], pa.binary()))
        start, doc, gram = windows(run, length)
        edge, n = rep.split(gram)
        begin, doc, gram = start[edge], doc[edge], gram[edge]
        found.append(((i + doc).astype(np.int32), (begin - run.offsets[doc]).astype(np.int32), (n - 1 + LENGTH).astype(np.int32), run.hashes(gram, gram + length)))
        i = j
    owner, begin, n, key = (np.concatenate(x) for x in zip(*found, strict=True))
    shared = rep.repeated(key, np.full(len(key), rep.OPEN, np.uint8))
    return owner[shared].astype(np.int64), begin[shared].astype(np.int64), n[shared].astype(np.int64), key[shared]


def _in_parts(raw: np.ndarray, at: np.ndarray, size: np.ndarray, key: np.ndarray, length: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of distinct stretches ``raw[at : at + size]`` with the keys of their grams of ``length`` bytes: (stretch, start, end) of repeated ranges."""
    order = np.argsort(key, kind="stable")
    # groups of one gram with a single distinct stretch still may repeat within it
    edge, n = rep.split(key[order])
    total = np.add.reduceat(size[order], edge) if len(edge) else edge
    parts, large, held = [], [], PART
    for e, k, bytes_ in zip(edge.tolist(), n.tolist(), total.tolist(), strict=True):
        members = order[e : e + k]
        if bytes_ > PART and k > 1 and length < LENGTH:
            large.append(members)
        elif held + bytes_ > PART:
            parts.append([members])
            held = bytes_
        else:
            parts[-1].append(members)
            held += bytes_
    for part in parts:
        members = np.concatenate(part)
        room = size[members] + 1
        text = np.zeros(int(room.sum()), np.uint8)
        live = np.zeros(len(text), dtype=bool)
        base = np.cumsum(room) - room
        for b, i in zip(base.tolist(), members.tolist(), strict=True):
            text[b : b + size[i]] = raw[at[i] : at[i] + size[i]] + 1  # UTF-8 has no byte 255
            live[b : b + size[i] - LENGTH + 1] = True
        hit = np.flatnonzero(repeated_starts(text, live))
        if len(hit):
            owner = np.searchsorted(base, hit, side="right") - 1
            joint = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])])
            first = np.flatnonzero(joint)
            last = np.concatenate([first[1:], [len(hit)]]) - 1
            yield members[owner[first]], hit[first] - base[owner[first]], hit[last] - base[owner[first]] + LENGTH
    longer = (length + LENGTH + 1) // 2
    for members in large:
        owner, begin, n, sub = _divided(raw, at[members], size[members], longer)
        owner = members[owner]
        again, distinct = _one_of_each(raw, at[owner] + begin, n, np.arange(len(owner)))
        yield owner[again], begin[again], (begin + n)[again]
        for i, a, b in _in_parts(raw, (at[owner] + begin)[distinct], n[distinct], sub[distinct], longer):
            i = distinct[i]
            yield owner[i], begin[i] + a, begin[i] + b


def _covered(table: pa.Table) -> pa.Table:
    """(row, start, end) of repeated byte ranges among a bucket's stretches."""

    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), dtype=kind)

    row, start, size, key, state = joined("rows", np.int64), joined("starts", np.uint32).astype(np.int64), joined("sizes", np.uint32).astype(np.int64), joined("keys", U64), joined("state", np.uint8)
    sent = np.flatnonzero(state != rep.MARKED)
    at = np.zeros(len(row), np.int64)
    at[sent] = np.cumsum(size[sent]) - size[sent]
    raw, filled = np.zeros(int(size[sent].sum()), np.uint8), 0
    for x in table.column("bytes"):
        some = np.frombuffer(_unpacked_bytes(x.as_py()), np.uint8)
        raw[filled : filled + len(some)] = some
        filled += len(some)
    again, distinct = _one_of_each(raw, at, size, sent)
    whole = (state != rep.OPEN) | again  # of equal content within a run, or elsewhere
    rows, starts, ends = [row[whole]], [start[whole]], [(start + size)[whole]]
    for i, a, b in _in_parts(raw, at[distinct], size[distinct], key[distinct]):
        i = distinct[i]
        rows.append(row[i])
        starts.append(start[i] + a)
        ends.append(start[i] + b)
    return pa.table({"row": np.concatenate(rows), "start": np.concatenate(starts), "end": np.concatenate(ends)})


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """(row, start, end): byte ranges of strings of LENGTH bytes that start elsewhere too."""
    spark = rows.sparkSession
    workers_find_package(spark)
    buckets = rep.bucket_count(spark) // 2  # a run sends a row a bucket: of half as many, larger ones, less is lost to small rows
    shared = rep.resolve(map_runs(rows, ["text", "row"], _grams_of(buckets), rep.PACKED), lambda ids, key, state: rep.repeated(key, state))
    candidates = rep.attached(rows, shared, "at").where(F.col("marks").isNotNull())
    return map_runs(candidates, ["text", "row", "marks"], _stretches_of(buckets), STRETCHES).groupBy("bucket").applyInArrow(_covered, "row long, start long, end long")


def _gone(run: Run, part: pa.RecordBatch, column: int) -> np.ndarray:
    """Which bytes go, given each document's ranges."""
    change = np.zeros(len(run.data) + 1, dtype=np.int64)
    d, ranges = _listed(part, column)
    if len(d):
        np.add.at(change, run.offsets[d] + ranges.field("start").to_numpy(zero_copy_only=False), 1)
        np.add.at(change, run.offsets[d] + ranges.field("end").to_numpy(zero_copy_only=False), -1)
    return np.cumsum(change)[:-1] > 0


def _kept(run: Run, gone: np.ndarray) -> list[bytes]:
    out = []
    for a, b in zip(run.offsets[:-1], run.offsets[1:], strict=True):
        out.append(run.data[a:b][~gone[a:b]].tobytes())
    return out


def find_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = rep.with_row(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        gone = _gone(run, part, 2)
        total = np.concatenate([[0], np.cumsum(gone)])
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        inner = run.offsets[:-1][np.diff(run.offsets) > 0]
        edge[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(edge)])
        kept = [hashlib.sha256(k).hexdigest() for k in _kept(run, gone)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(run.offsets)), pa.array(np.diff(total[run.offsets])), pa.array(np.diff(spans[run.offsets])), pa.array(kept, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    joined = rep.attached(rows, repeated_ranges(rows), "start", "end")
    return map_runs(joined, ["doc_id", "text", "marks"], digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, with repeated bytes removed from ``text``."""
    names = docs.columns
    marks = repeated_ranges(rep.with_row(docs)).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    tagged = docs.select(F.struct(*names).alias("document"), "text", F.xxhash64("doc_id", "text").alias("row"))

    def cut(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        gone = _gone(run, part, 2)
        old = part.column(1).to_pylist()
        kept = _kept(run, gone) if gone.any() else None
        new = [o if kept is None or o is None else k.decode("utf-8", "replace") for o, k in zip(old, kept or old, strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(new, pa.string())], names=["document", "kept"])

    schema = f"document {tagged.schema['document'].dataType.simpleString()}, kept string"
    out = map_runs(tagged.join(marks, "row", "left"), ["document", "text", "marks"], cut, schema)
    return out.select(*[F.col("kept").alias("text") if c == "text" else F.col("document")[c].alias(c) for c in names])
