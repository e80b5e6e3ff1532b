"""Alignment of two tokenizers: token groups per document, corpus-wide counts of linked id pairs.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with byte
fallback, which adds that space itself) the text; both cut the same bytes. A link is a pair of
token occurrences whose bytes overlap; places where tokens of both end cut a document into
groups. Every stretch between neighbouring ends is one link, so links are counted without
comparing tokens.

Corpus counts come from inverted pair bitmaps (``pair_bitmaps``): tasks number their
documents and send, for every bucket of id pairs, the compressed bitmaps of the documents
that hold each pair, with planes for how often. Bitmaps of a bucket are OR-merged for a few
tasks at a time; popcounts of the merged bitmaps, added over these parts, are the documents and
links of each pair. A pair's count and whether it is the highest of its B id then return along the
same postings to the documents.

Both tokenizers cut at white space that precedes a word, so texts are encoded by units (white
space and the word after it), each distinct unit once a task, with its alignment. Texts with
white space other than ASCII's, or with characters that B joins to others (such as \\r), are
units as a whole.

Defined results: a null or empty text, or one whose joined A or B bytes differ from the space and
the text (such as one with U+2581, which B takes for a space), has no tokens: zeros and an empty
``groups``. A blank text has tokens. Repeated rows are counted each; rows without doc_id too. An
empty table gives an empty result. Other columns are dropped, whatever their names.

Scale: texts are read once and never shuffled. Postings are shuffled by bucket and part (of
``TASKS_A_PART`` tasks), so no group grows with the input, and a pair that all documents hold
costs a bit a document. Counts (one row a distinct pair, pre-added in each part) are shuffled by
pair, then sent to each ``PARTS_A_SALT`` parts once. A task's memory is bounded by
``FLUSH_LINKS``, the unit cache and the longest document.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import pair_bitmaps
from ledgerlake.llm._store import stored
from ledgerlake.llm._text import U64, Run, mix, record, slices, workers_find_package
from ledgerlake.llm.packing import units

BUCKETS = 16
TASKS_A_PART = 4  # their documents share one space of 32-bit numbers
TASK_BITS = 30
PARTS_A_SALT = 4
FLUSH_LINKS = 4_000_000  # distinct (pair, document) entries that a task holds before it sends them
CACHE_UNITS = 400_000
CACHE_LINKS = 16_000_000
_PACKED = "part int, number long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, groups_sha256 string, bucket int, posting binary"
_SPACES = "\t\n\x0b\x0c\r"


def _byte_level(token: str) -> bytes:
    """The bytes of a byte-level token: printable characters stand for themselves, others for the rest in order."""
    if not _letters:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        _letters.update({chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)})
    return bytes(_letters[c] for c in token)


_letters: dict[str, int] = {}
_loaded: dict[tuple, Aligner] = {}


class Vocabulary:
    """The bytes of all ids of a tokenizer."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = len(tokens)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        return self.data[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _decimal(ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids in decimal, each with the character ``after`` it; and the length of each."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    digits = np.empty((len(ids), width + 1), np.uint8)
    digits[:, width] = after
    rest = ids.copy()
    for k in range(width - 1, -1, -1):
        rest, digits[:, k] = rest // 10, rest % 10 + 48
    shown = np.ones(digits.shape, dtype=bool)
    for k in range(width - 1):
        shown[:, k] = ids >= 10 ** (width - 1 - k)
    return digits[shown].tobytes(), shown.sum(1)


class Aligner:
    """Two tokenizers, with the alignment of the units met so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, "rb") as f:
            entries = json.load(f)["model"]["vocab"]
        tokens = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, k in entries.items():
            tokens[k] = _byte_level(token)
        self.of_a = Vocabulary(tokens)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.of_b = Vocabulary([bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)])
        if self.of_a.size * self.of_b.size >> 32:
            raise ValueError("pairs of these vocabularies do not fit 32 bits")
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("tokenizer B has pieces across words")
        self.space = self.b.piece_to_id("▁")
        # white space that is part of longer pieces: it is no place to cut
        joins = {c for p in pieces if len(p) > 1 for c in p if c in _SPACES}
        self.joins = np.zeros(256, dtype=bool)
        self.joins[[ord(c) for c in joins]] = True
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.texts: list[bytes] = []  # rendered groups of a unit, each closed by ;
        self.stat = np.zeros((5, 1 << 14), np.int64)  # of a unit: A tokens, B tokens, groups, links, and whether both give its bytes
        self.begin = np.zeros(1 << 14, np.int64)
        self.pairs, self.used = np.zeros(1 << 17, np.uint32), 0

    def _encoded_b(self, unit: list[str]) -> list[list[int]]:
        # B adds a space of its own: it stands for a unit's first one, or is taken off
        bare = [u[1:] if u[0] == " " else u for u in unit]
        found = self.b.encode(bare, num_threads=1)
        for k, u in enumerate(unit):
            if u[0] != " ":
                if found[k][0] != self.space:
                    raise ValueError("tokenizer B joins its first space to white space")
                found[k] = found[k][1:]
            elif not bare[k]:
                found[k] = [self.space]
        return found

    def _add(self, keys: list[int], raw: list[bytes]) -> None:
        """Encode and align new units."""
        text = [r.decode() for r in raw]
        sides = []
        size = np.array([len(r) for r in raw])
        whole = np.frombuffer(b"".join(raw), np.uint8)
        good = np.ones(len(raw), dtype=bool)
        for found, of in (([e.ids for e in self.a.encode_batch_fast(text, add_special_tokens=False)], self.of_a), (self._encoded_b(text), self.of_b)):
            n = np.array([len(x) for x in found])
            ids = np.fromiter(chain.from_iterable(found), np.int64, n.sum())
            owner = np.repeat(np.arange(len(raw)), n)
            same = np.bincount(owner, weights=of.length[ids], minlength=len(raw)) == size
            held = of.joined(ids[same[owner]])
            differs = held != whole[np.repeat(same, size)]
            same[np.repeat(np.flatnonzero(same), size[same])[differs]] = False
            good &= same
            sides.append((ids, owner))
        (a, own_a), (b, own_b) = ((ids[good[owner]], owner[good[owner]]) for ids, owner in sides)
        end_a, end_b = np.cumsum(self.of_a.length[a]), np.cumsum(self.of_b.length[b])
        ends, cuts = np.union1d(end_a, end_b), np.intersect1d(end_a, end_b, assume_unique=True)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs = (a[at_a] * self.of_b.size + b[at_b]).astype(np.uint32)
        m = len(raw)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        to_a, to_b = np.searchsorted(end_a, cuts, side="right"), np.searchsorted(end_b, cuts, side="right")
        place_a = np.arange(len(a)) + np.concatenate([[0], to_b])[group_a]
        place_b = np.arange(len(b)) + to_a[group_b]
        ids, after = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a] = np.where(end_a == cuts[group_a], ord("|"), ord(",")) if len(cuts) else 0
        after[place_b] = np.where(end_b == cuts[group_b], ord(";"), ord(",")) if len(cuts) else 0
        shown, width = _decimal(ids, after)
        owner = np.zeros(len(ids), np.int64)
        owner[place_a], owner[place_b] = own_a, own_b
        stop = np.cumsum(np.bincount(owner, weights=width, minlength=m)).astype(np.int64)
        self.texts += [shown[i:j] for i, j in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]
        n_links = np.bincount(own_a[at_a], minlength=m)
        k = len(self.place)
        while k + m > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.stat = np.concatenate([self.stat, np.zeros_like(self.stat)], axis=1)
        self.stat[:, k : k + m] = [np.bincount(own_a, minlength=m), np.bincount(own_b, minlength=m), np.bincount(own_a[end_a == cuts[group_a]] if len(cuts) else own_a[:0], minlength=m), n_links, good]
        self.begin[k : k + m] = self.used + np.cumsum(n_links) - n_links
        while self.used + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.pairs[self.used : self.used + len(pairs)] = pairs
        self.used += len(pairs)
        self.place.update(zip(keys, range(k, k + m), strict=True))

    def align(self, run: Run, live: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Statistics and rendered groups of each document, and its links: document, pair.

        ``run`` holds the texts, each after a space; documents that are not ``live`` have no tokens.
        """
        if len(self.place) > CACHE_UNITS or self.used > CACHE_LINKS:
            self.clear()
        doc, start, end = units(run)
        joined = np.zeros(run.n, dtype=bool)
        joined[run.owner(np.flatnonzero(self.joins[run.data]))] = True
        if joined.any():
            keep, whole = ~joined[doc], np.flatnonzero(joined)
            doc, start, end = (np.concatenate([x[keep], y]) for x, y in ((doc, whole), (start, run.offsets[whole]), (end, run.offsets[whole + 1])))
        order = np.lexsort((start, doc))
        order = order[live[doc[order]]]
        doc, start, end = doc[order], start[order], end[order]
        keys, first, inverse = np.unique(run.hashes(start, end), return_index=True, return_inverse=True)
        named = keys.tolist()
        new = [k for k, key in enumerate(named) if key not in self.place]
        for i in range(0, len(new), 8192):
            some = new[i : i + 8192]
            self._add([named[k] for k in some], [run.data[start[first[k]] : end[first[k]]].tobytes() for k in some])
        unit = np.fromiter(map(self.place.__getitem__, named), np.int64, len(named))[inverse]
        good = live.copy()
        good[doc[self.stat[4, unit] == 0]] = False
        keep = good[doc]
        doc, unit = doc[keep], unit[keep]
        stats = np.stack([np.bincount(doc, weights=self.stat[j, unit], minlength=run.n) for j in range(4)]).astype(np.int64)
        at = np.searchsorted(doc, np.arange(run.n + 1)).tolist()
        listed = unit.tolist()
        texts = [b"".join(map(self.texts.__getitem__, listed[i:j]))[:-1] for i, j in zip(at[:-1], at[1:], strict=True)]
        size = self.stat[3, unit]
        pairs = self.pairs[np.repeat(self.begin[unit] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return stats, texts, np.repeat(doc, size), pairs


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Aligner(path_a, path_b)
    return _loaded[path_a, path_b]


def _postings(part: int, entries: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    """One row a bucket with its pairs' bitmaps."""
    entry, often = np.concatenate(entries), np.concatenate(times)
    bucket = (mix(entry >> U64(32)) % U64(BUCKETS)).astype(np.int64)
    order = np.lexsort((entry, bucket))
    entry, often, bucket = entry[order], often[order], bucket[order]
    cut = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    packs = [pair_bitmaps.pack(pair_bitmaps.planes_of(entry[i:j], often[i:j])) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    held = [k for k in range(BUCKETS) if cut[k] < cut[k + 1]]
    return _packed(len(held), part=pa.array([part] * len(held), pa.int32()), bucket=pa.array(held, pa.int32()), posting=pa.array([packs[k] for k in held], pa.binary()))


def _packed(n: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in _PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kinds[kind])) for name, kind in fields], names=[name for name, _ in fields])


def _aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool) -> DataFrame:
    """Rows of two kinds: documents (without bucket) and postings (with one)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        which = TaskContext.get().partitionId()
        part, number = which // TASKS_A_PART, (which % TASKS_A_PART) << TASK_BITS
        last = number + (1 << TASK_BITS)
        entries: list[np.ndarray] = []
        times: list[np.ndarray] = []
        for batch in batches:
            text = batch.column(1)
            given = record(doc_id=batch.column(0), live=pc.fill_null(pc.not_equal(pc.binary_length(text), 0), False), text=pc.binary_join_element_wise("", pc.fill_null(text, ""), " "))
            for rows, run in slices(given):
                if number + run.n > last:
                    raise ValueError(f"a task has more than 2**{TASK_BITS} documents")
                stats, texts, doc, pair = aligner.align(run, rows.column(1).to_numpy(zero_copy_only=False).astype(bool))
                entry, n = np.unique((pair.astype(U64) << U64(32)) | (doc.astype(U64) + U64(number)), return_counts=True)
                entries.append(entry)
                times.append(n)
                yield _packed(
                    run.n, part=pa.array([part] * run.n, pa.int32()), number=pa.array(np.arange(number, number + run.n)), doc_id=rows.column(0), n_a=pa.array(stats[0]), n_b=pa.array(stats[1]),
                    n_groups=pa.array(stats[2]), n_links=pa.array(stats[3]), groups=pa.array(texts, pa.binary()) if with_groups else pa.nulls(run.n, pa.binary()),
                    groups_sha256=pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], pa.string()),
                )
                number += run.n
                if sum(map(len, entries)) > FLUSH_LINKS:
                    yield _postings(part, entries, times)
                    entries, times = [], []
        if sum(map(len, entries)):
            yield _postings(part, entries, times)

    workers_find_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, _PACKED)


def _merge(table: pa.Table) -> pa.Table:
    """The bitmaps of a bucket in a part, OR-merged, with their popcounts."""
    planes = pair_bitmaps.merged([p.as_py() for p in table.column("posting")])
    pair, n_docs, n_links = pair_bitmaps.counts(planes)
    row = {"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "part": pa.array([table.column("part")[0].as_py()], pa.int32())}
    for name, value in (("posting", pair_bitmaps.pack(planes)), ("pairs", pair.astype(np.uint32).tobytes()), ("docs", n_docs.tobytes()), ("links", n_links.tobytes())):
        row[name] = pa.array([value], pa.binary())
    return pa.table(row)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, pairs, docs, links in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair = np.frombuffer(pairs, np.uint32).astype(np.int64)
            yield record(bucket=pa.array(np.full(len(pair), bucket, np.int32)), pair=pa.array(pair), n_docs=pa.array(np.frombuffer(docs, np.int64)), n_links=pa.array(np.frombuffer(links, np.int64)))


def _bundle(table: pa.Table) -> pa.Table:
    """The counts of a bucket's pairs, in the order of the pairs, as one row."""
    pair, links, best = (table.column(c).to_numpy() for c in ("pair", "n_links", "best"))
    order = np.argsort(pair)
    row = {"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32())}
    for name, value in (("pairs", pair.astype(np.uint32)), ("links", links.astype(np.int64)), ("best", best.astype(bool))):
        row[name] = pa.array([value[order].tobytes()], pa.binary())
    return pa.table(row)


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            part, posting, pairs, links, best = (batch.column(j)[k].as_py() for j in range(5))
            known, count = np.frombuffer(pairs, np.uint32).astype(U64), np.frombuffer(links, np.int64)
            number, (n_best, total) = pair_bitmaps.sums(pair_bitmaps.unpack(posting), known, [np.frombuffer(best, bool).astype(np.int64), count])
            yield record(part=pa.array(np.full(len(number), part, np.int32)), number=pa.array(number.astype(np.int64)), n_best=pa.array(n_best), count_sum=pa.array(total))


class Alignment:
    """The aligned corpus: ``documents`` and ``pair_counts`` (both over written tables)."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> None:
        spark = docs.sparkSession
        self.size_b = _pieces(path_b)
        rows = stored(_aligned(docs, path_a, path_b, with_groups), "aligned")
        self._rows = rows.where("bucket is null")
        postings = rows.where("bucket is not null").select("bucket", "part", "posting")
        schema = "bucket int, part int, posting binary, pairs binary, docs binary, links binary"
        workers_find_package(spark)
        self._postings = stored(postings.groupBy("bucket", "part").applyInArrow(_merge, schema), "postings")
        counted = self._postings.select("bucket", "pairs", "docs", "links").mapInArrow(_listed, "bucket int, pair long, n_docs long, n_links long")
        added = counted.groupBy("bucket", "pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
        added = stored(added.withColumns({"a": F.floor(F.col("pair") / self.size_b).cast("int"), "b": (F.col("pair") % self.size_b).cast("int")}), "pairs")
        top = added.groupBy("b").agg(F.max("n_links").alias("_top"))
        self._counts = added.join(top, "b").withColumn("best", F.col("n_links") == F.col("_top"))

    def pair_counts(self) -> DataFrame:
        """a, b, n_docs, n_links and whether the count is the highest of b, of every linked id pair."""
        return self._counts.select("a", "b", "n_docs", "n_links", "best")

    def documents(self) -> DataFrame:
        """Statistics of every row of the input, with the scores its postings return."""
        parts = self._postings.agg(F.max("part")).first()[0]
        salts = 1 + (parts or 0) // PARTS_A_SALT
        schema = "bucket int, pairs binary, links binary, best binary"
        bundles = self._counts.select("bucket", "pair", "n_links", "best").groupBy("bucket").applyInArrow(_bundle, schema)
        bundles = bundles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        sent = self._postings.select("bucket", "part", "posting").withColumn("salt", F.col("part") % salts).join(bundles, ["bucket", "salt"])
        scores = sent.select("part", "posting", "pairs", "links", "best").mapInArrow(_returned, "part int, number long, n_best long, count_sum long")
        scores = scores.groupBy("part", "number").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        zero = F.lit(0).cast("long")
        return self._rows.select("part", "number", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256").join(scores, ["part", "number"], "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), F.col("groups").cast("string").alias("groups"), "groups_sha256"
        )


def _pieces(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> Alignment:
    """Align all texts of ``docs`` (doc_id, text); ``with_groups`` keeps the groups' text (``a1,a2|b1;a3|b2,b3``)."""
    return Alignment(docs, path_a, path_b, with_groups)
