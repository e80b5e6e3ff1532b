"""Substring dedup by recompression: repeated word windows, kept once.

Words of a document are recompressed in rounds. A round first names runs of
one symbol, then pairs of a left and a right symbol; sides are told by a bit of
the name. Names are hashes of what they stand for, so the same run or pair has the same
name in every document without a global dictionary. A symbol also knows
the stretch of words that fixed it (its content and the neighbours that the
round looked at): wherever that stretch recurs, so does the symbol.

A window of ``WINDOW`` words is represented by one symbol of the highest round
that the window fixes entirely (the least by name); windows that fix none
represent themselves. Equal windows therefore have equal symbols:

1. symbols with their context are grouped globally; those met once are unique and take
   all windows they represent with them;
2. windows represented by shared symbols are verified by their own names
   (64-bit hashes of all their words): the smallest doc_id that holds one
   keeps it, in every larger one its words are marked;
3. marked words are removed.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Windows are judged on the input.

Defined results: a null or empty text has no words; fewer words than a window
lose none; a null doc_id counts as larger than any other; rows of equal doc_id do not
remove each other's words (there is no smaller id); other columns are
ignored by ``find_repeats`` and kept by ``drop_repeats``; an empty table gives an
empty result.

Scale: see ``_repeats``: shared symbols and windows travel packed, hot ones once a
run of documents. Texts are shuffled twice, to meet their shared symbols and
then their marks; nothing is collected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import _repeats as rep
from ledgerlake.llm._text import Run, map_runs, mix, workers_find_package

U64 = np.uint64
WINDOW = 13
ROUNDS = 2


class Symbols:
    """One round's symbols of a run: name, document, words [start, end), fixed by words [low, high)."""

    def __init__(self, name, doc, start, end, low, high) -> None:
        self.name, self.doc, self.start, self.end, self.low, self.high = name, doc, start, end, low, high

    def neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether the previous and next symbol belong to the same document, and how far they are fixed.

        What looked at a document's border is fixed by a word beyond it only, that is, by no window.
        """
        same = self.doc[1:] == self.doc[:-1]
        edge = np.flatnonzero(np.concatenate([[True], ~same]))
        size = np.diff(np.concatenate([edge, [len(self.doc)]]))
        first, last = np.repeat(self.start[edge], size), np.repeat(self.end[edge + size - 1], size)
        before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
        low = np.where(before, np.concatenate([[0], self.low[:-1]]), first - 1)
        high = np.where(after, np.concatenate([self.high[1:], [0]]), last + 1)
        return before, after, low, high


def name_runs(s: Symbols, salt: int) -> Symbols:
    """Maximal runs of one name become one symbol, named by symbol and length."""
    if not len(s.name):
        return s
    before, _, low, high = s.neighbours()
    head = ~(before & np.concatenate([[False], s.name[1:] == s.name[:-1]]))
    first = np.flatnonzero(head)
    last = np.concatenate([first[1:], [len(head)]]) - 1
    size = last - first + 1
    name = np.where(size > 1, mix(s.name[first] + size.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(salt)), s.name[first])
    # a run is known to be whole where the single symbols at its sides are known
    return Symbols(name, s.doc[first], s.start[first], s.end[last], np.minimum(s.low[first], low[first]), np.maximum(s.high[last], high[last]))


def name_pairs(s: Symbols, salt: int) -> Symbols:
    """Each left symbol followed by a right one becomes a pair."""
    if not len(s.name):
        return s
    before, after, low, high = s.neighbours()
    right = (mix(s.name + U64(salt)) >> U64(63)).astype(bool)
    opens = ~right & after & np.concatenate([right[1:], [False]])
    closes = np.concatenate([[False], opens[:-1]])
    nxt = np.concatenate([s.name[1:], np.zeros(1, U64)])
    name = np.where(opens, mix(mix(s.name + U64(salt + 1)) * U64(0xD6E8FEB86659FD93) + nxt), s.name)
    end = np.where(opens, np.concatenate([s.end[1:], [0]]), s.end)
    # a lone left symbol was told by its next one, a lone right symbol by its previous one
    low = np.where(right, np.minimum(s.low, low), s.low)
    high = np.where(right, s.high, np.maximum(s.high, high))
    keep = ~closes
    return Symbols(name[keep], s.doc[keep], s.start[keep], end[keep], low[keep], high[keep])


def recompress(word: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The symbols after each round, the last round last."""
    at = np.arange(len(word))
    s = Symbols(word, doc, at, at + 1, at, at + 1)
    out = []
    for r in range(rounds):
        s = name_pairs(name_runs(s, 101 + 7 * r), 202 + 7 * r)
        out.append(s)
    return out


class Windows:
    """All windows of a run: place (word number), document, name, and representing symbol."""

    def __init__(self, run: Run) -> None:
        doc, start, end = run.words()
        self.run, self.word_doc, self.start, self.end = run, doc, start, end
        word = run.hashes(start, end)
        counts = np.bincount(doc, minlength=run.n)
        self.first_word = np.concatenate([[0], np.cumsum(counts)])
        n = len(word)
        place = np.arange(n)
        self.place = place[self.first_word[doc + 1] - place >= WINDOW] if n else place
        self.doc = doc[self.place]
        name = np.zeros(len(self.place), U64)
        for k in range(WINDOW):
            name = mix(name * U64(0x9FB21C651E98DF25) + word[self.place + k])
        self.name = name
        # the symbol of the highest round that a window fixes, as (key, position code)
        levels = ROUNDS + 1  # a position code tells a symbol's first word and its round, 0 for the window itself
        self.key, self.code = mix(name + U64(77)), levels * (self.place - self.first_word[self.doc])
        todo = np.ones(len(self.place), dtype=bool)
        for level, s in reversed(list(enumerate(recompress(word, doc), 1))):
            if not todo.any():
                break
            low = np.searchsorted(s.low, self.place, side="left")
            high = np.searchsorted(s.high, self.place + WINDOW, side="right")
            # names with their context: all words that fixed the symbol
            best = np.full(len(self.place), -1, dtype=np.int64)
            rank = np.full(len(self.place), np.iinfo(np.uint64).max, dtype=U64)
            order = mix(s.name + U64(9))
            live = np.flatnonzero(todo & (high > low))
            t = 0
            while len(live):
                j = low[live] + t
                less = order[j] < rank[live]
                rank[live[less]] = order[j[less]]
                best[live[less]] = j[less]
                t += 1
                live = live[low[live] + t < high[live]]
            found = np.flatnonzero(best >= 0)
            if len(found):
                used, back = np.unique(best[found], return_inverse=True)
                key = self._context(word, s, used)
                self.key[found] = key[back]
                self.code[found] = levels * (s.start[best[found]] - self.first_word[self.doc[found]]) + level
                todo[found] = False

    @staticmethod
    def _context(word: np.ndarray, s: Symbols, used: np.ndarray) -> np.ndarray:
        low, high = s.low[used], s.high[used]
        key = mix((high - low).astype(U64) + (s.start[used] - low).astype(U64) * U64(1 << 20) + s.name[used])
        for k in range(WINDOW):
            more = low + k < high
            key = np.where(more, mix(key * U64(0x9FB21C651E98DF25) + word[np.minimum(low + k, len(word) - 1)]), key)
        return key


def _ids(column: pa.Array) -> np.ndarray:
    return np.array([np.iinfo(np.int64).max if x is None else x for x in column.to_pylist()], dtype=np.int64)


def _symbols_of(buckets: int):
    def task(part: pa.RecordBatch, run: Run) -> pa.RecordBatch | None:
        w = Windows(run)
        once = np.flatnonzero(np.concatenate([[True], (w.code[1:] != w.code[:-1]) | (w.doc[1:] != w.doc[:-1])])) if len(w.code) else np.zeros(0, np.int64)
        doc, code, key = w.doc[once], w.code[once], w.key[once]
        order = np.lexsort((code, doc))
        fresh = np.concatenate([[True], (doc[order][1:] != doc[order][:-1]) | (code[order][1:] != code[order][:-1])]) if len(order) else np.zeros(0, bool)
        take = order[fresh]
        doc, code, key = doc[take], code[take], key[take]
        return rep.packed(part.column(2).to_numpy(), None, doc, key, code, rep.local_state(key), (key % U64(buckets)).astype(np.int64))

    return task


def _doc_codes(part: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    marks = part.column(column)
    sizes = np.diff(marks.offsets.to_numpy()) if len(marks) else np.zeros(0, np.int64)
    sizes = np.where(np.array(marks.is_valid().to_pylist(), dtype=bool), sizes, 0)
    return np.repeat(np.arange(len(sizes)), sizes), marks.flatten().to_numpy(zero_copy_only=False)


def _windows_of(buckets: int):
    def task(part: pa.RecordBatch, run: Run) -> pa.RecordBatch | None:
        w = Windows(run)
        d, code = _doc_codes(part, 3)
        keep = np.isin((w.doc << 33) | w.code, (d << 33) | code)
        doc, place, name, key = w.doc[keep], (w.place - w.first_word[w.doc])[keep], w.name[keep], w.key[keep]
        ids = _ids(part.column(0))
        # within the run: the first place in each row of the smallest id stands for the window, larger ids are marked at once
        order = np.lexsort((place, doc, ids[doc], name))
        edge, n = rep.split(name[order])
        least = np.repeat(ids[doc[order[edge]]], n)
        state = np.where(ids[doc[order]] > least, rep.MARKED, rep.REPEATED).astype(np.uint8)
        row = doc[order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = row[1:] != row[:-1]
        first[edge] = True
        state[first & (state == rep.REPEATED)] = rep.OPEN
        # further places in the same row follow from the first one when marks are applied
        sent = state != rep.REPEATED
        pick = order[sent]
        return rep.packed(part.column(2).to_numpy(), ids, doc[pick], name[pick], place[pick], state[sent], (key[pick] % U64(buckets)).astype(np.int64))

    return task


def _larger(ids: np.ndarray, key: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Entries whose window also starts in a document of smaller id."""
    hit = state == rep.MARKED
    live = np.flatnonzero(state == rep.OPEN)
    order = live[np.lexsort((ids[live], key[live]))]
    edge, n = rep.split(key[order])
    hit[order] |= ids[order] > np.repeat(ids[order[edge]], n)
    return hit


def marked_windows(rows: DataFrame) -> DataFrame:
    """(row, at): first word numbers of windows that a smaller doc_id holds too."""
    spark = rows.sparkSession
    workers_find_package(spark)
    buckets = rep.bucket_count(spark)
    shared = rep.resolve(map_runs(rows, ["doc_id", "text", "row"], _symbols_of(buckets), rep.PACKED), lambda ids, key, state: rep.repeated(key, state))
    candidates = rep.attached(rows, shared, "at").where(F.col("marks").isNotNull())
    return rep.resolve(map_runs(candidates, ["doc_id", "text", "row", "marks"], _windows_of(buckets), rep.PACKED), _larger)


def _removed(w: Windows, part: pa.RecordBatch, column: int) -> np.ndarray:
    """Which words go, given the marked windows of each document."""
    d, place = _doc_codes(part, column)
    hit = np.zeros(len(w.place), dtype=bool)
    if len(d):
        at = w.first_word[d] + place
        marked = np.zeros(len(w.word_doc) + 1, dtype=bool)
        marked[at] = True
        hit = marked[w.place]
        # the same window elsewhere in the same document goes as well
        key = mix(w.name + mix(w.doc.astype(U64) + U64(1)))
        hit = np.isin(key, np.unique(key[hit]))
    change = np.zeros(len(w.word_doc) + 1, dtype=np.int64)
    np.add.at(change, w.place[hit], 1)
    np.add.at(change, w.place[hit] + WINDOW, -1)
    return np.cumsum(change)[:-1] > 0


def _kept_words(w: Windows, gone: np.ndarray) -> list[bytes]:
    """Each document's kept words joined by one space."""
    raw = w.run.data.tobytes()
    out = []
    for i in range(w.run.n):
        a, b = w.first_word[i], w.first_word[i + 1]
        if not gone[a:b].any():
            out.append(b" ".join(raw[w.run.offsets[i] : w.run.offsets[i + 1]].split()))
        else:
            some = np.arange(a, b)[~gone[a:b]]
            out.append(b" ".join([raw[s:e] for s, e in zip(w.start[some].tolist(), w.end[some].tolist(), strict=True)]))
    return out


def find_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    rows = rep.with_row(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        w = Windows(run) if part.column(2).null_count < run.n else _Words(run)
        gone = _removed(w, part, 2)
        kept = [hashlib.sha256(k).hexdigest() for k in _kept_words(w, gone)]
        words = np.diff(w.first_word)
        removed = np.bincount(w.word_doc, weights=gone, minlength=run.n).astype(np.int64)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(removed), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return map_runs(rep.attached(rows, marked_windows(rows), "at"), ["doc_id", "text", "marks"], digest, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


class _Words:
    """Words of a run without any mark: no windows are needed."""

    def __init__(self, run: Run) -> None:
        self.run = run
        self.word_doc, self.start, self.end = run.words()
        self.first_word = np.concatenate([[0], np.cumsum(np.bincount(self.word_doc, minlength=run.n))])
        self.place = np.zeros(0, np.int64)
        self.doc, self.name = self.place, np.zeros(0, U64)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, with repeated words removed from ``text``.

    A text that loses words becomes its kept words joined by one space; other texts are unchanged.
    """
    rows = rep.with_row(docs)
    names = docs.columns
    # the row number must not clash with a column of the documents
    marks = marked_windows(rows).groupBy("row").agg(F.collect_list("at").alias("marks"))
    tagged = docs.select(F.struct(*names).alias("document"), "text", F.xxhash64("doc_id", "text").alias("row"))

    def cut(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        w = Windows(run) if part.column(2).null_count < run.n else _Words(run)
        gone = _removed(w, part, 2)
        lost = np.bincount(w.word_doc, weights=gone, minlength=run.n) > 0
        old = part.column(1).to_pylist()
        kept = _kept_words(w, gone) if lost.any() else []
        new = [kept[i].decode("utf-8", "replace") if lost[i] else old[i] for i in range(run.n)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(new, pa.string())], names=["document", "kept"])

    schema = f"document {tagged.schema['document'].dataType.simpleString()}, kept string"
    out = map_runs(tagged.join(marks, "row", "left"), ["document", "text", "marks"], cut, schema)
    return out.select(*[F.col("kept").alias("text") if c == "text" else F.col("document")[c].alias(c) for c in names])
