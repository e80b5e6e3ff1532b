"""Periodic runs: stretches of words that repeat themselves at a fixed distance.

A run is a stretch of consecutive words whose smallest period is q (words q apart are
identical), of at least ``MIN_WORDS`` words and ``MIN_TIMES`` periods, that neither
neighbouring word extends. Seed-and-extend on the diagonals of a document against itself:

1. Lags are taken in classes, 1 to 15, 16 to 31, 32 to 63 and so on. A run whose period lies
   in a class agrees with itself, shifted by its period, over at least ``k`` words, and
   ``k`` (16, 32, 64, ...) is more than the period: the guaranteed overlap.
2. The k-grams of a document are indexed by sorting, and each occurrence is paired with the
   next one of the same gram in the same document. No other pairs are needed: an occurrence in
   between would, as the gram is longer than the period, give the run a smaller period.
   So a text of one word repeated has as many pairs as words, not their square.
3. A pair is a seed on the diagonal of its lag. Seeds are extended word by word to both sides;
   a table per lag of the furthest word covered skips seeds inside a stretch already extended.

Grams of 2k words are only looked for where a gram of k words occurs again, so that
ordinary prose costs one sort of its words.

Defined results: a null, empty or blank text has no words and no runs, and an empty
collapsed text; repeated rows give repeated rows; rows without doc_id are treated like others;
an empty table gives an empty result. Other columns are dropped, whatever their names.

Scale: one pass over the texts and no shuffle. A document is the unit of work: it takes about
60 bytes a byte of text, and n log n steps for n words whatever its repeats, since stretches
of at least two periods have a total length bounded by n log n. Words are
compared by 64-bit hashes within their document only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._text import U64, Run, map_runs, mix, record

MIN_WORDS = 24  # of a run
MIN_TIMES = 3  # periods in a run
FIRST_GRAM = 16  # words; any run of a period under 16 overlaps itself by as many
_STEP = U64(0x9FB21C651E98DF25)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words of ``a`` and ``b`` are the same; cost follows the answer."""
    done, step, limit = 0, 32, min(len(a), len(b))
    while done < limit:
        differs = np.flatnonzero(a[done : done + step][: limit - done] != b[done : done + step][: limit - done])
        if len(differs):
            return done + int(differs[0])
        done += step
        step *= 2
    return limit


def _seeds(gram: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences paired with the next one of the same gram and document (place, lag); and which places repeat."""
    key = mix(gram[at] + doc[at].astype(U64) * _STEP)
    order = np.argsort(key, kind="stable")  # equal keys stay in the order of their places
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    first, second = at[order[same]], at[order[same + 1]]
    again = np.zeros(len(gram), dtype=bool)
    again[first] = again[second] = True
    return first, second - first, again


def _stretches(words: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs; ``bounds`` are the documents' first words and the end."""
    n = len(words)
    left = bounds[doc + 1] - np.arange(n)  # words from here to the document's end
    gram, size = words, 1
    while size < FIRST_GRAM:
        gram = mix(gram * _STEP + np.concatenate([gram[size:], np.zeros(min(size, n), U64)])[:n])
        size *= 2
    found, low, at = [], 1, np.flatnonzero(left >= size)
    while len(at):
        place, lag, again = _seeds(gram, doc, at)
        fits = np.flatnonzero((lag >= low) & (lag < size))
        fits = fits[np.lexsort((place[fits], lag[fits]))]
        place, lag = place[fits], lag[fits]
        # seeds that follow their predecessor on the same diagonal lie in the stretch that it starts
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        covered: dict[int, int] = {}
        for s, q in zip(place[fresh].tolist(), lag[fresh].tolist(), strict=True):
            if s < covered.get(q, 0):
                continue
            d = int(doc[s])
            begin, end = int(bounds[d]), int(bounds[d + 1])
            right = s + _agreeing(words[s : end - q], words[s + q : end])
            start = s - _agreeing(words[begin:s][::-1], words[begin + q : s + q][::-1])
            covered[q] = max(right, s + 1)
            if right - start + q >= max(MIN_WORDS, MIN_TIMES * q):
                found.append((d, start - begin, right - start + q, q))
        # twice the size, where the present one occurs again
        at = np.flatnonzero(again & (left >= 2 * size))
        if len(at):
            gram = mix(gram * _STEP + np.concatenate([gram[size:], np.zeros(min(size, n), U64)])[:n])
        low, size = size, 2 * size
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def _collapsed(text: bytes, runs: list[tuple[int, int, int, int]]) -> bytes:
    words = text.split()  # splits bytes at \x20 and \x09 to \x0D
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for _, start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def _of_run(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
    doc, start, end = run.words()
    counts = np.bincount(doc, minlength=run.n)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    found = _stretches(run.hashes(start, end), doc, bounds) if len(doc) else []
    by_doc: dict[int, list] = {}
    for r in found:
        by_doc.setdefault(r[0], []).append(r)
    runs = [[{"start": s, "length": n, "period": q} for _, s, n, q in by_doc.get(i, ())] for i in range(run.n)]
    whole = run.data.tobytes()
    texts = [_collapsed(whole[a:b], by_doc.get(i, [])).decode() for i, (a, b) in enumerate(zip(run.offsets[:-1].tolist(), run.offsets[1:].tolist(), strict=True))]
    return record(doc_id=part.column(0).cast(pa.int64()), n_words=pa.array(counts, pa.int64()), runs=pa.array(runs, _RUNS), collapsed=pa.array(texts, pa.string()))


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period) and the ``collapsed`` text of each row.

    ``start`` numbers words from 0. The collapsed text lacks every word that some run contains
    after its first period; the words left are joined by one space.
    """
    return map_runs(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), ["doc_id", "text"], _of_run, _RESULT)


def digests(found: DataFrame) -> DataFrame:
    """The strongest run of each row and digests of all runs and of the collapsed text.

    The strongest run has the greatest length/period, then the smallest start, then the smallest
    period; without runs its columns are null. Quotients of whole numbers under 2**26 are in the
    order of the exact ones as doubles too, and equal where those are.
    """
    ranked = F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("times"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = F.array_max("ranked")
    return found.withColumn("ranked", ranked).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.floor((best["length"] * 1000).cast("decimal(38,0)") / (-best["period"]).cast("decimal(20,0)")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def planted(docs: DataFrame) -> DataFrame:
    """One document in ten with a periodic tail; the others as they are.

    With h the crc32 of the decimal doc_id and g = floor(h / 10), a document with h % 10 = 0
    and n > 0 words becomes periodic from word a = g % n on, with period
    p = 1 + floor((n - a) / (3 + g % 8)). A row without doc_id is not changed.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / F.lit(10)).cast("long")
    n = F.size("_words").cast("long")
    source = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"), g.alias("_g"))
    source = source.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn("_p", F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)).cast("long"))
    moved = F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get(F.col("_words"), (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return source.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))
