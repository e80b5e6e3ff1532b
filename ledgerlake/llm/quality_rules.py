"""Quality rules: per-document statistics and a line-labelling CRF.

Lines of a document are a sequence of two labels, content and boilerplate. A
linear-chain conditional random field scores them from bounded line features
(length, letters, capitals, digits, symbols, repeats) and from transitions;
Viterbi decoding gives the best labelling, and the share of words on content
lines decides whether the document is kept. Two base rules reject first.

The field is fitted (``fit_crf``) on at most ``FIT_DOCUMENTS`` labelled documents, those of
smallest hashed id, with lines labelled by their document's quality label; that
bound keeps the fit independent of corpus size. Statistics, decoding and
decisions cover every line of every document.

Defined results: null and empty texts have no words and fail the base rule;
documents without a line that holds a word have content share 0 and are judged
by the base rules alone; repeated rows are judged alike; without labels of both
kinds the field keeps its prior weights (nothing is boilerplate). Every row gives
one row; other columns are dropped.

Scale: one pass over the texts, no shuffle; each task holds a few MB of text,
or one document. The model (a few dozen numbers) travels with the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._text import Run, map_runs, record, shingles

U64 = np.uint64
FIT_DOCUMENTS = 4000
CHAIN = 64  # lines of a chain in the fit
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
MIN_CONTENT_SHARE = 0.3
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in "!?.,;:|-"]] = True
FEATURES = ("bias", "few_words", "many_words", "symbols", "capitals", "digits", "marks", "long_words", "repeated_words", "repeated_line")
N_FEATURES = len(FEATURES)


class Lines:
    """Word statistics and line features of a run of documents."""

    def __init__(self, run: Run) -> None:
        self.run = run
        n, data = run.n, run.data
        doc, start, end = run.words()
        chars = run.chars()
        self.n_words = np.bincount(doc, minlength=n)
        self.word_chars = np.bincount(doc, weights=chars[end] - chars[start], minlength=n).astype(np.int64)
        sums = {}
        for name, table in (("symbols", _SYMBOL), ("capitals", _UPPER), ("digits", _DIGIT), ("marks", _STOP)):
            sums[name] = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(table[data], out=sums[name][1:])
        self.n_symbols = np.diff(sums["symbols"][run.offsets])
        word = run.hashes(start, end)
        self.n_repeat = self._repeats(word, doc, n)
        # lines: stretches between '\n' and document borders
        cut = np.flatnonzero(data == 0x0A)
        line_doc = np.concatenate([np.arange(n), np.searchsorted(run.offsets[1:], cut, side="right")])
        line_start = np.concatenate([run.offsets[:-1], cut + 1])
        order = np.lexsort((line_start, line_doc))
        line_doc, line_start = line_doc[order], line_start[order]
        limit = run.offsets[1:][line_doc]
        line_end = np.minimum(np.concatenate([line_start[1:] - 1, limit[-1:]]), limit)
        line_end = np.where(np.concatenate([line_doc[1:] != line_doc[:-1], [True]]), limit, line_end)
        first, last = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
        words = last - first
        full = words > 0
        self.first, self.last = first[full], last[full]
        line_start, line_end, self.doc, self.words = line_start[full], line_end[full], line_doc[full], words[full]
        key = run.hashes(line_start, line_end)
        order = np.lexsort((np.arange(len(key)), key, self.doc))
        again = np.zeros(len(key), dtype=bool)
        if len(key):
            again[order[1:]] = (key[order][1:] == key[order][:-1]) & (self.doc[order][1:] == self.doc[order][:-1])
        self.n_dup_lines = np.bincount(self.doc, weights=again, minlength=n).astype(np.int64)
        size = np.maximum(chars[line_end] - chars[line_start], 1)
        share = {k: (v[line_end] - v[line_start]) / size for k, v in sums.items()}
        new = np.zeros(len(word) + 1, dtype=np.int64)
        if len(word):
            same = np.concatenate([[False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])])
            np.cumsum(same, out=new[1:])
        repeat = (new[self.last] - new[self.first]) / np.maximum(self.words, 1)
        per = (chars[line_end] - chars[line_start]) / np.maximum(self.words, 1)
        self.features = np.stack(
            [
                np.ones(len(key)), self.words <= 3, self.words >= 12, np.minimum(share["symbols"] * 10, 2), share["capitals"] * 2,
                share["digits"] * 2, np.minimum(share["marks"] * 4, 2), per > 15, repeat * 2, again,
            ],
            axis=1,
        ).astype(np.float64) if len(key) else np.zeros((0, N_FEATURES))

    def _repeats(self, word: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Words in windows of WINDOW words that a document holds twice or more."""
        key, owner = shingles(word, doc, n, WINDOW)
        counts = self.n_words
        whole = counts[owner] >= WINDOW
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        key, owner = key[whole], owner[whole]
        if not len(key):
            return np.zeros(n, dtype=np.int64)
        order = np.lexsort((key, owner))
        same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        windows = np.maximum(counts - WINDOW + 1, 0)
        place = np.arange(len(key)) - np.repeat((np.cumsum(windows) - windows), windows) + first[owner]
        change = np.zeros(len(word) + 1, dtype=np.int64)
        np.add.at(change, place[twice], 1)
        np.add.at(change, place[twice] + WINDOW, -1)
        return np.bincount(doc, weights=np.cumsum(change)[:-1] > 0, minlength=n).astype(np.int64)

    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat > MAX_REPEAT_PERCENT * self.n_words)


def prior_crf() -> dict:
    return {"w": np.zeros(N_FEATURES).tolist(), "t": [[1.0, 0.0], [0.0, 1.0]], "p": [1.0, 0.0]}


def viterbi(lines: Lines, crf: dict) -> np.ndarray:
    """True for the lines that the best labelling calls content.

    All documents advance together, one line position a step, so a step is a
    few array operations on the documents that still have a line there.
    """
    total = len(lines.doc)
    out = np.zeros(total, dtype=bool)
    if not total:
        return out
    t, p = np.array(crf["t"]), np.array(crf["p"])
    boiler = lines.features @ np.array(crf["w"])
    emit = np.stack([-boiler / 2, boiler / 2], axis=1)
    counts = np.bincount(lines.doc, minlength=lines.run.n)
    begin = np.cumsum(counts) - counts
    by_length = np.argsort(-counts, kind="stable")
    lengths = counts[by_length]
    back = np.zeros((total, 2), dtype=np.int8)
    best = p + emit[begin[by_length[: np.count_nonzero(lengths)]]]
    for step in range(1, int(lengths[0])):
        live = np.count_nonzero(lengths > step)
        rows = begin[by_length[:live]] + step
        options = best[:live, :, None] + t[None]
        back[rows] = options.argmax(axis=1)
        best[:live] = options.max(axis=1) + emit[rows]
    state = best.argmax(axis=1).astype(np.int8)
    for step in range(int(lengths[0]) - 1, -1, -1):
        live = np.count_nonzero(lengths > step)
        rows = begin[by_length[:live]] + step
        out[rows] = state[:live] == 0
        if step:
            state[:live] = back[rows, state[:live]]
    return out


def fit_crf(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCUMENTS, rounds: int = 60, penalty: float = 1.0) -> dict:
    """Weights of the field from at most ``bound`` labelled documents.

    The likelihood of the chains is climbed by its gradient (forward-backward),
    on lines labelled by their document's quality. Every line of a sampled document counts; long
    documents are cut into chains of ``CHAIN`` lines, which bounds the fit's memory.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("crf"))
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    pick = good.orderBy(order, "doc_id").limit(bound)
    sample = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")

    def lines_of(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        lines = Lines(run)
        counts = np.bincount(lines.doc, minlength=run.n)
        begin = np.cumsum(counts) - counts
        rows = [np.round(lines.features[b : b + c], 4).astype(np.float32).tobytes() for b, c in zip(begin, counts, strict=True)]
        return record(doc_id=part.column(0), quality=part.column(2), rows=pa.array(rows, pa.binary()))

    kind = sample.schema["quality"].dataType.simpleString()
    got = map_runs(sample, ["doc_id", "text", "quality"], lines_of, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, quality {kind}, rows binary").collect()
    chains = []
    for r in sorted(got, key=lambda r: (str(r.doc_id), bytes(r.rows))):
        x = np.frombuffer(r.rows, np.float32).reshape(-1, N_FEATURES).astype(float)
        chains += [(x[k : k + CHAIN], 0 if r.quality else 1) for k in range(0, len(x), CHAIN)]
    if len({y for _, y in chains}) < 2:
        return prior_crf()
    # Padded chains; label 1 is boilerplate and labels are constant within a document
    length = np.array([len(x) for x, _ in chains])
    label = np.array([y for _, y in chains])
    steps, n = int(length.max()), len(chains)
    x = np.zeros((steps, n, N_FEATURES))
    for i, (f, _) in enumerate(chains):
        x[: len(f), i] = f
    live = np.arange(steps)[:, None] < length[None]
    w, t, p = np.zeros(N_FEATURES), np.array([[1.0, 0.0], [0.0, 1.0]]), np.zeros(2)
    speed = [np.zeros_like(w), np.zeros_like(t), np.zeros_like(p)]
    log_sum = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for _ in range(rounds):
        s = x @ w
        emit = np.stack([-s / 2, s / 2], axis=2)
        ahead = np.zeros((steps, n, 2))
        ahead[0] = p + emit[0]
        for k in range(1, steps):
            ahead[k] = np.where(live[k][:, None], log_sum(ahead[k - 1][:, :, None] + t, 1) + emit[k], ahead[k - 1])
        behind = np.zeros((steps, n, 2))
        for k in range(steps - 2, -1, -1):
            behind[k] = np.where(live[k + 1][:, None], log_sum(t[None] + (emit[k + 1] + behind[k + 1])[:, None, :], 2), behind[k + 1])
        whole = log_sum(ahead[-1], 1)
        node = np.exp(ahead + behind - whole[None, :, None]) * live[:, :, None]
        edge = np.exp(ahead[:-1, :, :, None] + t + (emit[1:] + behind[1:])[:, :, None, :] - whole[None, :, None, None]) * live[1:, :, None, None]
        truth = np.where(label == 1, 1.0, -1.0)[None, :] * live
        gw = (x * ((truth - (node[:, :, 1] - node[:, :, 0])) / 2)[:, :, None]).sum((0, 1))
        gt = np.array([[(live[1:] & (label == 0)).sum(), 0], [0, (live[1:] & (label == 1)).sum()]]) - edge.sum((0, 1))
        gp = np.array([(label == 0).sum(), (label == 1).sum()]) - node[0].sum(0)
        scale = 1.0 / live.sum()
        for value, grad, v in ((w, gw - penalty * w, speed[0]), (t, gt - penalty * t, speed[1]), (p, gp - penalty * p, speed[2])):
            v *= 0.9
            v += grad * scale
            value += 2.0 * v
    return {"w": np.round(w, 6).tolist(), "t": np.round(t, 6).tolist(), "p": np.round(p, 6).tolist()}


def judge_quality(docs: DataFrame, crf: dict, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """Per document its statistics, content share and verdict."""

    def judge(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        lines = Lines(run)
        content = viterbi(lines, crf)
        inside = np.bincount(lines.doc, weights=content * lines.words, minlength=run.n)
        share = inside / np.maximum(lines.n_words, 1)
        failed = lines.base_failed()
        return record(
            doc_id=part.column(0), n_words=lines.n_words.astype(np.int64), word_chars=lines.word_chars, n_symbols=lines.n_symbols.astype(np.int64), n_dup_lines=lines.n_dup_lines,
            n_repeat_words=lines.n_repeat, base_failed=failed, kept=~failed & (share >= min_share), content_share=share,
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    return map_runs(docs, ["doc_id", "text"], judge, schema)
