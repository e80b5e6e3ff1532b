from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import quality_rules as q
from ledgerlake.llm._text import Run

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(words) < 2000 else {w for w, g in itertools.groupby(sorted(windows)) if len(list(g)) > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def test_statistics_match_brute_force(docs, corpus):
    got = {r.doc_id: r for r in q.judge_quality(docs, q.prior_crf()).collect()}
    assert len(got) == len(corpus)
    for i, text in corpus:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), text and text[:60]
        assert r.kept == (not r.base_failed)  # the prior field calls nothing boilerplate


def test_empty_table(no_docs):
    assert q.judge_quality(no_docs, q.prior_crf()).count() == 0


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(1)
    crf = {"w": rng.normal(size=q.N_FEATURES).tolist(), "t": rng.normal(size=(2, 2)).tolist(), "p": rng.normal(size=2).tolist()}
    texts = ["one line\nA B C\n### 12 !!\nfour words are here\nx", "", "single line", "\n\nA\n\nB\nC!\nd e f g h i j k l m n o p"]
    lines = q.Lines(Run(pa.array(texts)))
    got = q.viterbi(lines, crf)
    score = lines.features @ np.array(crf["w"])
    for d in range(len(texts)):
        at = np.flatnonzero(lines.doc == d)
        if not len(at):
            continue

        def value(ys, at=at):
            v = crf["p"][ys[0]]
            for k, y in enumerate(ys):
                v += score[at[k]] / 2 * (1 if y else -1) + (crf["t"][ys[k - 1]][y] if k else 0)
            return v

        best = max(itertools.product((0, 1), repeat=len(at)), key=value)
        assert [not x for x in best] == got[at].tolist()


@pytest.mark.parametrize("bound", [50, 4000])
def test_fit_learns_junk_lines(spark, bound):
    prose = "Words of plain prose go on in a line.\nThey go on in another one, too."
    junk = "BUY!! NOW!! $$$ ### 100\n### $$$ %%% !!"
    rows = [(i, junk if i % 4 == 0 else f"{prose} {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)] + [(None, 1), (500, None)], "doc_id long, quality int")
    crf = q.fit_crf(docs, labels, bound=bound, rounds=40)
    got = {r.doc_id: r.content_share for r in q.judge_quality(docs, crf).collect()}
    assert all((got[i] < 0.3) == (i % 4 == 0) for i in range(200))


def test_fit_without_labels(docs, spark):
    assert q.fit_crf(docs, spark.createDataFrame([], "doc_id long, quality int")) == q.prior_crf()


def test_late_lines_are_learnt(spark):
    """Junk that only stands after line 300 of bad documents shapes the fit as junk at their top does."""
    import random

    from ledgerlake.llm import quality_rules as q

    r = random.Random(5)
    prose = lambda: " ".join(r.choice(["some", "plain", "words", "of", "text", "that", "people", "read"]) for _ in range(14)) + "."
    rows, labels = [], []
    for i in range(60):
        lines = [prose() for _ in range(310)]
        if i % 2:
            lines[302:] = ["$$$ ### 123 %%% |||"] * 40
        rows.append((i, "\n".join(lines)))
        labels.append((i, 1 - i % 2))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    crf = q.fit_crf(docs, known, rounds=30)
    symbols = q.FEATURES.index("symbols")
    assert crf["w"][symbols] > 0.2
    cut = spark.createDataFrame([(i, "\n".join(t.split("\n")[:300])) for i, t in rows], "doc_id long, text string")
    assert abs(q.fit_crf(cut, known, rounds=30)["w"][symbols]) < 0.05  # without them nothing tells
