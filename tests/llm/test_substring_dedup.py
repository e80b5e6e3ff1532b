from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from ledgerlake.llm import substring_dedup as s
from ledgerlake.llm._text import Run
from ledgerlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows) -> dict:
    words = {i: WORD.findall(t or "") for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def got(frame) -> dict:
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}


def test_matches_brute_force(docs, corpus):
    want = brute(corpus)
    assert sum(n > 0 for _, n, _ in want.values()) > 15
    assert got(s.find_repeats(docs)) == want


def test_few_symbols_many_runs(spark):
    """Texts over two or three words, full of runs and chance repeats."""
    r = random.Random(6)
    rows = [(r.randrange(10**9), " ".join(r.choice(["a", "b", "cc"][: r.choice([1, 2, 3])]) for _ in range(r.randrange(0, 90)))) for _ in range(120)]
    rows = list(dict(rows).items())
    assert got(s.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))) == brute(rows)


def test_sample_tables(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(QUERIES["op3_substring_dedup"](spark, d)) == brute(rows)


def test_equal_windows_have_equal_symbols():
    r = random.Random(3)
    for _ in range(40):
        words = [r.choice("abcdefgh"[: r.choice([2, 4, 8])]) for _ in range(40)]
        texts = [" ".join([*[r.choice("abcdefgh") for _ in range(r.randrange(6))], *words, *[r.choice("abcdefgh") for _ in range(r.randrange(6))]]) for _ in range(5)]
        w = s.Windows(Run(pa.array(texts)))
        by_name: dict[int, set] = {}
        for name, key in zip(w.name.tolist(), w.key.tolist(), strict=True):
            by_name.setdefault(name, set()).add(key)
        assert all(len(k) == 1 for k in by_name.values())


def test_symbols_spell_their_words():
    words = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    for symbols in s.recompress(words, np.repeat([0, 1, 2], 100)):
        assert symbols.start[0] == 0 and symbols.end[-1] == 300 and (symbols.start[1:] == symbols.end[:-1]).all()
        spelled: dict[int, set] = {}
        for name, a, b in zip(symbols.name.tolist(), symbols.start, symbols.end, strict=True):
            spelled.setdefault(name, set()).add(tuple(words[a:b].tolist()))
        assert all(len(x) == 1 for x in spelled.values())
        assert (symbols.low[1:] >= symbols.low[:-1]).all() and (symbols.high[1:] >= symbols.high[:-1]).all()


def test_repeated_rows_null_ids_and_empty(spark, no_docs):
    t = " ".join(f"w{k}" for k in range(20))
    frame = spark.createDataFrame([(5, t), (5, t), (None, "x " + t), (7, None)], "doc_id long, text string")
    out = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in s.find_repeats(frame).collect())
    assert out == [(-1, 21, 20), (5, 20, 0), (5, 20, 0), (7, 0, 0)]
    assert s.find_repeats(no_docs).count() == 0


def test_drop_repeats_keeps_columns(docs, corpus):
    out = s.drop_repeats(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    want = brute(corpus)
    for i, t in corpus:
        if want[i][1] == 0:
            assert rows[i].text == t and rows[i].kept == "x"
        else:
            assert hashlib.sha256(rows[i].text.encode()).hexdigest() == want[i][2]
