from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import suffix_dedup as s
from ledgerlake.llm._text import Run
from ledgerlake.llm.queries import QUERIES


def brute(rows) -> dict:
    """Through a count of every string of 200 bytes."""
    seen: Counter = Counter()
    raw = {i: (t or "").encode() for i, t in rows}
    for b in raw.values():
        seen.update(hash(b[k : k + 200]) for k in range(len(b) - 199))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=np.int64)
        for k in range(len(b) - 199):
            if seen[hash(b[k : k + 200])] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        gone = (np.cumsum(gone)[:-1] > 0) if len(b) else np.zeros(0, bool)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def got(frame) -> dict:
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def test_matches_brute_force(docs, corpus):
    want = brute(corpus)
    assert sum(n > 0 for _, n, _, _ in want.values()) > 15
    assert got(s.find_repeats(docs)) == want


def test_runs_and_edges(spark):
    """Repeats of exactly 199 to 201 bytes, runs, periodic texts, repeats within one text."""
    r = random.Random(6)
    noise = lambda n: "".join(r.choice("abcdéf ") for _ in range(n))
    base = noise(2000)
    texts = ["x" * 199, "y" * 200, "y" * 201, "z" * 900, "ab" * 300, "abc" * 150 + noise(50)]
    for k in (150, 198, 199, 200, 201, 260):
        a = r.randrange(1000)
        texts += [noise(30) + base[a : a + k] + noise(40), noise(10) + base[a : a + k] + noise(300)]
    texts += [noise(20) + base[100:500] + noise(20) + base[300:700], base]
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    assert got(s.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)


def test_sample_tables(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(QUERIES["op9_suffix_dedup"](spark, d)) == brute(rows)


@pytest.mark.parametrize("alphabet", [1, 2, 5, 200])
def test_suffix_order_is_sorted(alphabet):
    r = random.Random(alphabet)
    for _ in range(60):
        text = np.array([x for _ in range(r.randrange(1, 6)) for x in [*[r.randrange(1, alphabet + 1) for _ in range(r.randrange(0, 40))], 0]], dtype=np.uint8)
        order = s.suffix_order(text, 50)
        assert sorted(order.tolist()) == np.flatnonzero(text).tolist()
        whole = text.tobytes()
        suffixes = [whole[i : whole.index(b"\0", i)] for i in order]
        assert suffixes == sorted(suffixes)


def test_windows_have_their_least_gram():
    r = random.Random(2)
    run = Run(pa.array(["".join(r.choice("ab ") for _ in range(n)) for n in (0, 150, 200, 500, 199, 320)]))
    start, doc, gram = s.windows(run)
    assert len(start) == 1 + 301 + 121
    for a, d, g in zip(start, doc, gram, strict=True):
        assert run.offsets[d] <= a <= g and g + s.GRAM <= a + 200 <= run.offsets[d + 1]
        hashes = run.hashes(np.arange(a, a + 137), np.arange(a, a + 137) + s.GRAM)
        assert (gram[start == a] >= a).all() and len(hashes) == 137


def test_repeated_rows_and_empty(spark, no_docs):
    t = "".join(chr(97 + (k * k) % 26) + str(k) for k in range(150))
    out = sorted((r.doc_id or -1, r.n_removed) for r in s.find_repeats(spark.createDataFrame([(5, t), (5, t), (None, "short"), (7, None)], "doc_id long, text string")).collect())
    assert out == [(-1, 0), (5, len(t)), (5, len(t)), (7, 0)]
    assert s.find_repeats(no_docs).count() == 0


def test_drop_repeats_keeps_columns(docs, corpus):
    out = s.drop_repeats(docs)
    assert out.columns == docs.columns
    want = brute(corpus)
    for r in out.collect():
        if want[r.doc_id][1] == 0:
            assert r.text == dict(corpus)[r.doc_id]
        else:
            assert len((r.text or "").encode()) >= 0 and r.kept == "x"
