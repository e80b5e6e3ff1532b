from __future__ import annotations

import hashlib

import pytest

from ledgerlake.llm import fingerprints as f
from ledgerlake.llm.queries import QUERIES


def edited(rows) -> dict:
    rows = sorted(rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[: len(t) - q] + following[:q]).encode()).hexdigest())
    return out


def checked(got, rows) -> dict:
    got = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    want = edited(rows)
    texts = dict(rows)
    by_text: dict[str, set] = {}
    for i, r in got.items():
        assert (r.n_chars, r.edited_sha256) == want[i]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(texts[i] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    order = sorted(texts)
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        if (texts[a] or "") == (texts[b] or ""):
            assert got[a].near_next == 1
    return got


def test_edits_ties_and_odd_texts(spark, docs, corpus):
    got = checked(f.fingerprints(docs).collect(), corpus)
    texts = dict(corpus)
    assert all((r.fingerprint == "") == (not texts[i]) for i, r in got.items())


def test_sample_tables_tell_edits_from_neighbours(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = checked(QUERIES["op8_fingerprints"](spark, d).collect(), rows)
    texts = dict(rows)
    order = sorted(texts)
    long = [i for i, n in zip(order, order[1:], strict=False) if len(texts[i]) >= 200 and texts[i] != texts[n]]
    assert sum(got[i].near_edited > 0.3 for i in long) > 0.97 * len(long)
    assert sum(got[i].near_next < 0.2 for i in long) > 0.95 * len(long)


def test_anchors_by_brute_force(spark):
    """Anchors are the k-mers whose least unit is at an edge; entries add the way to the next one."""
    rows = [(i, " ".join(str((i * 7 + k * k) % 11) for k in range(n))) for i, n in enumerate((3, 8, 9, 40, 200))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {(r.a, r.b): r.h for r in spark.sql("select a, b, xxhash64(xxhash64(string(a)), xxhash64(string(b))) h from (select explode(sequence(0,10)) a), (select explode(sequence(0,10)) b)").collect()}
    got = {r.doc_id: set(r.w) for r in f.with_fingerprint(frame, "text", "w", "c").collect()}
    for i, text in rows:
        words = [int(w) for w in text.split()]
        u = [pairs[a, b] for a, b in zip(words, words[1:], strict=False)]
        anchors = [k for k in range(len(u) - 6) if min(u[k : k + 7]) in (u[k], u[k + 6])]
        tuples = [(*u[k : k + 7], (anchors[j + 1] - k) if j + 1 < len(anchors) else 0) for j, k in enumerate(anchors)]
        assert len(set(tuples)) == len(got[i])


@pytest.mark.parametrize("rows", [[], [(1, "only one")], [(None, "a"), (4, None), (4, "b"), (4, "b")]])
def test_small_tables(spark, rows):
    out = f.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)


def test_native(spark, docs):
    plan = f.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
