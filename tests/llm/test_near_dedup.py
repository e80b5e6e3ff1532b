from __future__ import annotations

import random

import numpy as np
import pytest
from brute import near_brute

from ledgerlake.llm import near_dedup as n
from ledgerlake.llm._store import components
from ledgerlake.llm.queries import QUERIES

def got(frame) -> dict:
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}


def test_matches_brute_force(docs, corpus):
    assert got(n.near_duplicates(docs)) == near_brute(corpus)


def test_chains_and_mixed_buckets(spark):
    """Chains of edits whose ends are unlike, and groups just below the bound that share buckets."""
    r = random.Random(4)
    rows, i = [], 0
    for _ in range(12):
        words = [f"w{r.randrange(5000)}" for _ in range(r.choice([12, 80, 300]))]
        for _ in range(r.randrange(3, 14)):
            words = list(words)
            for _ in range(r.choice([1, 1, 2, 4])):
                words[r.randrange(len(words))] = f"e{r.randrange(9000)}"
            rows.append((r.randrange(10**9), " ".join(words)))
    base = [f"b{k}" for k in range(200)]
    for _ in range(150):  # one large group of near copies
        words = list(base)
        for _ in range(r.randrange(1, 7)):
            words[r.randrange(200)] = f"e{r.randrange(9000)}"
        rows.append((r.randrange(10**9), " ".join(words)))
    rows = list({i: (i, t) for i, t in rows}.values())
    assert got(n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == near_brute(rows)


def test_sample_tables(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got(QUERIES["op1_near_dedup"](spark, d)) == near_brute(rows)


def test_null_ids_and_repeated_rows(spark):
    text = "a b c d e f g h i j"
    frame = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text), (7, None)], "doc_id long, text string")
    out = sorted((r.doc_id or -1, r.component_id, r.kept) for r in n.near_duplicates(frame).collect())
    assert out == [(-1, None, False), (5, 5, True), (5, 5, True), (7, 7, True), (9, 5, False)]
    assert sorted(r.doc_id for r in n.drop_near_duplicates(frame).collect()) == [5, 7]


def test_drop_keeps_columns(docs, corpus):
    out = n.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, (_, _, kept) in near_brute(corpus).items() if kept}


def test_empty_table(no_docs):
    assert n.near_duplicates(no_docs).count() == 0 and n.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("like", [0.3, 0.85])
def test_signature_estimates_similarity(like):
    rng = np.random.default_rng(2)
    errors = []
    for size in (20, 400):
        for _ in range(30):
            both = int(size * like)
            x = rng.integers(1, 2**53, 2 * size - both).astype(np.uint64)
            a, b = x[:size], x[size - both :]
            s = n.super_minhash(np.repeat([0, 1], size), np.concatenate([a, b]), 2)
            assert (s >> np.uint64(32)).max() < n.SLOTS
            errors.append((s[0] == s[1]).mean() - both / (2 * size - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_signature_by_the_definition():
    """Against the plain algorithm: a stored permutation per element and no early stop."""
    rng = np.random.default_rng(3)
    value = rng.integers(1, 2**53, 9).astype(np.uint64)
    m = 16
    want = np.full(m, np.iinfo(np.uint64).max, dtype=np.uint64)
    for v in value:
        order = list(range(m))
        for j in range(m):
            z = n.mix(np.array([v * np.uint64(0x9E3779B97F4A7C15) + np.uint64((j + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))], dtype=np.uint64))[0]
            k = j + ((int(z) & 0xFFFFFFFF) * (m - j) >> 32)
            order[j], order[k] = order[k], order[j]
            want[order[j]] = min(want[order[j]], np.uint64((j << 32) | (int(z) >> 32)))
    assert (n.super_minhash(np.zeros(9, dtype=int), value, 1, m)[0] == want).all()


def test_components_of_a_long_chain(spark):
    r = random.Random(1)
    names = r.sample(range(10**6), 300)
    edges = [(names[k], names[k + 1]) for k in range(299)] + [(2 * 10**6, 3 * 10**6)]
    r.shuffle(edges)
    out = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert out == {**{x: min(names) for x in names}, 2 * 10**6: 2 * 10**6, 3 * 10**6: 2 * 10**6}


def test_only_asked_texts_reach_the_shuffle(spark):
    """The bitmap must work below the exact join's shuffle; above it, all texts are shuffled."""
    texts = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    ids = spark.range(0, 500, 100).selectExpr("id AS rep")
    asked = n._asked(texts, ids.union(ids))
    assert sorted(r.doc_id for r in asked.collect()) == [0, 100, 200, 300, 400]
    joins = [line for line in asked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert "_part" not in joins[0] and "_part" in joins[1]
