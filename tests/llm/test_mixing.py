from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing as m
from ledgerlake.llm.queries import QUERIES


def test_rake_meets_all_marginals():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 1000, (6, 3, 4)).astype(float)
    tokens[0] *= 20  # one hot source
    share = lambda x: x / x.sum()
    targets = [share(tokens.sum((1, 2)) ** 0.7), share(tokens.sum((0, 2)) ** 0.8), np.full(4, 0.25)]
    p = m.rake(tokens, targets, 0.2)
    assert p.max() <= 1 and p.min() > 0
    kept = tokens * p
    assert kept.sum() == pytest.approx(0.2 * tokens.sum(), rel=1e-6)
    for axis, t in enumerate(targets):
        got = kept.sum(axis=tuple(a for a in range(3) if a != axis)) / kept.sum()
        assert np.abs(got - t).max() < 1e-6


def test_rake_with_empty_and_unreachable_categories():
    tokens = np.zeros((3, 2, 1))
    tokens[0, 0, 0], tokens[1, 1, 0] = 100, 1
    p = m.rake(tokens, [np.array([0.2, 0.5, 0.3]), np.array([0.5, 0.5]), np.array([1.0])], 0.5)
    assert np.isfinite(p).all() and p.max() <= 1 and p[1, 1, 0] > 0.7


def test_all_documents_and_calibration(spark):
    out = QUERIES["op4_mixing"](spark, "/root/testdata/sf0.1").cache()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert out.count() == docs.count()
    assert out.where("probability <= 0 OR probability > 1").count() == 0
    row = out.agg(F.sum("n_tokens").alias("n"), F.sum(F.col("n_tokens") * F.col("probability")).alias("e"), F.sum(F.when(F.col("chosen"), F.col("n_tokens"))).alias("k")).first()
    assert row.e / row.n == pytest.approx(m.KEEP, abs=0.001)
    assert row.k / row.n == pytest.approx(m.KEEP, abs=0.03)
    # expected source shares meet the flattened targets
    shares = {r.source: (r.t / row.n, r.e / row.e) for r in out.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("probability")).alias("e")).collect()}
    flat = {s: a ** m.TEMPERATURE["source"] for s, (a, _) in shares.items()}
    assert all(abs(e - flat[s] / sum(flat.values())) < 1e-3 for s, (_, e) in shares.items())


def test_odd_rows(spark, docs, no_docs, corpus):
    frame = docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.lit(None).cast("string")).otherwise("a")).withColumn("lang", F.lit(None).cast("string"))
    out = m.weigh(frame).collect()
    assert len(out) == len(corpus) and all(0 < r.probability <= 1 and r.n_tokens >= 1 for r in out)
    assert m.weigh(no_docs).count() == 0 and m.mix(no_docs).count() == 0
    mixed = m.mix(frame, keep=1.0)
    assert mixed.columns == frame.columns and mixed.count() == len(corpus)


def test_given_targets(spark):
    rows = [(i, f"w{i % 50} x y", "ab"[i % 10 == 0], "en") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = m.weigh(frame, keep=0.1, targets={"source": {"a": 0.5, "b": 0.5}})
    got = {r.source: r.e for r in out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("e")).collect()}
    assert got["a"] == pytest.approx(got["b"], rel=1e-4) and sum(got.values()) == pytest.approx(0.1 * 6000, rel=1e-4)


def test_topics_come_from_all_documents(spark):
    """A word field that none of the first thousands of documents (by hash) has gets a topic of its own."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + k) % 9}" for k in range(12)), "s", "en") for i in range(6000)]
    order = {r[0]: h for r, h in zip(rows, (r.h for r in spark.createDataFrame([(r[0],) for r in rows], "doc_id long").select(F.xxhash64(F.col("doc_id").cast("string"), F.lit("topics")).alias("h")).collect()), strict=True)}
    late = set(sorted(order, key=order.get)[2500:])
    rows = [(i, " ".join(f"late{(i + k) % 9}" for k in range(12)) if i in late and i % 3 == 0 else t, s, g) for i, t, s, g in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    topic = {r.doc_id: r.topic for r in m.weigh(frame).collect()}
    held = {i for i, t, _, _ in rows if t.startswith("late")}
    assert not {topic[i] for i in held} & {topic[i] for i in topic if i not in held}
    # neither partitions nor the order of rows matter, and every document with words counts in the sums
    again = m.vectors(frame.orderBy(F.desc("text")).repartition(7))
    centres = m.fit_topics(again)
    assert {r.doc_id: r.topic for r in m.measure(again, centres).collect()} == topic
    x = {r.doc_id: np.frombuffer(bytes(r.x), np.int16).astype(float) for r in again.collect()}
    for k in set(topic.values()):
        total = sum(x[i] for i in topic if topic[i] == k)
        assert np.abs(total / np.linalg.norm(total) - centres[k]).max() < 1e-3
