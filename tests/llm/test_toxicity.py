from __future__ import annotations

import random

import pytest

from ledgerlake.llm import toxicity as t
from ledgerlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(800):
        words = [f"w{r.randrange(300)}" for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[r.randrange(30)] = "Scumbag!" if i % 2 else "trashy,"
        if i % 7 == 0:
            # a biased sample: one group is named mostly next to insults
            words[r.randrange(30)] = "women" if toxic else "men"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (9, None), (9000, 0)], "doc_id long, toxic int")
    return docs, marks, dict(labels)


def test_learns_and_is_even_between_groups(spark, fitted):
    docs, marks, labels = fitted
    model = t.fit_classifier(docs, marks)
    got = {r.doc_id: r.score for r in t.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, y in labels.items())
    probe = spark.createDataFrame([(i, f"w1 w2 {w} w3") for i, w in enumerate(["men", "women", "muslim", "jewish"])], "doc_id long, text string")
    scores = [r.score for r in t.score(probe, model).collect()]
    assert max(scores) < 0.5 and max(scores) - min(scores) < 0.05
    plain = t.fit_classifier(docs, marks, counterfactual=0.0)
    uneven = [r.score for r in t.score(probe, plain).collect()]
    assert max(scores) - min(scores) <= max(uneven) - min(uneven) + 1e-9


def test_drop_toxic_keeps_columns(spark, fitted):
    docs, marks, labels = fitted
    model = t.fit_classifier(docs, marks)
    kept = t.drop_toxic(docs.selectExpr("'en' lang", "doc_id", "text", "1 score"), model)
    assert kept.columns == ["lang", "doc_id", "text", "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i, y in labels.items() if not y}


def test_odd_rows_and_no_labels(spark, docs, no_docs, corpus):
    none = t.fit_classifier(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = t.score(docs, none).collect()
    assert len(got) == len(corpus) and all(0 <= r.score < 1e-9 for r in got)
    assert t.score(no_docs, none).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op2_toxicity"](spark, sf).toPandas()
    assert got.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    m = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert (m.predicted == m.toxic).mean() > 0.97
