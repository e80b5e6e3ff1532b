"""Rows of equal or null doc_id with different texts that share a passage."""

from __future__ import annotations

import pytest

from ledgerlake.llm import substring_dedup as s

PASSAGE = " ".join(f"p{k}" for k in range(20))
#: So that runs hold several rows of an id, most of them without the smallest one.
SPREAD = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(params=[1, 8])
def partitions(spark, request):
    want = SPREAD | {"spark.sql.shuffle.partitions": str(request.param)}
    before = {k: spark.conf.get(k) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("later", [None, 9])
def test_every_row_loses_the_passage(spark, partitions, later):
    rows = [(2, PASSAGE)] + [(later, f"n{k} m{k} {PASSAGE} o{k}") for k in range(60)]
    out = [(r.doc_id, r.n_words, r.n_removed) for r in s.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)).collect()]
    assert sorted(out, key=str) == sorted([(2, 20, 0)] + [(later, 23, 20)] * 60, key=str)
