"""What lies in memory at a time: Arrow batches on their way to workers, and packing's known units."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import _text, packing
from ledgerlake.llm._text import Run
from ledgerlake.llm.queries import tokenizer_path


def test_batches_to_workers_are_bounded_by_bytes(spark):
    spark.conf.unset(_text.BATCH_CONF)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat('x', 100000)").alias("text")).coalesce(1)
    got = _text.map_runs(docs, ["doc_id", "text"], lambda part, run: _text.record(n=np.array([len(run.data)])), "n long", limit=1 << 40)
    sizes = [r.n for r in got.collect()]
    assert sum(sizes) == 300 * 100_000
    assert max(sizes) <= _text.BATCH_BYTES + 100_000


def test_a_sessions_own_batch_size_stays(spark):
    try:
        spark.conf.set(_text.BATCH_CONF, "16m")
        _text.bound_batches(spark)
        assert spark.conf.get(_text.BATCH_CONF) == "16m"
    finally:
        spark.conf.unset(_text.BATCH_CONF)


def test_known_units_are_arrays():
    known = packing.Units(tokenizer_path())
    texts = [" ".join(f"u{k}" for k in range(a, a + 400)) for a in range(0, 12000, 200)]
    first = [known.encode(Run(pa.array(texts[k : k + 20]))) for k in range(0, 60, 20)]
    count = known.count
    assert count > 12000 and len(known.keys) == len(known.place) == count - 1
    assert (known.keys[1:] > known.keys[:-1]).all()
    held = [v for v in vars(known).values() if isinstance(v, dict | list | set)]
    assert not held and known.keys.nbytes + known.place.nbytes <= 12 * count
    again = [known.encode(Run(pa.array(texts[k : k + 20]))) for k in range(0, 60, 20)]
    assert known.count == count
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(first, again, strict=True))


def test_tasks_give_freed_memory_back(spark, tmp_path, monkeypatch):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text")).repartition(2)
    mark = str(tmp_path / "given")

    def counted() -> None:
        with open(mark, "a") as f:
            f.write("x")

    _text.give_back()
    monkeypatch.setattr(_text, "give_back", counted)
    assert sum(r.n for r in _text.map_runs(docs, ["doc_id", "text"], lambda part, run: _text.record(n=np.array([run.n])), "n long").collect()) == 8
    with open(mark) as f:
        assert len(f.read()) >= 1
