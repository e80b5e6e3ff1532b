"""The pipeline against a plain version of each stage, on the stages' own inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import mixing, pii, toxicity
from ledgerlake.llm.queries import tokenizer_path
from brute import near_brute, pack_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline

    return corpus_pipeline


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_and_run(spark, pipeline, tmp_path_factory):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "pii", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs, results = [docs], []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, inputs[-1], SF).write.parquet(path)
        results.append(spark.read.parquet(path))
        inputs.append(results[-1])
        if name != "packing":
            assert results[-1].columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    # toxicity: plain sum of the weights of each document's words and word beginnings
    model = toxicity.fit_classifier(docs, labels)
    weight = dict(zip(model["index"], model["weight"], strict=True))
    start = rows_of(docs)
    kept = set()
    for i, r in start.items():
        held = toxicity.term_features(r.text or "")
        if model["bias"] + sum(weight.get(int(x), 0.0) for x in held) < 0:
            kept.add(i)
    first = rows_of(results[0])
    assert set(first) == kept
    second = rows_of(results[1])
    assert set(second) == {i for i, (_, _, keep) in near_brute([(i, r.text) for i, r in first.items()], pipeline.NEAR_PERCENT).items() if keep}
    assert all(second[i] == first[i] for i in second)
    scorer = pii.fit_scorer(results[1])
    third = rows_of(results[2])
    assert {i: r.text for i, r in third.items()} == {i: pii.redacted(r.text, scorer) for i, r in second.items()}
    assert all(r.n_chars == len(r.text) for r in third.values())
    weighed = {r.doc_id: r for r in mixing.weigh(results[2], pipeline.KEEP).collect()}
    assert set(rows_of(results[3])) == {i for i, r in weighed.items() if r.chosen}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pack_brute(results[4].collect(), [(r.doc_id, r.text) for r in results[3].collect()], tokenizer)
    whole = sorted(map(tuple, pipeline.run(spark, SF).collect()))
    assert whole == sorted(map(tuple, results[4].collect()))


def test_odd_documents(spark, pipeline, docs, tmp_path):
    path = str(tmp_path / "sf")
    docs.select("doc_id", "text", "lang", "source", F.lit(7).cast("long").alias("n_chars"), F.lit("x").alias("rep"), F.lit(1).alias("key")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert pipeline.run(spark, path).count() > 0
    empty = str(tmp_path / "none")
    docs.where("false").withColumn("n_chars", F.lit(1)).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert pipeline.run(spark, empty).count() == 0


def test_entry_registers_all(pipeline):
    import __spark_entry__ as entry

    found = set(entry.queries())
    assert "pipeline" in found
    assert {int(n[2:].split("_")[0]) for n in found if n.startswith("op")} == set(range(1, 14))
