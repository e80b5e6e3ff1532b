"""The ingest job's disk: compressed CSVs, loads in passes, shuffle files that go when a write ends."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import jobs
from ledgerlake.registry import QUERIES
from ledgerlake.schemas import TRANSACTIONS
from ledgerlake.session import SHUFFLE_CLEANUP_CONF, shuffles_freed
from ledgerlake.sources import files, sinks
from ledgerlake.sources.catalog import Catalog

HEADER = ",".join(f.name for f in TRANSACTIONS.fields)


def _files(root: str, n: int, bad: int | None = None) -> None:
    os.makedirs(f"{root}/transactions")
    for k in range(n):
        key = "" if k == bad else f"T{k}"
        with open(f"{root}/transactions/part-{k}.csv", "w", encoding="utf-8") as fh:
            fh.write(f"{HEADER}\n{key},M1,C1,10.50,2.0000,0.21,10.29,pix,approved,2024-01-0{1 + k % 3},2024-01-02T10:00:00,1,A1,stone\n")


def _shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(k).getName() for k in range(found.size())) if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_with_the_write(spark, tmp_dir):
    before, conf = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    with shuffles_freed(spark):
        held = spark.range(1000).repartition(3, "id")
        held.write.parquet(f"{tmp_dir}/out")
        assert spark.read.parquet(f"{tmp_dir}/out").count() == 1000
        assert held.count() == 1000
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == conf


def test_a_load_leaves_no_shuffle_files(spark, tmp_dir):
    _files(f"{tmp_dir}/csv", 4)
    before = _shuffle_files(spark)
    jobs.ingest(spark, Catalog(spark, root=f"{tmp_dir}/lake"), f"{tmp_dir}/csv", ["transactions"], audit_path=f"{tmp_dir}/audit")
    assert _shuffle_files(spark) <= before


def test_passes_hold_every_file_once(spark, tmp_dir):
    _files(tmp_dir, 7)
    path = f"{tmp_dir}/transactions"
    size = os.path.getsize(f"{path}/part-0.csv")
    passes = files.csv_passes(spark, path, 3 * size)
    assert [len(p) for p in passes] == [3, 3, 1]
    assert sorted(f.rsplit("/", 1)[1] for p in passes for f in p) == [f"part-{k}.csv" for k in range(7)]
    assert len(files.csv_passes(spark, path, 1)) == 7
    assert files.csv_passes(spark, path) == files.csv_passes(spark, path, 7 * size) == [[path]]
    assert files.csv_passes(spark, f"{path}/none") == [[f"{path}/none"]]
    os.makedirs(f"{path}/more")
    assert files.csv_passes(spark, path, 1) == [[path]]


def test_passes_are_one_version_with_all_rows(spark, tmp_dir, monkeypatch):
    _files(f"{tmp_dir}/csv", 7)
    monkeypatch.setattr(files, "PASS_BYTES", 1)
    lake = Catalog(spark, root=f"{tmp_dir}/lake")
    assert jobs.ingest(spark, lake, f"{tmp_dir}/csv", ["transactions"], audit_path=f"{tmp_dir}/audit", load_ts=dt.datetime(2024, 1, 5)) == {"transactions": 7}
    assert lake.versioned("raw", "transactions").versions() == [1]
    want = files.read_typed_csv(spark, f"{tmp_dir}/csv/transactions", "transactions")
    got = lake.source("transactions")
    assert got.count() == 7 and got.exceptAll(want).isEmpty()
    assert spark.read.parquet(lake.location("raw", "transactions")).where(F.col("_loaded_at") == F.lit(dt.datetime(2024, 1, 5))).count() == 7


def test_a_bad_row_of_a_later_pass_stops_the_load(spark, tmp_dir, monkeypatch):
    _files(f"{tmp_dir}/csv", 5, bad=4)
    monkeypatch.setattr(files, "PASS_BYTES", 1)
    lake = Catalog(spark, root=f"{tmp_dir}/lake")
    with pytest.raises(jobs.LoadFailed):
        jobs.ingest(spark, lake, f"{tmp_dir}/csv", ["transactions"], audit_path=f"{tmp_dir}/audit")
    assert not lake.versioned("raw", "transactions").exists()


def test_compressed_csv_has_the_same_rows(spark, tmp_dir):
    _files(tmp_dir, 5)
    rows = files.read_typed_csv(spark, f"{tmp_dir}/transactions", "transactions")
    assert sinks.write_csv(rows, f"{tmp_dir}/gz", compression="gzip")
    assert all(n.endswith(".csv.gz") for n in os.listdir(f"{tmp_dir}/gz") if n.startswith("part-"))
    back = files.read_typed_csv(spark, f"{tmp_dir}/gz", "transactions")
    assert back.count() == 5 and back.exceptAll(rows).isEmpty()
    assert not sinks.write_csv(rows.where(F.lit(False)), f"{tmp_dir}/none", compression="gzip")


def test_ingest_roundtrip_frees_its_shuffles(spark):
    before = _shuffle_files(spark)
    out = QUERIES["ingest_roundtrip"](spark, "/root/testdata/sf0.001")
    assert _shuffle_files(spark) <= before
    assert all(r.rows == r["keys"] == r.stamped == r.rows_processed and r.status == "success" for r in out.collect())
