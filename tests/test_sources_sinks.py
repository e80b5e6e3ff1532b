"""Typed CSV scans, quarantine, sinks, retention, audit, jobs and streaming."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import marts, quality, staging
from ledgerlake.operators.reconcile import CheckFailed
from ledgerlake.plans import jobs
from ledgerlake.schemas import TRANSACTIONS
from ledgerlake.sources import audit, files, sinks
from ledgerlake.sources.catalog import Catalog
from ledgerlake.streaming import incremental

TX_HEADER = ",".join(f.name for f in TRANSACTIONS.fields)
GOOD_TX = [
    "T1,M1,C1,10.50,2.0000,0.21,10.29,pix,approved,2024-01-02,2024-01-02T10:00:00,1,A1,stone",
    "T2,M1,C2,20.00,2.0000,0.40,19.60,credit_card,denied,2024-01-03,2024-01-03T11:00:00,3,A2,rede",
]


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_typed_csv_reads_booleans_quotes_and_accents(spark, tmp_dir):
    header = "customer_id,company_name,cnpj,customer_segment,credit_rating,monthly_revenue_brl,registration_date,city,state,is_active,account_manager_id"
    _write(tmp_dir, "c.csv", [header,
                              'C1,"Padaria São João, Ltda",12.345.678/0001-90,sme,A,1000.00,2024-01-01,Recife,PE,True,AM001',
                              "C2,Ação,98.765.432/0001-10,micro,B,5.00,2024-01-02,Natal,RN,False,AM002"])
    rows = files.read_typed_csv(spark, tmp_dir, "customers").orderBy("customer_id").collect()
    assert rows[0].company_name == "Padaria São João, Ltda" and rows[0].is_active is True
    assert rows[1].is_active is False and rows[1].monthly_revenue_brl == Decimal("5.00")


@pytest.mark.parametrize("bad", [
    "T3,M1,C1,10.50,2.0000,0.21,10.29,pix,approved,2024-13-45,2024-01-02T10:00:00,1,A1,stone",  # wrong date
    "T4,M1,C1,abc,2.0000,0.21,10.29,pix,approved,2024-01-02,2024-01-02T10:00:00,1,A1,stone",    # wrong decimal
])
def test_failfast_rejects_bad_rows(spark, tmp_dir, bad):
    _write(tmp_dir, "t.csv", [TX_HEADER, *GOOD_TX, bad])
    with pytest.raises(Exception):
        files.read_typed_csv(spark, tmp_dir, "transactions").collect()


def test_required_guard_and_quarantine(spark, tmp_dir):
    missing_key = ",M1,C1,10.50,2.0000,0.21,10.29,pix,approved,2024-01-02,2024-01-02T10:00:00,1,A1,stone"
    bad_date = "T5,M1,C1,10.50,2.0000,0.21,10.29,pix,approved,2024-13-45,2024-01-02T10:00:00,1,A1,stone"
    _write(tmp_dir, "t.csv", [TX_HEADER, *GOOD_TX, missing_key, bad_date])
    with pytest.raises(files.RequiredColumnError):
        files.check_required(files.read_typed_csv(spark, tmp_dir, "transactions", mode="PERMISSIVE"), "transactions")
    good, bad = files.read_with_quarantine(spark, tmp_dir, "transactions")
    assert sorted(r.transaction_id for r in good.collect()) == ["T1", "T2"]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["missing_required", "parse_error"]


def test_write_table_counts_layout_and_dynamic_overwrite(spark, tmp_dir):
    df = spark.range(0, 100).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("d"),
        (F.col("id") % 3).alias("k"), F.col("id"))
    path = f"{tmp_dir}/t"
    res = sinks.write_table(df, path, partition_by="d", cluster_by=("k",))
    assert res.rows == 100
    again = sinks.write_table(df, path, partition_by="d", cluster_by=("k",))  # idempotent overwrite
    assert again.rows == 100 and spark.read.parquet(path).count() == 100
    one_day = df.where(F.col("d") == F.lit("2024-01-02").cast("date")).limit(5)
    sinks.write_table(one_day, path, partition_by="d", dynamic=True)
    counts = {r.d: r["count"] for r in spark.read.parquet(path).groupBy("d").count().collect()}
    assert counts[dt.date(2024, 1, 2)] == 5 and counts[dt.date(2024, 1, 1)] == 25
    plan = spark.read.parquet(path).where(F.col("d") == "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_csv_sink_skips_empty(spark, tmp_dir):
    assert sinks.write_csv(spark.range(0).toDF("x"), f"{tmp_dir}/empty") is False
    assert not os.path.exists(f"{tmp_dir}/empty")


def test_retention_report_and_partition_drop(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1), (dt.date(2024, 1, 1), 2)], "d date, v int")
    rep = {r.partition_date: r.action for r in sinks.retention_report(df, "d", "2024-06-01", 365).collect()}
    assert rep == {dt.date(2020, 1, 1): "expire", dt.date(2024, 1, 1): "keep"}
    assert [r.v for r in sinks.retained(df, "d", "2024-06-01", 365).collect()] == [2]
    spark.sql("DROP TABLE IF EXISTS ret_t")
    df.write.partitionBy("d").saveAsTable("ret_t")
    assert sinks.drop_expired_partitions(spark, "ret_t", "d", "2024-06-01", 365) == ["2020-01-01"]
    assert [r.v for r in spark.table("ret_t").collect()] == [2]


def test_jdbc_options():
    o = files.jdbc_options("jdbc:postgresql://h/db", "public.transactions", partition_column="id",
                           lower_bound=1, upper_bound=1000, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        files.jdbc_options("u", "t", partition_column="id")


def test_ingest_isolates_failures_and_audits(spark, tmp_dir):
    csv_root = f"{tmp_dir}/csv"
    _write(f"{csv_root}/transactions", "t.csv", [TX_HEADER, *GOOD_TX])
    _write(f"{csv_root}/daily_rates", "r.csv", ["rate_date,cdi_annual_pct,selic_annual_pct,usd_brl,eur_brl,is_business_day",
                                                 "not-a-date,1,1,1,1,True"])
    cat = Catalog(spark, root=f"{tmp_dir}/lake")
    with pytest.raises(jobs.LoadFailed):
        jobs.ingest(spark, cat, csv_root, ["transactions", "daily_rates"], audit_path=f"{tmp_dir}/audit",
                    run_id="r1", load_ts=dt.datetime(2024, 1, 5, 8))
    log = {r.step: r for r in audit.read_audit(spark, f"{tmp_dir}/audit").collect()}
    assert log["load_transactions"].status == "success" and log["load_transactions"].rows_processed == 2
    assert log["load_daily_rates"].status == "failed" and log["load_daily_rates"].error_message
    raw = cat.source("transactions")
    assert raw.count() == 2
    fresh = quality.freshness(spark.read.parquet(cat.location("raw", "transactions")), "transactions",
                              "_loaded_at", "2024-01-06 10:00:00").first()
    assert fresh.status == "warn"  # 26 hours


def test_build_mart_gate(spark, tmp_dir):
    df = spark.createDataFrame([(1, Decimal("5.00"))], "k int, v decimal(18,2)")
    ok = jobs.build_mart(spark, df, name="m", publish_path=f"{tmp_dir}/pub", staging_path=f"{tmp_dir}/stage1",
                         checks=lambda m: quality.sum_between(m, "m", "v", 0, 10), results_path=f"{tmp_dir}/res1")
    assert ok.rows == 1
    with pytest.raises(CheckFailed):
        jobs.build_mart(spark, df.withColumn("v", F.lit(Decimal("50.00"))), name="m", publish_path=f"{tmp_dir}/pub",
                        staging_path=f"{tmp_dir}/stage2", checks=lambda m: quality.sum_between(m, "m", "v", 0, 10))
    assert spark.read.parquet(f"{tmp_dir}/pub").first().v == Decimal("5.00")  # untouched


def test_streaming_refresh_is_incremental_and_idempotent(spark, tmp_dir):
    def tx(i, day, amount, status="approved"):
        return (f"T{i}", "M1", "C1", Decimal(amount), Decimal("2.0000"), Decimal("0.10"), Decimal(amount) - Decimal("0.10"),
                "pix", status, day, dt.datetime.combine(day, dt.time()), 1, "A", "stone")

    land, mart, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/mart", f"{tmp_dir}/ckpt"
    first = spark.createDataFrame([tx(1, dt.date(2024, 1, 2), "10.00"), tx(2, dt.date(2024, 2, 1), "5.00")], TRANSACTIONS)
    incremental.land(first, land)
    incremental.start_refresh(spark, land, mart, ckpt).awaitTermination()
    second = spark.createDataFrame([tx(3, dt.date(2024, 1, 2), "7.00")], TRANSACTIONS)
    incremental.land(second, land)
    incremental.start_refresh(spark, land, mart, ckpt).awaitTermination()
    got = {r.summary_date: r.total_tpv_brl for r in spark.read.parquet(mart).collect()}
    assert got == {dt.date(2024, 1, 2): Decimal("17.00"), dt.date(2024, 2, 1): Decimal("5.00")}
    expected = marts.mart_fin_daily_summary(staging.stg_transactions(first.unionByName(second)))
    assert expected.count() == 2


def test_concurrent_ingest_counts_each_table(spark, tmp_dir):
    csv_root = f"{tmp_dir}/csv"
    _write(f"{csv_root}/transactions", "t.csv", [TX_HEADER, *GOOD_TX])
    _write(f"{csv_root}/daily_rates", "r.csv", ["rate_date,cdi_annual_pct,selic_annual_pct,usd_brl,eur_brl,is_business_day",
                                                 "2024-01-02,10.5,10.6,4.9,5.3,True", "2024-01-03,10.5,10.6,4.9,5.3,True",
                                                 "2024-01-06,10.5,10.6,4.9,5.3,False"])
    _write(f"{csv_root}/merchants", "m.csv", ["merchant_id,merchant_name,merchant_segment,mdr_credit,mdr_debit,mdr_pix,activated_at,is_active,customer_id",
                                               "M1,Loja,retail,2.5,1.2,0.5,2023-01-01,True,C1"])
    cat = Catalog(spark, root=f"{tmp_dir}/lake")
    loaded = jobs.ingest(spark, cat, csv_root, ["transactions", "daily_rates", "merchants"],
                         audit_path=f"{tmp_dir}/audit", run_id="r2", max_parallel=3)
    assert loaded == {"transactions": 2, "daily_rates": 3, "merchants": 1}
    assert {r.step: r.rows_processed for r in audit.read_audit(spark, f"{tmp_dir}/audit").collect()} == {
        "load_transactions": 2, "load_daily_rates": 3, "load_merchants": 1}
