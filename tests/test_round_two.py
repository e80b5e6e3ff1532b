"""Inputs that clean fixtures never contain: long ids, bad rows, lost days, unknown labels, empty tables."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake import functions as fn
from ledgerlake.operators import dedup, governance as g, marts, quality, reconcile, staging
from ledgerlake.plans import dashboard
from ledgerlake.plans.model import EXPLORES
from ledgerlake.registry import Models
from ledgerlake.session import shared_dir
from ledgerlake.sources import files, sinks
from ledgerlake.sources.testviews import CREDIT_CONTRACTS, CUSTOMERS, MERCHANTS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("spec", "column", "key"), [(MERCHANTS, "merchant_id", "s_suppkey"), (CUSTOMERS, "customer_id", "c_custkey"), (CREDIT_CONTRACTS, "contract_id", "o_orderkey")])
def test_long_ids_stay_whole(spark, spec, column, key):
    expr = dict(spec.columns)[column]
    keys = [7, 99999, 12345678, 12345679, 1500000000, 1500000001]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], f"{key} long").selectExpr(f"{expr} x").collect()]
    assert len(set(got)) == len(keys) and all(x.endswith(str(k)) for x, k in zip(got, keys, strict=True))
    con = duckdb.connect()
    assert [con.sql(f"SELECT {expr} FROM (SELECT {k}::BIGINT AS {key})").fetchall()[0][0] for k in keys] == got


def test_bad_rows_are_seen_by_counts(spark, tmp_dir):
    m = Models(spark, SF)
    names = [f.name for f in files.RAW_TABLES["transactions"].schema.fields]
    rows = m.cat.transactions.select(*[F.col(c).cast("string") for c in names]).limit(3).collect()
    good, amount, date = (r.asDict() for r in rows)
    amount["amount_brl"], date["transaction_date"] = "twelve", "soon"
    path = f"{tmp_dir}/bad"
    spark.createDataFrame([good, amount, date], ", ".join(f"{c} string" for c in names)).select(*names).coalesce(1).write.option("header", True).csv(path)
    ok, bad = files.read_with_quarantine(spark, path, "transactions")
    assert (ok.count(), bad.count()) == (1, 2) == (len(ok.collect()), len(bad.collect()))
    with pytest.raises(Exception, match="(?i)malformed|failfast|cannot"):
        files.read_typed_csv(spark, path, "transactions").count()


def test_lost_days_diverge_and_block(spark):
    m = Models(spark, SF)
    day = F.dayofmonth
    out = reconcile.tpv_daily_reconciliation(m.daily_summary.where(day("summary_date") != 3), m.transactions.where(day("transaction_date") != 5))
    bad = {r.summary_date.day for r in out.where("status = 'error'").collect()}
    assert bad == {3, 5}
    with pytest.raises(reconcile.CheckFailed):
        reconcile.assert_passed(out)
    reconcile.assert_passed(reconcile.tpv_daily_reconciliation(m.daily_summary, m.transactions))


def test_pivot_rows_add_up_to_the_tile(spark):
    m = Models(spark, SF)
    m.__dict__["transactions"] = m.transactions.withColumn("payment_method", F.when(F.col("payment_method") == "pix", "wallet").otherwise(F.col("payment_method")))
    who = g.Principal.of("executive")
    days = ("2000-01-01", "2001-01-01")
    weeks = dashboard.tile_tpv_weekly(m, who, days)
    total = sum(v or 0 for r in weeks.collect() for v in r[1:])
    assert total == dashboard.tile_tpv(m, who, days).first()[0]
    assert weeks.agg(F.sum("Outros")).first()[0] > 0


def test_nothing_is_said_outside_the_holiday_years(spark):
    hol = fn.national_holidays(range(2010, 2012))
    rows = [(dt.date(2011, 12, 19), dt.date(2011, 12, 30)), (dt.date(2012, 12, 24), dt.date(2012, 12, 31)), (dt.date(2011, 12, 1), dt.date(2012, 1, 1))]
    df = spark.createDataFrame(rows, "s date, e date")
    out = [(r.n, r.f, r.x, r.b) for r in fn.with_business_days(df, "s", "e", hol, out="n", start_flag="f").select("n", "f", fn.business_days_exact("s", "e", hol).alias("x"), fn.is_business_day("s", hol).alias("b")).collect()]
    assert [o[0] for o in out] == [o[2] for o in out] and [o[1] for o in out] == [o[3] for o in out]
    assert out[0][0] is not None and out[2][0] is not None and out[1] == (None, None, None, None)


def test_wrong_scale_raises(spark):
    df = spark.sql("SELECT CAST(1.2399 AS DECIMAL(9,4)) AS x")
    assert str(df.select(fn.money_sum("x", 4)).first()[0]) == "1.2399"
    with pytest.raises(Exception, match="more than 2 decimal places"):
        df.select(fn.money_sum("x")).collect()


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(Session())


def test_empty_child_sum_and_count(spark):
    m = Models(spark, SF)
    none = m.transactions.where("false")
    rows = quality.fk_coverage_many(none, "t", [("merchant_id", m.merchants, "merchants", "merchant_id"), ("customer_id", m.customers, "customers", "customer_id")]).collect()
    assert [(r.orphan_rows, r.total_rows, r.status) for r in rows] == [(0, 0, "pass")] * 2
    assert quality.sum_between(none, "t", "amount_brl", 0, 10).first().status == "error"
    empty = EXPLORES["credit_contracts"].query(m, ["credit_contracts.contract_count"], principal=g.Principal.of("risk"), filters={"credit_contracts.contract_date": ("2100-01-01", None), "customers.state": ["X"]})
    assert empty.first()[0] == 0


def test_field_grants_hold_for_filters_and_sorts(spark):
    m = Models(spark, SF)
    sales = g.Principal.of("sales")
    ask = dict(principal=sales, policies=[])
    explore = EXPLORES["credit_contracts"]
    open_explore = type(explore)(explore.name, explore.base, joins=explore.joins)
    for more in ({"filters": {"credit_contracts.individual_exposure_brl": lambda c: c > 100000}}, {"sorts": [("credit_contracts.exposure_brl", "desc")]}):
        with pytest.raises(g.AccessDenied):
            open_explore.query(m, ["credit_contracts.contract_count"], **ask, **more)


def test_operations_explore_counts_once(spark):
    m = Models(spark, SF)
    n = m.transactions.count()
    out = EXPLORES["transaction_operations"].query(m, ["transaction_operations.total_transactions"], principal=g.Principal.of("sales"), policies=[], filters={"transaction_operations.transaction_date": (None, None)})
    assert out.first()[0] == n


def test_emptied_day_is_removed(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = [(dt.date(2024, 1, d), d) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "d date, v int")
    sinks.write_incremental(df, path, "d", "2024-01-01")
    again = sinks.write_incremental(df.where("v not in (2, 4)").withColumn("v", F.col("v") + 10), path, "d", "2024-01-03")
    assert again.rows == 2
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 13, 15]
    assert [x for x in os.listdir(tmp_dir) if x != "t"] == []


def test_null_dates_are_kept_alike(spark):
    df = spark.createDataFrame([(None, 1), (dt.date(2000, 1, 1), 2)], "d date, v int")
    assert [r.v for r in sinks.retained(df, "d", "2024-01-01", keep_months=60).collect()] == [1]
    assert {r.partition_date: r.action for r in sinks.retention_report(df, "d", "2024-01-01", keep_months=60).collect()} == {None: "keep", dt.date(2000, 1, 1): "expire"}


def test_latest_row_with_nulls_and_ties(spark):
    rows = [("a", dt.date(2020, 1, 1), 1), ("a", dt.date(2020, 1, 1), 5), ("a", None, 9), (None, None, 3), (None, None, 4), ("b", None, 2)]
    got = dedup.dedup_latest(spark.createDataFrame(rows, "k string, d date, v int"), ["k"], ["d"]).collect()
    assert {(r.k, r.v) for r in got} == {("a", 5), (None, 4), ("b", 2)}


def test_operations_measures_match_staging(spark):
    m = Models(spark, SF)
    ops = marts.transaction_operations(staging.stg_transactions(m.cat.transactions))
    sums = {r.granularity: (r.n, r.t) for r in ops.groupBy("granularity").agg(F.sum("total_transactions").alias("n"), F.sum("tpv_brl").alias("t")).collect()}
    assert sums["daily"] == sums["monthly"]
