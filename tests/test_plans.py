"""Plan shape: one exchange for the daily mart, partition pruning on stored
marts, no Python UDFs anywhere, no window in dedup."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dedup, governance as g, marts, staging
from ledgerlake.plans import dashboard
from ledgerlake.registry import QUERIES, Models
from ledgerlake.sources import sinks

SF = "/root/testdata/sf0.001"
WRITES = {"csv_roundtrip", "partitioned_sink_roundtrip", "audit_append", "quarantine_split", "streaming_daily_summary",
          "ingest_roundtrip", "incremental_write", "operations_mart", "mart_gate", "table_versions"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    m = Models(spark, SF)
    sinks.write_table(m.cat.transactions, f"{root}/transactions", partition_by="transaction_date",
                      cluster_by=("merchant_id", "payment_method", "status"))
    sinks.write_table(m.daily_summary, f"{root}/mart_fin_daily_summary", partition_by="summary_date",
                      cluster_by=("payment_method",))
    return root


def test_daily_mart_over_stored_transactions_has_one_exchange(spark, stored):
    raw = spark.read.parquet(f"{stored}/transactions")
    plan = _plan(marts.mart_fin_daily_summary(staging.stg_transactions(raw)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan


def test_tile_on_stored_mart_prunes_partitions(spark, stored):
    class Ctx:
        as_of = "2001-08-01"
        daily_summary = spark.read.parquet(f"{stored}/mart_fin_daily_summary")

    df = dashboard.tile_tpv(Ctx(), g.Principal.of("executive"), ("2000-01-01", "2001-01-01"))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(summary_date" in plan and "2000-01-01" in plan.replace("10957", "2000-01-01")


def test_predicates_reach_the_scan(spark, stored):
    raw = spark.read.parquet(f"{stored}/transactions")
    stg = staging.stg_transactions(raw).where(F.col("payment_method") == "pix").select("amount_brl")
    plan = _plan(stg)
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "IsNotNull(transaction_id)" in pushed and "GreaterThan(amount_brl,0.00)" in pushed
    assert "ReadSchema: struct<transaction_id:string,amount_brl:decimal(18,2),payment_method:string>" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_udf_in_any_query(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_dedup_is_an_aggregate_not_a_window(spark):
    m = Models(spark, SF)
    plan = _plan(dedup.dedup_latest(m.contracts, ["customer_id"], ["contract_date", "contract_id"]))
    assert "Window" not in plan
    assert "partial_max(struct(" in plan  # map-side partial aggregate: a hot key collapses per task


def test_operations_scan_transactions_once(spark, stored):
    raw = spark.read.parquet(f"{stored}/transactions")
    ops = marts.transaction_operations(staging.stg_transactions(raw))
    ops.collect()
    plan = _plan(ops)  # the final plan: months reuse the days' aggregate
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "Expand" not in plan and ("ReusedExchange" in final or final.count("FileScan parquet") == 1)


def test_operations_policies_and_dates_reach_the_scan(spark, stored):
    raw = spark.read.parquet(f"{stored}/transactions").withColumn("transaction_date", F.col("transaction_date").cast("date"))
    ops = marts.transaction_operations(staging.stg_transactions(raw))
    month_only = _plan(g.aggregate_only(ops))
    assert month_only.count("FileScan parquet") == 1
    days = _plan(ops.where((F.col("granularity") == "daily") & (F.col("period_start") >= "2001-01-01")))
    assert days.count("FileScan parquet") == 1 and "2001-01-01" in days[days.index("PartitionFilters"):]


def test_explore_aggregates_before_dimension_joins(spark):
    from ledgerlake.plans.model import EXPLORES

    df = EXPLORES["credit_contracts"].query(
        Models(spark, SF), ["customers.state", "credit_contracts.contract_count", "credit_contracts.exposure_brl"],
        principal=g.Principal.of("risk"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join LeftOuter")
    assert "Aggregate" in plan[join_at:]  # the contract rows are collapsed below the join


def test_fk_coverage_shuffles_keys_not_rows(spark):
    from ledgerlake.operators import quality

    m = Models(spark, SF)
    plan = _plan(quality.fk_coverage(m.transactions, "t", "merchant_id", m.merchants, "m", "merchant_id"))
    assert "partial_count(1)" in plan


def test_unique_check_exact_with_duplicates_and_nulls(spark):
    from ledgerlake.operators import quality

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",), ("c",), ("c",)], "k string")
    r = quality.unique(df, "t", "k").first()
    assert (r.failing_rows, r.total_rows, r.status) == (2, 8, "error")
    assert quality.unique(df.where("k = 'b'"), "t", "k").first().failing_rows == 0


def test_fk_coverage_many_single_scan_and_exact(spark):
    from ledgerlake.operators import quality

    child = spark.createDataFrame([("m1", "c1"), ("m1", "cX"), ("mX", None), (None, "c1")], "m string, c string")
    merchants = spark.createDataFrame([("m1",), ("m1",)], "m string")
    customers = spark.createDataFrame([("c1",)], "c string")
    out = quality.fk_coverage_many(child, "t", [("m", merchants, "merchants", "m"), ("c", customers, "customers", "c")])
    assert _plan(out).count("Expand") == 1  # one pass over the child for both keys
    got = {r.fk_column: (r.orphan_rows, r.total_rows) for r in out.collect()}
    assert got == {"m": (1, 4), "c": (1, 4)}
