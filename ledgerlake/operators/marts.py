"""Mart models: the aggregated data products.

Plans are declared once and left to Catalyst/AQE: every aggregation is a
two-phase (partial + final) hash aggregate, so a hot group key is combined
map-side before the single exchange on the group keys; dimension joins are
left to AQE, which turns a join into a broadcast only after measuring the
small side at runtime.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    dpd_bucket,
    from_unscaled,
    money_sum,
    unscaled,
    exact_ratio,
    expected_loss,
    money_per_count,
    money_ratio,
)

RATE_SUM_TYPE = "decimal(22,4)"


def _approved(c: str) -> Column:
    return F.when(F.col("is_approved"), F.col(c))


def mart_fin_daily_summary(stg_transactions: DataFrame, *, run_ts: dt.datetime | None = None) -> DataFrame:
    """M6. Date x payment method: volume, TPV, MDR revenue, rates.

    One shuffle (on the two group keys) after a map-side partial aggregate;
    the repeated ``count_if(is_approved)`` is computed once by Catalyst.
    """
    return daily_summary_of(daily_summary_partials(stg_transactions), run_ts=run_ts)


DAILY_SUMMARY_KEYS = ("summary_date", "payment_method")


def daily_summary_partials(stg_transactions: DataFrame) -> DataFrame:
    """M6's additive part: counts and sums by date and payment method.

    Partials of disjoint transactions add up (``add_daily_partials``), so they can be kept
    as state and extended by new transactions alone.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    return stg_transactions.groupBy(
        F.col("transaction_date").alias("summary_date"), F.col("payment_method")
    ).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("is_approved")).alias("approved_transactions"),
        F.count_if(F.col("is_chargeback")).alias("chargeback_transactions"),
        money_sum(_approved("amount_brl").otherwise(zero)).alias("tpv"),
        money_sum(_approved("mdr_amount_brl").otherwise(zero)).alias("mdr_revenue"),
        money_sum(_approved("net_amount_brl").otherwise(zero)).alias("net_amount"),
        money_sum(_approved("amount_brl")).alias("approved_amount_sum"),
        F.count(_approved("amount_brl")).alias("approved_amount_n"),
        money_sum(_approved("mdr_rate_pct"), 4).alias("approved_rate_sum"),
        F.count(_approved("mdr_rate_pct")).alias("approved_rate_n"),
        F.count_if(F.col("is_installment") & F.col("is_approved")).alias("installment_transactions"),
    )


def add_daily_partials(partials: DataFrame) -> DataFrame:
    """Partials of the same date and payment method, added up; the types stay."""
    sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in partials.schema.fields if f.name not in DAILY_SUMMARY_KEYS]
    return partials.groupBy(*DAILY_SUMMARY_KEYS).agg(*sums)


def daily_summary_of(partials: DataFrame, *, run_ts: dt.datetime | None = None) -> DataFrame:
    """M6's columns from its additive part."""
    out = partials.select(
        "summary_date",
        "payment_method",
        "total_transactions",
        "approved_transactions",
        "chargeback_transactions",
        F.round("tpv", 2).alias("total_tpv_brl"),
        F.round("mdr_revenue", 2).alias("total_mdr_revenue_brl"),
        F.round("net_amount", 2).alias("total_net_amount_brl"),
        money_per_count("approved_amount_sum", "approved_amount_n", 2).alias("avg_ticket_brl"),
        exact_ratio("approved_rate_sum", "approved_rate_n", 4, num_type=RATE_SUM_TYPE).alias("avg_mdr_rate_pct"),
        exact_ratio("approved_transactions", "total_transactions", 2, times=100).alias("approval_rate_pct"),
        exact_ratio("chargeback_transactions", "approved_transactions", 4, times=100).alias("chargeback_rate_pct"),
        "installment_transactions",
        exact_ratio("installment_transactions", "approved_transactions", 2, times=100).alias("installment_rate_pct"),
    )
    if run_ts is not None:
        out = out.withColumn("_updated_at", F.lit(run_ts).cast("timestamp"))
    return out


PORTFOLIO_KEYS = ("product_type", "risk_classification_bacen", "dpd_bucket", "customer_segment", "collateral_type")


def enriched_contracts(stg_contracts: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Contracts + customer segment/rating, DPD bucket and expected loss.

    Left join on customer_id: an unmatched contract keeps NULL segment.
    """
    customers = stg_customers.select(
        "customer_id", "customer_segment", F.col("credit_rating").alias("customer_credit_rating")
    )
    return stg_contracts.join(customers, "customer_id", "left").withColumns({
        "dpd_bucket": dpd_bucket("days_past_due"),
        "expected_loss_brl": expected_loss("risk_classification_bacen", "outstanding_balance_brl"),
    })


def mart_risk_credit_portfolio(stg_contracts: DataFrame, stg_customers: DataFrame, *,
                               snapshot_date: dt.date | str | None = None,
                               run_ts: dt.datetime | None = None,
                               approximate_distinct: bool = False) -> DataFrame:
    """M7. Product x class x bucket x segment x collateral portfolio metrics.

    Inclusion ``is_active OR is_npl`` is three-valued (NULL OR TRUE keeps).
    The predicate only reads contract columns, so Catalyst pushes it below
    the customer join into the contract scan. The two exact distinct counts
    plan as one Expand + two exchanges; ``approximate_distinct=True`` swaps
    them for HyperLogLog++ sketches (one exchange, ~2% error).
    """
    distinct = (lambda c: F.approx_count_distinct(c)) if approximate_distinct else F.count_distinct
    zero = F.lit(0).cast("decimal(18,2)")
    ol = F.col("outstanding_balance_brl")
    summary = (
        enriched_contracts(stg_contracts, stg_customers)
        .where(F.col("is_active") | F.col("is_npl"))
        .groupBy(*PORTFOLIO_KEYS)
        .agg(
            distinct("contract_id").alias("total_contracts"),
            distinct("customer_id").alias("total_customers"),
            money_sum("principal_brl").alias("principal"),
            money_sum(ol).alias("outstanding"),
            F.count_if(F.col("is_npl")).alias("npl_contracts"),
            money_sum(F.when(F.col("is_npl"), ol).otherwise(zero)).alias("npl_balance"),
            F.count_if(F.col("is_written_off")).alias("written_off_contracts"),
            money_sum(F.when(F.col("is_written_off"), ol).otherwise(zero)).alias("written_off_balance"),
            money_sum("expected_loss_brl", 5).alias("expected_loss"),
            money_sum("collateral_value_brl").alias("collateral"),
        )
    )
    cols = [
        *PORTFOLIO_KEYS,
        "total_contracts",
        "total_customers",
        F.round("principal", 2).alias("total_principal_brl"),
        F.round("outstanding", 2).alias("total_outstanding_brl"),
        "npl_contracts",
        F.round("npl_balance", 2).alias("npl_balance_brl"),
        money_ratio("npl_balance", "outstanding", 4, times=100).alias("npl_rate_pct"),
        "written_off_contracts",
        F.round("written_off_balance", 2).alias("written_off_balance_brl"),
        F.round("expected_loss", 2).alias("total_expected_loss_brl"),
        F.round("collateral", 2).alias("total_collateral_brl"),
        money_ratio("collateral", "outstanding", 4).alias("portfolio_coverage_ratio"),
    ]
    if run_ts is not None:
        cols.append(F.lit(run_ts).cast("timestamp").alias("_updated_at"))
    if snapshot_date is not None:
        cols.append(F.lit(snapshot_date).cast("date").alias("snapshot_date"))
    return summary.select(*cols)


PORTFOLIO_SKETCHES = ("contracts", "customers")
PORTFOLIO_SUMS = ("principal", "outstanding", "npl_contracts", "npl_balance", "written_off_contracts", "written_off_balance", "expected_loss", "collateral")
SKETCH_LOG2 = 14  # 16,384 registers: a standard error of 0.8 %


def portfolio_partials(stg_contracts: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """M7's mergeable part: sums, and sketches of the contracts and customers, per portfolio key.

    Partials of any split of the contracts (days, regions, books) add up by ``merge_portfolio_partials``, whatever
    contracts or customers they share; stored per day they give distinct counts of any period without
    reading a contract again. One exchange, and no row is multiplied.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    ol = F.col("outstanding_balance_brl")
    return (
        enriched_contracts(stg_contracts, stg_customers)
        .where(F.col("is_active") | F.col("is_npl"))
        .groupBy(*PORTFOLIO_KEYS)
        .agg(
            F.hll_sketch_agg("contract_id", F.lit(SKETCH_LOG2)).alias("contracts"),
            F.hll_sketch_agg("customer_id", F.lit(SKETCH_LOG2)).alias("customers"),
            money_sum("principal_brl").alias("principal"),
            money_sum(ol).alias("outstanding"),
            F.count_if(F.col("is_npl")).alias("npl_contracts"),
            money_sum(F.when(F.col("is_npl"), ol).otherwise(zero)).alias("npl_balance"),
            F.count_if(F.col("is_written_off")).alias("written_off_contracts"),
            money_sum(F.when(F.col("is_written_off"), ol).otherwise(zero)).alias("written_off_balance"),
            money_sum("expected_loss_brl", 5).alias("expected_loss"),
            money_sum("collateral_value_brl").alias("collateral"),
        )
    )


def merge_portfolio_partials(partials: DataFrame, keys: Sequence[str] = PORTFOLIO_KEYS) -> DataFrame:
    """Partials brought to one row per ``keys`` (all portfolio keys, or fewer): sketches united, sums added."""
    types = {f.name: f.dataType for f in partials.schema.fields}
    united = [F.hll_union_agg(c).alias(c) for c in PORTFOLIO_SKETCHES]
    return partials.groupBy(*keys).agg(*united, *[F.sum(c).cast(types[c]).alias(c) for c in PORTFOLIO_SUMS])


def portfolio_estimates(partials: DataFrame) -> DataFrame:
    """Estimated distinct contracts and customers beside the exact sums."""
    return partials.select(
        *[c for c in partials.columns if c not in (*PORTFOLIO_SKETCHES, *PORTFOLIO_SUMS)],
        *[F.hll_sketch_estimate(c).alias(f"total_{c}") for c in PORTFOLIO_SKETCHES],
        F.round("outstanding", 2).alias("total_outstanding_brl"),
        F.round("npl_balance", 2).alias("npl_balance_brl"),
        money_ratio("npl_balance", "outstanding", 4, times=100).alias("npl_rate_pct"),
        F.round("expected_loss", 2).alias("total_expected_loss_brl"),
    )


def _money_sums() -> list[Column]:
    """Approved-only money sums (0 when nothing is approved)."""
    zero = F.lit(0).cast("decimal(18,2)")
    return [
        money_sum(_approved("amount_brl").otherwise(zero)).alias("tpv"),
        money_sum(_approved("mdr_amount_brl").otherwise(zero)).alias("mdr_revenue"),
        money_sum(_approved("net_amount_brl").otherwise(zero)).alias("net_amount"),
    ]


def merchant_metrics(stg_transactions: DataFrame, stg_merchants: DataFrame) -> DataFrame:
    """M8. Per merchant: volume, TPV, MDR revenue and effective MDR.

    Transactions are aggregated to merchant grain *before* the join, so the
    fact table is shuffled once (partially aggregated) and the join runs on
    one row per merchant.
    """
    per_merchant = stg_transactions.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("is_approved")).alias("approved_transactions"),
        *_money_sums(),
    )
    dims = stg_merchants.select("merchant_id", "merchant_segment", "customer_id", "blended_mdr_pct")
    return per_merchant.join(dims, "merchant_id", "left").select(
        "merchant_id",
        "merchant_segment",
        "customer_id",
        "total_transactions",
        "approved_transactions",
        F.col("tpv").alias("total_tpv_brl"),
        F.col("mdr_revenue").alias("total_mdr_revenue_brl"),
        F.col("net_amount").alias("total_net_amount_brl"),
        money_ratio(F.col("tpv") - F.col("net_amount"), "tpv", 4, times=100).alias("effective_mdr_pct"),
        "blended_mdr_pct",
        exact_ratio("approved_transactions", "total_transactions", 2, times=100).alias("approval_rate_pct"),
    )


OPERATIONS_KEYS = ("merchant_id", "acquirer")


OPERATIONS_SUMS = ("total_transactions", "approved_transactions", "denied_transactions", "chargeback_transactions", "_tpv", "_mdr")


def operations_daily(stg_transactions: DataFrame, *, since: dt.date | str | None = None,
                     until: dt.date | str | None = None) -> DataFrame:
    """Day x merchant x acquirer sums: all that M9 needs of the transactions, and additive.

    ``since`` and ``until`` (exclusive) bound the days at the scan. The table can be stored and
    added to; both grains of M9 come from it.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    day = F.col("transaction_date")
    rows = stg_transactions
    if since is not None:
        rows = rows.where(day >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(day < F.lit(until).cast("date"))
    return rows.groupBy(day.alias("period_start"), *OPERATIONS_KEYS).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("is_approved")).alias("approved_transactions"),
        F.count_if(F.col("status") == "denied").alias("denied_transactions"),
        F.count_if(F.col("is_chargeback")).alias("chargeback_transactions"),
        F.sum(unscaled(_approved("amount_brl").otherwise(zero))).alias("_tpv"),
        F.sum(unscaled(_approved("mdr_amount_brl").otherwise(zero))).alias("_mdr"),
    )


def _operations(rows: DataFrame) -> DataFrame:
    """M9's columns from summed rows with their granularity."""
    rows = rows.withColumns({"tpv_brl": from_unscaled("_tpv"), "mdr_revenue_brl": from_unscaled("_mdr")})
    return rows.select(
        "granularity",
        "period_start",
        *OPERATIONS_KEYS,
        "total_transactions",
        "approved_transactions",
        "denied_transactions",
        "chargeback_transactions",
        "tpv_brl",
        "mdr_revenue_brl",
        exact_ratio("approved_transactions", "total_transactions", 2, times=100).alias("approval_rate_pct"),
        exact_ratio("chargeback_transactions", "total_transactions", 4, times=100).alias("chargeback_rate_pct"),
    )


def _by_month(daily: DataFrame) -> DataFrame:
    month = F.date_trunc("month", F.col("period_start")).cast("date")
    return daily.groupBy(month.alias("period_start"), *OPERATIONS_KEYS).agg(*[F.sum(c).alias(c) for c in OPERATIONS_SUMS])


def operations_periods(daily: DataFrame) -> DataFrame:
    """M9, both grains, from the daily sums: every daily row counts for its day and for its month.

    The rows are doubled after the daily aggregate, so the transactions are scanned and
    shuffled once, whatever is asked of the result; bounds belong in ``operations_daily``.
    """
    day, month = F.col("period_start"), F.date_trunc("month", F.col("period_start")).cast("date")
    period = F.inline(F.array(F.struct(F.lit("daily").alias("granularity"), day.alias("period")),
                              F.struct(F.lit("monthly").alias("granularity"), month.alias("period"))))
    doubled = daily.select(period, *OPERATIONS_KEYS, *OPERATIONS_SUMS)
    return _operations(doubled.groupBy("granularity", F.col("period").alias("period_start"), *OPERATIONS_KEYS)
                       .agg(*[F.sum(c).alias(c) for c in OPERATIONS_SUMS]))


def operations_monthly(stg_transactions: DataFrame, **bounds) -> DataFrame:
    """M9's months alone: transactions, added up by day, then by month."""
    return _operations(_by_month(operations_daily(stg_transactions, **bounds)).withColumn("granularity", F.lit("monthly")))


def transaction_operations(stg_transactions: DataFrame) -> DataFrame:
    """M9. Day x merchant x acquirer, plus the monthly roll-up of the same rows.

    ``granularity`` ('daily' / 'monthly') is what the aggregate-only row policy
    filters on. This form is for readers of one grain: a filter on it removes the other branch, and a
    date filter on the daily rows reaches the scan. For both grains see ``operations_periods``.
    """
    daily = operations_daily(stg_transactions)
    return _operations(daily.withColumn("granularity", F.lit("daily")).unionByName(_by_month(daily).withColumn("granularity", F.lit("monthly"))))


def chargeback_metrics(stg_transactions: DataFrame) -> DataFrame:
    """M10. Month x payment method x acquirer: contested share of transactions."""
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        stg_transactions.groupBy(
            F.date_trunc("month", "transaction_date").cast("date").alias("month"),
            "payment_method",
            "acquirer",
        )
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_if(F.col("is_chargeback")).alias("chargeback_transactions"),
            money_sum(F.when(F.col("is_chargeback"), F.col("amount_brl")).otherwise(zero)).alias("chargeback_amount_brl"),
        )
        .withColumn(
            "chargeback_rate_pct",
            exact_ratio("chargeback_transactions", "total_transactions", 4, times=100),
        )
    )


def net_revenue(stg_transactions: DataFrame, operating_costs: DataFrame) -> DataFrame:
    """M11. Month x payment method: MDR revenue minus operating cost.

    ``operating_costs`` is supplied by the caller (cost_month, payment_method,
    cost_brl); the reference has no cost data. Full outer join: a month with
    cost and no revenue (or the reverse) still appears, missing side = 0.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    revenue = stg_transactions.groupBy(
        F.date_trunc("month", "transaction_date").cast("date").alias("month"), "payment_method"
    ).agg(money_sum(_approved("mdr_amount_brl").otherwise(zero)).alias("mdr_revenue_brl"))
    costs = operating_costs.groupBy(F.col("cost_month").alias("month"), "payment_method").agg(
        F.sum("cost_brl").alias("operating_cost_brl")
    )
    joined = revenue.join(costs, ["month", "payment_method"], "full_outer")
    rev = F.coalesce("mdr_revenue_brl", zero)
    cost = F.coalesce("operating_cost_brl", zero)
    return joined.select(
        "month",
        "payment_method",
        rev.alias("mdr_revenue_brl"),
        cost.alias("operating_cost_brl"),
        (rev - cost).alias("net_revenue_brl"),
    )


def acquisition_cost(stg_customers: DataFrame, marketing_costs: DataFrame) -> DataFrame:
    """M12. Month: marketing cost / customers registered that month.

    ``marketing_costs`` (cost_month, cost_brl) comes from the caller. CAC is
    NULL for a month without new customers.
    """
    new = stg_customers.groupBy(
        F.date_trunc("month", "registration_date").cast("date").alias("month")
    ).agg(F.count(F.lit(1)).alias("new_customers"))
    cost = marketing_costs.groupBy(F.col("cost_month").alias("month")).agg(
        F.sum("cost_brl").alias("marketing_cost_brl")
    )
    joined = new.join(cost, "month", "full_outer")
    n = F.coalesce("new_customers", F.lit(0).cast("bigint"))
    c = F.coalesce("marketing_cost_brl", F.lit(0).cast("decimal(18,2)"))
    return joined.select(
        "month",
        n.alias("new_customers"),
        c.alias("marketing_cost_brl"),
        money_per_count(c, n, 2).alias("cac_brl"),
    )


def current_contract_per_customer(stg_contracts: DataFrame) -> DataFrame:
    """M13 applied: each customer's latest contract (by date, then id)."""
    from .dedup import latest_per_key

    return latest_per_key(stg_contracts, ["customer_id"], ["contract_date", "contract_id"])
