"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver tables through the domain views, runs the library
operator over the whole tables and normalises types at the edge
(``to_edge``) so the DuckDB twin in ``oracle_sql`` compares value for value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .edge import to_edge
from . import functions as fn
from .operators import governance, marts, quality, reconcile, staging
from .plans import dashboard, jobs, model, semantic
from .schemas import RAW_TABLES, TRANSACTIONS
from .session import configure, scratch_path, shuffles_freed
from .sources import audit, files, sinks
from .sources.catalog import Catalog
from .streaming import incremental
from .sources.testviews import AS_OF, TestCatalog
from .sources.versions import VersionedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUILDERS: dict[str, Callable[["Models"], DataFrame]] = {}  # the same queries over any Models


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return to_edge(fn(Models(spark, sf_dir)))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        BUILDERS[name] = fn
        return fn

    return deco


class LakeSources:
    """Raw tables of a ``Catalog`` (stored typed parquet) by attribute name."""

    def __init__(self, catalog):
        self.catalog = catalog

    def __getattr__(self, name: str) -> DataFrame:
        return self.catalog.source(name)


class Models:
    """Staging and mart DataFrames over one source of raw tables (lazy).

    ``cat`` defaults to the fixture views over a driver folder; pass
    ``LakeSources(catalog)`` to run over a stored raw layer instead.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, as_of: str = AS_OF, cat=None):
        self.spark = spark
        self.cat = cat if cat is not None else TestCatalog(spark, sf_dir)
        self.as_of = as_of

    @cached_property
    def transactions(self) -> DataFrame:
        return staging.stg_transactions(self.cat.transactions)

    @cached_property
    def contracts(self) -> DataFrame:
        return staging.stg_credit_contracts(self.cat.credit_contracts, as_of=self.as_of)

    @cached_property
    def merchants(self) -> DataFrame:
        return staging.stg_merchants(self.cat.merchants)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.cat.customers)

    @cached_property
    def rates(self) -> DataFrame:
        return staging.stg_daily_rates(self.cat.daily_rates)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return marts.mart_fin_daily_summary(self.transactions)

    @cached_property
    def portfolio(self) -> DataFrame:
        return marts.mart_risk_credit_portfolio(self.contracts, self.customers, snapshot_date=self.as_of)

    @cached_property
    def operations(self) -> DataFrame:
        return marts.transaction_operations(self.transactions)

    @cached_property
    def operations_daily(self) -> DataFrame:
        return marts.operations_daily(self.transactions)

    @cached_property
    def merchant_metrics(self) -> DataFrame:
        return marts.merchant_metrics(self.transactions, self.merchants)

    @cached_property
    def revenue(self) -> DataFrame:
        return marts.net_revenue(self.transactions, self.cat.operating_costs)


# --- staging ---------------------------------------------------------------

@register("stg_transactions")
def _stg_transactions(m: Models) -> DataFrame:
    """M1: cleaned transactions with raw-status flags."""
    return m.transactions


@register("stg_credit_contracts")
def _stg_credit_contracts(m: Models) -> DataFrame:
    """M2: cleaned contracts; coverage ratio shown at 6 decimals."""
    return m.contracts.withColumn("collateral_coverage_ratio", F.round("collateral_coverage_ratio", 6))


@register("stg_merchants")
def _stg_merchants(m: Models) -> DataFrame:
    """M3: cleaned merchants with blended MDR."""
    return m.merchants


@register("stg_customers_masked")
def _stg_customers(m: Models) -> DataFrame:
    """M4: customers with the tax id masked."""
    return m.customers


@register("stg_daily_rates")
def _stg_daily_rates(m: Models) -> DataFrame:
    """M5: typed daily rates."""
    return m.rates


# --- marts -------------------------------------------------------------------

@register("mart_fin_daily_summary")
def _mart_fin_daily_summary(m: Models) -> DataFrame:
    """M6: date x payment method KPIs."""
    return m.daily_summary


@register("mart_risk_credit_portfolio")
def _mart_risk_credit_portfolio(m: Models) -> DataFrame:
    """M7: credit portfolio by product, class, bucket, segment, collateral."""
    return m.portfolio


@register("merchant_metrics")
def _merchant_metrics(m: Models) -> DataFrame:
    """M8: per-merchant TPV, MDR revenue and effective MDR."""
    return marts.merchant_metrics(m.transactions, m.merchants)


@register("transaction_operations")
def _transaction_operations(m: Models) -> DataFrame:
    """M9: day and month x merchant x acquirer operations."""
    return marts.operations_periods(m.operations_daily)


@register("operations_window")
def _operations_window(m: Models) -> DataFrame:
    """Both grains of a window of days; the bounds reach the scan of the transactions."""
    return marts.operations_periods(marts.operations_daily(m.transactions, since="2000-01-15", until="2000-07-10"))


@register("operations_mart")
def _operations_mart(m: Models) -> DataFrame:
    """The daily sums stored as a versioned mart, both grains read back from it, from a given day on."""
    table = VersionedTable(m.spark, _scratch(m, "operations"))
    jobs.publish_mart(table, sinks.spread(m.operations_daily, "period_start"), name="operations_daily", partition_by="period_start", arrange=False)
    return marts.operations_periods(table.read().where(F.col("period_start") >= F.lit(OPERATIONS_SINCE).cast("date")))


OPERATIONS_SINCE = "2000-10-01"


@register("chargeback_metrics")
def _chargeback_metrics(m: Models) -> DataFrame:
    """Contested share by month, method and acquirer."""
    return marts.chargeback_metrics(m.transactions)


@register("net_revenue")
def _net_revenue(m: Models) -> DataFrame:
    """MDR revenue minus the supplied operating cost."""
    return marts.net_revenue(m.transactions, m.cat.operating_costs)


@register("acquisition_cost")
def _acquisition_cost(m: Models) -> DataFrame:
    """Marketing cost per newly registered customer."""
    return marts.acquisition_cost(m.customers, m.cat.marketing_costs)


@register("dedup_latest")
def _dedup_latest(m: Models) -> DataFrame:
    """Latest contract per customer."""
    return marts.current_contract_per_customer(m.contracts).select(
        "customer_id", "contract_id", "contract_date", "product_type",
        "outstanding_balance_brl", "risk_classification_bacen", "is_active",
    )


# --- domain functions --------------------------------------------------------

@register("calculate_mdr")
def _calculate_mdr(m: Models) -> DataFrame:
    """F13 per transaction, 4 decimals."""
    t = m.transactions
    return t.select("transaction_id", F.round(fn.calculate_mdr("amount_brl", "net_amount_brl"), 4).alias("mdr_pct"))


@register("classify_risk")
def _classify_risk(m: Models) -> DataFrame:
    """F14 from days past due, checked against the stored class."""
    c = m.contracts
    cls = fn.classify_risk_bacen("days_past_due")
    return c.select(
        "contract_id", "days_past_due", cls.alias("risk_class"),
        (cls == F.col("risk_classification_bacen")).alias("matches_source"),
    )


@register("provision_rate")
def _provision_rate(m: Models) -> DataFrame:
    """provision rate and expected loss per contract."""
    c = m.contracts
    return c.select(
        "contract_id", "risk_classification_bacen",
        fn.provision_rate("risk_classification_bacen").alias("provision_rate"),
        F.round(fn.expected_loss("risk_classification_bacen", "outstanding_balance_brl"), 2).alias("expected_loss_brl"),
    )


@register("mask_pii")
def _mask_pii(m: Models) -> DataFrame:
    """F16: every mask type over customer text columns."""
    c = m.cat.customers
    return c.select(
        "customer_id",
        fn.mask_pii("cnpj", "cnpj").alias("cnpj_masked"),
        fn.mask_pii("cnpj", "cpf").alias("cpf_masked"),
        fn.mask_pii("account_manager_id", "bank_account").alias("account_masked"),
        fn.mask_pii("company_name", "email").alias("email_masked"),
        fn.mask_pii("cnpj", "phone").alias("phone_masked"),
        fn.mask_pii("company_name").alias("name_hash"),
    )


@register("business_days_macro")
def _business_days_macro(m: Models) -> DataFrame:
    """the reference's closed-form weekday approximation."""
    c = m.contracts
    return c.select("contract_id", "contract_date", "maturity_date",
                    fn.business_days_between("contract_date", "maturity_date").alias("business_days"))


HOLIDAY_YEARS = range(1990, 2011)


@register("business_days_calendar")
def _business_days_calendar(m: Models) -> DataFrame:
    """exact business days in [contract, maturity) with holidays.

    Count and start-day flag both come from the calendar table (two broadcast
    hash lookups per row). The holiday years span the contracts' dates.
    """
    hol = fn.national_holidays(HOLIDAY_YEARS)
    c = m.contracts.select("contract_id", "contract_date", "maturity_date")
    return fn.with_business_days(c, "contract_date", "maturity_date", hol, start_flag="starts_on_business_day").select(
        "contract_id",
        fn.weekdays_between("contract_date", "maturity_date").alias("weekdays"),
        "business_days",
        "starts_on_business_day",
    )


@register("business_days_rule")
def _business_days_rule(m: Models) -> DataFrame:
    """F18/F19 by rule, without a list of holidays: contract terms moved over three centuries."""
    years = (F.col("term_months") * 7 + F.col("days_past_due")) % 300 - 100
    moved = m.contracts.select("contract_id", *[F.add_months(c, (years * 12).cast("int")).alias(c) for c in ("contract_date", "maturity_date")])
    return moved.select(
        "contract_id", "contract_date",
        fn.holidays_between("contract_date", "maturity_date").alias("holidays"),
        fn.business_days_exact("contract_date", "maturity_date", None).alias("business_days"),
        fn.is_business_day("contract_date", None).alias("starts_on_business_day"),
    )


@register("monthly_to_annual")
def _monthly_to_annual(m: Models) -> DataFrame:
    """compounded annual rate, 6 decimals."""
    c = m.contracts
    return c.select("contract_id", "monthly_rate_pct",
                    F.round(fn.monthly_to_annual_rate("monthly_rate_pct"), 6).alias("annual_rate_pct"))


@register("surrogate_key")
def _surrogate_key(m: Models) -> DataFrame:
    """md5 surrogate key over id, merchant and date."""
    t = m.transactions
    return t.select("transaction_id",
                    fn.surrogate_key("transaction_id", "merchant_id", "transaction_date").alias("surrogate_key"))


@register("blended_mdr")
def _blended_mdr(m: Models) -> DataFrame:
    """blended MDR from the raw merchant rates."""
    r = m.cat.merchants
    return r.select("merchant_id", "merchant_segment",
                    fn.blended_mdr_pct("mdr_credit", "mdr_debit", "mdr_pix").alias("blended_mdr_pct"))


@register("weekend_flag")
def _weekend_flag(m: Models) -> DataFrame:
    """Weekend flag (dayofweek 1 = Sunday)."""
    t = m.transactions
    return t.select("transaction_id", "transaction_date",
                    F.dayofweek("transaction_date").alias("day_of_week"), "is_weekend")


# --- data quality and reconciliation ---------------------------------------------

@register("dq_transactions")
def _dq_transactions(m: Models) -> DataFrame:
    """Every row check on raw transactions in one pass."""
    return quality.run_row_checks(m.cat.transactions, "transactions",
                                  quality.source_row_checks("transactions", as_of=m.as_of))


@register("dq_source_tables")
def _dq_source_tables(m: Models) -> DataFrame:
    """Declared key and value checks of the other four raw tables."""
    out = None
    for name in ("customers", "merchants", "credit_contracts", "daily_rates"):
        part = quality.run_row_checks(getattr(m.cat, name), name, quality.source_row_checks(name))
        out = part if out is None else out.unionByName(part)
    return out


@register("dq_unique")
def _dq_unique(m: Models) -> DataFrame:
    """Key uniqueness of the five raw tables."""
    c = m.cat
    parts = [
        quality.unique(c.transactions, "transactions", "transaction_id"),
        quality.unique(c.customers, "customers", "customer_id"),
        quality.unique(c.merchants, "merchants", "merchant_id"),
        quality.unique(c.credit_contracts, "credit_contracts", "contract_id"),
        quality.unique(c.daily_rates, "daily_rates", "rate_date"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_proportion_unique")
def _dq_proportion_unique(m: Models) -> DataFrame:
    """Share of distinct dates (>= 0.99) in the mart and in the rates."""
    return quality.proportion_of_unique(m.daily_summary, "mart_fin_daily_summary", "summary_date", 0.99).unionByName(
        quality.proportion_of_unique(m.rates, "stg_daily_rates", "rate_date", 0.99))


TPV_MAX_BRL = 1_000_000_000


@register("dq_sum_between")
def _dq_sum_between(m: Models) -> DataFrame:
    """TPV sum within [0, 1e9], for the whole mart and per day."""
    mart = m.daily_summary
    return quality.sum_between(mart, "mart_fin_daily_summary", "total_tpv_brl", 0, TPV_MAX_BRL).unionByName(
        quality.sum_between(mart, "mart_fin_daily_summary", "total_tpv_brl", 0, TPV_MAX_BRL, ["summary_date"]))


FRESHNESS_NOW = "2001-11-05 12:00:00"


@register("source_freshness")
def _source_freshness(m: Models) -> DataFrame:
    """T5: newest event time per source against an injected clock."""
    c = m.cat
    return (quality.freshness(c.transactions, "transactions", "transaction_ts", FRESHNESS_NOW)
            .unionByName(quality.freshness(c.credit_contracts, "credit_contracts", "contract_date", FRESHNESS_NOW))
            .unionByName(quality.freshness(c.daily_rates, "daily_rates", "rate_date", FRESHNESS_NOW)))


@register("reconcile_row")
def _reconcile_row(m: Models) -> DataFrame:
    """amount = mdr + net per transaction, and TPV = MDR + net per mart row."""
    t = reconcile.financial_reconciliation(
        m.transactions, "stg_transactions", F.col("amount_brl"),
        F.col("mdr_amount_brl") + F.col("net_amount_brl"), a_name="amount_brl", b_name="mdr_amount_brl + net_amount_brl")
    s = reconcile.financial_reconciliation(
        m.daily_summary, "mart_fin_daily_summary", F.col("total_tpv_brl"),
        F.col("total_mdr_revenue_brl") + F.col("total_net_amount_brl"),
        a_name="total_tpv_brl", b_name="total_mdr_revenue_brl + total_net_amount_brl")
    return t.unionByName(s)


@register("reconcile_tpv_daily")
def _reconcile_tpv_daily(m: Models) -> DataFrame:
    """Mart TPV against staging TPV, per day."""
    return reconcile.tpv_daily_reconciliation(m.daily_summary, m.transactions)


@register("reconcile_tpv_lost_days")
def _reconcile_tpv_lost_days(m: Models) -> DataFrame:
    """The same check when the mart lost every third day of the month and staging every fifth."""
    day = F.dayofmonth
    return reconcile.tpv_daily_reconciliation(
        m.daily_summary.where(day("summary_date") % 3 != 0), m.transactions.where(day("transaction_date") % 5 != 0))


@register("compare_row_counts")
def _compare_row_counts(m: Models) -> DataFrame:
    """Raw (old) vs staging (new) row counts per month."""
    month = lambda c: F.date_trunc("month", F.col(c)).cast("date")
    return reconcile.compare_row_counts(m.cat.transactions, m.transactions, "transactions", month("transaction_date")
                                        ).unionByName(
        reconcile.compare_row_counts(m.cat.credit_contracts, m.contracts, "credit_contracts", month("contract_date")))


EARLIER_AS_OF = "2000-01-01"


@register("compare_relations")
def _compare_relations(m: Models) -> DataFrame:
    """Portfolio-eligible contracts, all columns, at an earlier date vs at AS_OF."""
    def eligible(as_of: str) -> DataFrame:
        c = staging.stg_credit_contracts(m.cat.credit_contracts, as_of=as_of)
        return c.where(F.col("is_active") | F.col("is_npl"))

    return reconcile.compare_relations(eligible(EARLIER_AS_OF), eligible(m.as_of), ["contract_id"])


@register("fk_coverage")
def _fk_coverage(m: Models) -> DataFrame:
    """Orphan foreign keys behind every join of the marts and explores."""
    t, c, mer, ctr = m.transactions, m.customers, m.merchants, m.contracts
    refs = [(t, "transactions", "merchant_id", "merchants"), (t, "transactions", "customer_id", "customers"),
            (ctr, "credit_contracts", "customer_id", "customers"), (mer, "merchants", "customer_id", "customers")]
    return quality.fk_coverage_all(refs, {"merchants": (mer, "merchant_id"), "customers": (c, "customer_id")})


# --- governance -------------------------------------------------------------------

@register("rls_business_unit")
def _rls_business_unit(m: Models) -> DataFrame:
    """Finance sees merchant metrics of business units finance/executive."""
    df = governance.with_business_unit(m.merchant_metrics, "merchant_segment", model.BUSINESS_UNIT_BY_SEGMENT)
    return governance.apply_row_policies(df, "fin_merchant_metrics", governance.Principal.of("finance"))


@register("rls_monthly_only")
def _rls_monthly_only(m: Models) -> DataFrame:
    """Sales sees only the monthly roll-up of operations."""
    return governance.apply_row_policies(m.operations, "ops_transaction_metrics", governance.Principal.of("sales"))


DEPARTMENTS = ("finance", "executive", "risk", "sales", "marketing")


@register("rls_default_deny")
def _rls_default_deny(m: Models) -> DataFrame:
    """Portfolio rows and exposure that each department sees and does not see; without a granted policy, none."""
    policies = governance.default_policies()
    rows = m.portfolio
    seen = {d: governance.row_filter("risk_credit_portfolio", governance.Principal.of(d), policies) for d in DEPARTMENTS}
    sums = rows.agg(*[a for d, see in seen.items() for a in (
        F.count_if(see).alias(f"{d}_rows"), F.count_if(~see).alias(f"{d}_hidden"),
        F.coalesce(F.sum(F.when(see, F.col("total_outstanding_brl"))), F.lit(0)).alias(f"{d}_brl"))])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(d).alias("department"), F.col(f"{d}_rows").alias("visible_rows"), F.col(f"{d}_hidden").alias("hidden_rows"),
        F.col(f"{d}_brl").alias("visible_outstanding_brl")) for d in DEPARTMENTS])))


# --- semantic layer and dashboard ----------------------------------------------

DASHBOARD_RANGE = ("2000-01-01", "2001-01-01")
FINANCE = governance.Principal.of("finance")
EXECUTIVE = governance.Principal.of("executive")


@register("explore_financial_with_rates")
def _explore_financial_with_rates(m: Models) -> DataFrame:
    """Monthly KPIs by business-day flag of the joined rates."""
    return model.EXPLORES["daily_financial_summary"].query(
        m, ["daily_financial_summary.summary_month", "daily_rates.is_business_day",
            "daily_financial_summary.total_tpv_brl", "daily_financial_summary.total_transactions",
            "daily_financial_summary.approval_rate_pct", "daily_financial_summary.approval_rate_weighted_pct"],
        principal=FINANCE, filters={"daily_financial_summary.summary_date": DASHBOARD_RANGE}, as_of=m.as_of)


@register("explore_operations_merchant_customer")
def _explore_operations(m: Models) -> DataFrame:
    """Operations by customer segment, merchant segment, acquirer."""
    return model.EXPLORES["transaction_operations"].query(
        m, ["customers.customer_segment", "merchants.merchant_segment", "transaction_operations.acquirer",
            "transaction_operations.total_transactions", "transaction_operations.tpv_brl",
            "transaction_operations.approval_rate_pct", "transaction_operations.approval_rate_weighted_pct"],
        principal=governance.Principal.of("sales"),
        filters={"transaction_operations.transaction_date": DASHBOARD_RANGE}, as_of=m.as_of)


@register("explore_merchant_performance")
def _explore_merchant_performance(m: Models) -> DataFrame:
    """Merchant performance by segment and customer state."""
    return model.EXPLORES["merchant_performance"].query(
        m, ["merchants.merchant_segment", "customers.state", "merchant_performance.total_tpv_brl",
            "merchant_performance.total_mdr_revenue_brl", "merchant_performance.effective_mdr_pct",
            "merchant_performance.effective_mdr_weighted_pct", "merchant_performance.merchant_count"],
        principal=FINANCE)


@register("explore_portfolio")
def _explore_portfolio(m: Models) -> DataFrame:
    """Q3/J3 (re-aimed): contract-grain exposure by customer state and product."""
    return model.EXPLORES["credit_contracts"].query(
        m, ["customers.state", "credit_contracts.product_type", "credit_contracts.contract_count",
            "credit_contracts.exposure_brl", "credit_contracts.npl_balance_brl"],
        principal=governance.Principal.of("risk"))


@register("tile_tpv")
def _tile_tpv(m: Models) -> DataFrame:
    """Q9."""
    return dashboard.tile_tpv(m, EXECUTIVE, DASHBOARD_RANGE)


@register("tile_mdr_revenue")
def _tile_mdr_revenue(m: Models) -> DataFrame:
    """Q10."""
    return dashboard.tile_mdr_revenue(m, EXECUTIVE, DASHBOARD_RANGE)


@register("tile_approval_rate_band")
def _tile_approval_rate_band(m: Models) -> DataFrame:
    """Q11: average approval rate and its colour band."""
    return dashboard.tile_approval_rate(m, EXECUTIVE, DASHBOARD_RANGE)


@register("tile_npl_rate")
def _tile_npl_rate(m: Models) -> DataFrame:
    """Q12."""
    return dashboard.tile_npl_rate(m, EXECUTIVE)


@register("tile_exposure")
def _tile_exposure(m: Models) -> DataFrame:
    """Q13."""
    return dashboard.tile_exposure(m, EXECUTIVE)


@register("tile_chargeback_rate")
def _tile_chargeback_rate(m: Models) -> DataFrame:
    """Q14."""
    return dashboard.tile_chargeback_rate(m, EXECUTIVE, DASHBOARD_RANGE)


@register("tile_tpv_weekly_pivot")
def _tile_tpv_weekly_pivot(m: Models) -> DataFrame:
    """Q15: weekly TPV pivoted by method label."""
    return dashboard.tile_tpv_weekly(m, EXECUTIVE, DASHBOARD_RANGE)


@register("tile_by_risk_class")
def _tile_by_risk_class(m: Models) -> DataFrame:
    """Q16: exposure and NPL per class, in AA..H order."""
    return dashboard.tile_by_risk_class(m, EXECUTIVE)


@register("tile_npl_by_segment")
def _tile_npl_by_segment(m: Models) -> DataFrame:
    """Q17."""
    return dashboard.tile_npl_by_segment(m, EXECUTIVE)


@register("drill_tpv")
def _drill_tpv(m: Models) -> DataFrame:
    """Q18: TPV drilled to date x method for PIX in the dashboard range."""
    return dashboard.drill(m, "daily_financial_summary", "total_tpv_brl", FINANCE,
                           {"daily_financial_summary.summary_date": DASHBOARD_RANGE,
                            "daily_financial_summary.payment_method": ["pix"]})


@register("explore_default_window")
def _explore_default_window(m: Models) -> DataFrame:
    """Q6: no filter given, so the explore's own 90 days apply."""
    return model.EXPLORES["daily_financial_summary"].query(
        m, ["daily_financial_summary.payment_method", "daily_financial_summary.total_tpv_brl",
            "daily_financial_summary.total_transactions"], principal=FINANCE, as_of=WINDOW_AS_OF)


WINDOW_AS_OF = "2000-06-30"


@register("presentation_values")
def _presentation_values(m: Models) -> DataFrame:
    """merchant measures rounded for display and as text."""
    return m.merchant_metrics.select(
        "merchant_id", fn.format_brl("total_tpv_brl", 0).alias("tpv_rounded"),
        fn.format_value("total_tpv_brl", "brazilian_real").alias("tpv_text"),
        fn.format_value("total_transactions", "decimal_0").alias("transactions_text"),
        fn.format_value("approval_rate_pct", "percentage_2dp").alias("approval_text"))


@register("npl_rules")
def _npl_rules(m: Models) -> DataFrame:
    """NPL and write-off by the day thresholds, against the stored flags."""
    npl, lost = fn.is_npl("days_past_due"), fn.is_written_off_by_rule("days_past_due")
    return m.contracts.select("contract_id", npl.alias("npl_by_rule"), lost.alias("written_off_by_rule"),
                              (npl == F.col("is_npl")).alias("npl_matches"), (lost == F.col("is_written_off")).alias("written_off_matches"))


@register("granted_fields")
def _granted_fields(m: Models) -> DataFrame:
    """Contracts and exposure by product as each department may read them; a column without a grant is gone."""
    # The contracts are summed once; what each department may see is decided on the sums' columns.
    sums = m.contracts.groupBy("product_type").agg(F.count("*").alias("contracts"), F.sum("outstanding_balance_brl").cast("decimal(28,2)").alias("exposure_brl"))
    may = {d: governance.visible_columns(sums.columns, {"exposure_brl": model.RISK}, governance.Principal.of(d)) for d in DEPARTMENTS}
    shown = [F.struct(F.lit(d).alias("department"), *[(F.col(c) if c in may[d] else F.lit(None).cast(sums.schema[c].dataType)).alias(c) for c in sums.columns])
             for d in DEPARTMENTS]
    return sums.select(F.inline(F.array(*shown)))


@register("explore_refusals")
def _explore_refusals(m: Models) -> DataFrame:
    """Every department asks two explores for their counts; the portfolio's refuses whoever lacks its grant."""
    asks = {"credit_contracts": "credit_contracts.contract_count", "merchant_performance": "merchant_performance.merchant_count"}
    out = None
    for d in DEPARTMENTS:
        for explore, measure in asks.items():
            try:
                answer = model.EXPLORES[explore].query(m, [measure], principal=governance.Principal.of(d)).toDF("answer")
                part = answer.select(F.lit(d).alias("department"), F.lit(explore).alias("explore"), F.lit(False).alias("refused"), F.col("answer").cast("double").alias("answer"))
            except governance.AccessDenied:
                part = m.spark.range(1).select(F.lit(d).alias("department"), F.lit(explore).alias("explore"), F.lit(True).alias("refused"), F.lit(None).cast("double").alias("answer"))
            out = part if out is None else out.unionByName(part)
    return out


@register("refined_view")
def _refined_view(m: Models) -> DataFrame:
    """Q20: a view refined by a new dimension, a new measure and a replaced one, asked beside the plain one."""
    plain = model.DAILY_FINANCIAL_SUMMARY
    card = lambda: F.col("payment_method").isin("credit_card", "debit_card")
    refined = plain.extend(
        dimensions=[semantic.Dimension("channel", lambda: F.when(card(), "card").otherwise("transfer"))],
        measures=[semantic.Measure("card_tpv_brl", "sum", lambda: F.when(card(), F.col("total_tpv_brl")).otherwise(F.lit(0).cast("decimal(18,2)"))),
                  semantic.Measure("total_transactions", "sum", "approved_transactions")])
    fields = ["summary_year", "channel", "total_tpv_brl", "card_tpv_brl", "total_transactions"]
    of_refined = semantic.Explore("refined", refined).query(m, fields, principal=FINANCE)
    of_plain = semantic.Explore("plain", plain).query(m, ["summary_year", "total_tpv_brl", "total_transactions"], principal=FINANCE)
    return of_refined.withColumn("view", F.lit("refined")).unionByName(of_plain.withColumn("view", F.lit("plain")), allowMissingColumns=True)


@register("masked_by_tag")
def _masked_by_tag(m: Models) -> DataFrame:
    """Columns tagged restricted are masked, others pass."""
    c = m.cat.customers.select("customer_id", "cnpj", "company_name", "state")
    tagged = governance.tag_columns(c, {"cnpj": {"sensitivity": "restricted", "mask": "cnpj"}, "company_name": {"sensitivity": "restricted"},
                                        "state": {"sensitivity": "internal"}})
    return governance.mask_restricted(tagged)


# --- sources, sinks, layout and streaming -----------------------------------------

def _scratch(m: Models, name: str) -> str:
    return scratch_path(m.spark, name)


@register("csv_roundtrip")
def _csv_roundtrip(m: Models) -> DataFrame:
    """S5 + S1: raw transactions written as CSV, read back with the typed schema."""
    path = _scratch(m, "csv")
    sinks.write_csv(m.cat.transactions.select(*[f.name for f in TRANSACTIONS.fields]), path)
    return files.read_typed_csv(m.spark, path, "transactions")


@register("partitioned_sink_roundtrip")
def _partitioned_sink_roundtrip(m: Models) -> DataFrame:
    """Staging written day-partitioned and clustered, read back."""
    path = _scratch(m, "partitioned")
    stg = m.transactions
    res = sinks.write_table(stg, path, partition_by="transaction_date",
                            cluster_by=("merchant_id", "payment_method", "status"))
    back = m.spark.read.schema(stg.schema).parquet(res.path)
    return back.select(*stg.columns)


@register("audit_append")
def _audit_append(m: Models) -> DataFrame:
    """One audit row per raw table load, appended and read back."""
    path = _scratch(m, "audit")
    c = m.cat
    rows = None
    for name in ("transactions", "customers", "merchants", "credit_contracts", "daily_rates"):
        res = sinks.write_table(getattr(c, name), _scratch(m, f"raw-{name}"))
        row = audit.audit_row(m.spark, run_id="fixture-run", pipeline_name="ingestion_load", step=f"load_{name}",
                              status="success", rows_processed=res.rows, started_at=dt.datetime(2001, 8, 1),
                              finished_at=dt.datetime(2001, 8, 1, 0, 5))
        rows = row if rows is None else rows.unionByName(row)
    audit.append_audit(rows, path)
    return audit.read_audit(m.spark, path).select(
        "run_id", "pipeline_name", "step", "status", "rows_processed", "rows_failed", "started_date")


@register("quarantine_split")
def _quarantine_split(m: Models) -> DataFrame:
    """PERMISSIVE read of a transactions CSV split into good / quarantined, by reason.

    Every transaction whose order number ends in 7, 8 or 9 is written with a broken
    amount, a broken date or no id.
    """
    path = _scratch(m, "quarantine-src")
    raw = m.cat.transactions.select(*[F.col(f.name).cast("string") for f in TRANSACTIONS.fields])
    last = F.substring(F.split("transaction_id", "-")[1], -1, 1)
    planted = raw.withColumns({
        "amount_brl": F.when(last == "7", F.lit("12,50 reais")).otherwise(F.col("amount_brl")),
        "transaction_date": F.when(last == "8", F.lit("yesterday")).otherwise(F.col("transaction_date")),
        "transaction_id": F.when(last == "9", F.lit(None)).otherwise(F.col("transaction_id"))})
    sinks.write_csv(planted, path)
    good, bad = files.read_with_quarantine(m.spark, path, "transactions")
    return (good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("side"), F.lit("").alias("reason"), "rows")
            .unionByName(bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("quarantine").alias("side"), "reason", "rows")))


INCREMENTAL_START = "2001-01-01"


@register("incremental_window")
def _incremental_window(m: Models) -> DataFrame:
    """The daily summary recomputed for the processing window only."""
    return marts.mart_fin_daily_summary(sinks.incremental_window(m.transactions, "transaction_date", INCREMENTAL_START))


@register("retention_cut")
def _retention_cut(m: Models) -> DataFrame:
    """Day partitions of the transactions and whether the marts' retention expires them."""
    return sinks.retention_report(m.transactions, "transaction_date", m.as_of, **sinks.RETENTION["marts"])


@register("retention_layers")
def _retention_layers(m: Models) -> DataFrame:
    """Days and rows of the transactions that each layer's retention keeps and expires."""
    out = None
    for layer, keep in sinks.RETENTION.items():
        report = sinks.retention_report(m.transactions, "transaction_date", m.as_of, **keep)
        part = report.groupBy("action").agg(F.count("*").alias("days"), F.sum("rows").alias("rows")).select(F.lit(layer).alias("layer"), "action", "days", "rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("ingest_roundtrip")
def _ingest_roundtrip(m: Models) -> DataFrame:
    """The ingest job over CSVs of all raw tables, read back through the catalog."""
    csv, names = _scratch(m, "ingest-csv"), list(RAW_TABLES)
    frames = {name: getattr(m.cat, name).select(*[f.name for f in RAW_TABLES[name].schema.fields]) for name in names}

    def write(name: str) -> bool:
        return sinks.write_csv(frames[name], f"{csv}/{name}", compression="gzip")

    with shuffles_freed(m.spark), ThreadPoolExecutor(max_workers=4) as pool:
        write("transactions")  # chargebacks are made of the same join, whose shuffle need not lie on disk twice
        list(pool.map(write, [name for name in names if name != "transactions"]))
    lake = Catalog(m.spark, root=_scratch(m, "lake"))
    path = _scratch(m, "ingest-audit")
    jobs.ingest(m.spark, lake, csv, audit_path=path, run_id="fixture-run", load_ts=dt.datetime(2001, 8, 1))
    logged = audit.read_audit(m.spark, path).select(F.regexp_replace("step", "^load_", "").alias("table_name"), "status", "rows_processed")
    out = None
    for name in names:
        loaded = m.spark.read.parquet(lake.location("raw", name))
        part = loaded.agg(F.count("*").alias("rows"), F.count(RAW_TABLES[name].key).alias("keys"),
                          F.count_if(F.col("_loaded_at") == F.lit(dt.datetime(2001, 8, 1))).alias("stamped")).select(F.lit(name).alias("table_name"), "rows", "keys", "stamped")
        out = part if out is None else out.unionByName(part)
    return out.join(logged, "table_name")


@register("incremental_write")
def _incremental_write(m: Models) -> DataFrame:
    """The mart stored, then its window recomputed from transactions that lost every fifth day, as one commit."""
    table = VersionedTable(m.spark, _scratch(m, "incremental"))
    table.overwrite(sinks.spread(m.daily_summary, "summary_date"), partition_by="summary_date", arrange=False)
    table.replace_window(sinks.spread(_fewer_days(m), "summary_date"), "summary_date", INCREMENTAL_START, arrange=False)
    return table.read()


def _fewer_days(m: Models) -> DataFrame:
    return marts.mart_fin_daily_summary(m.transactions.where(F.dayofmonth("transaction_date") % 5 != 0))


def _with_month(mart: DataFrame) -> DataFrame:
    """A daily mart of few rows a day is kept by month."""
    return mart.withColumn("summary_month", F.date_trunc("month", "summary_date").cast("date"))


def _content(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.sum("total_transactions").alias("transactions"),
                  F.sum("total_tpv_brl").cast("decimal(28,2)").alias("tpv_brl")).select(F.lit(label).alias("step"), "rows", "transactions", "tpv_brl")


GATE_COLUMNS = ("transaction_date", "payment_method", "status", "amount_brl", "mdr_rate_pct", "mdr_amount_brl", "net_amount_brl", "is_approved", "is_chargeback", "is_installment")


@register("mart_gate")
def _mart_gate(m: Models) -> DataFrame:
    """Three attempts to publish the daily mart and what the table holds after each.

    The whole mart passes its check against staging; the mart that lost every fifth day of the month is blocked,
    and so is its window; the window of the whole mart passes again.
    """
    table = VersionedTable(m.spark, _scratch(m, "gated-mart"))
    # All attempts and their checks read the transactions: they are joined and staged once.
    held, path = Models(m.spark, as_of=m.as_of, cat=m.cat), _scratch(m, "gated-transactions")
    stg = m.transactions.select(*GATE_COLUMNS)
    stg.write.parquet(path)
    held.transactions = stg = m.spark.read.schema(stg.schema).parquet(path)

    def checks(staged: DataFrame, since: str | None = None) -> DataFrame:
        return reconcile.tpv_daily_reconciliation(staged, stg if since is None else sinks.incremental_window(stg, "transaction_date", since))

    def attempt(step: str, publish: Callable[[], object]) -> DataFrame:
        try:
            publish()
            verdict = "published"
        except reconcile.CheckFailed:
            verdict = "blocked"
        return _content(table.read(), step).withColumns({"verdict": F.lit(verdict), "versions": F.lit(len(table.versions())).cast("bigint")})

    whole, fewer, name = _with_month(held.daily_summary), _with_month(_fewer_days(held)), "mart_fin_daily_summary"
    window = lambda s: checks(s, INCREMENTAL_START)
    steps = [
        attempt("whole", lambda: jobs.publish_mart(table, whole, name=name, checks=checks, partition_by="summary_month")),
        attempt("lost_days", lambda: jobs.publish_mart(table, fewer, name=name, checks=checks, partition_by="summary_month")),
        attempt("lost_window", lambda: jobs.refresh_window(table, fewer, "summary_month", INCREMENTAL_START, name=name, checks=window)),
        attempt("whole_window", lambda: jobs.refresh_window(table, whole, "summary_month", INCREMENTAL_START, name=name, checks=window)),
    ]
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


@register("table_versions")
def _table_versions(m: Models) -> DataFrame:
    """Every version of a table that was loaded, refreshed for a window, expired and rolled back, as read today."""
    table = VersionedTable(m.spark, _scratch(m, "versions"))
    table.overwrite(_with_month(m.daily_summary), partition_by="summary_month")
    table.replace_window(_with_month(_fewer_days(m)), "summary_month", INCREMENTAL_START)
    table.expire_before(OPERATIONS_SINCE)
    table.rollback(1)
    table.vacuum()
    out = None
    for v, label in enumerate(("1 overwrite", "2 window", "3 expired", "4 rollback"), start=1):
        part = _content(table.read(v), label)
        out = part if out is None else out.unionByName(part)
    return out


@register("streaming_daily_summary")
def _streaming_daily_summary(m: Models) -> DataFrame:
    """Structured Streaming refresh of the daily summary: additive state of the days, read back as the mart."""
    landing, state, ckpt = (_scratch(m, n) for n in ("landing", "stream-state", "stream-ckpt"))
    incremental.land(m.cat.transactions.select(*[f.name for f in TRANSACTIONS.fields]), landing)
    q = incremental.start_additive_refresh(m.spark, landing, state, ckpt, max_files_per_trigger=25)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return incremental.read_summary(VersionedTable(m.spark, state))


# --- further inventory items ------------------------------------------------------

@register("stg_chargebacks")
def _stg_chargebacks(m: Models) -> DataFrame:
    """The chargebacks source (our schema) with days to open."""
    cb = staging.stg_chargebacks(m.cat.chargebacks)
    tx = m.transactions.select("transaction_id", "transaction_date")
    return cb.join(tx, "transaction_id", "left").select(
        *cb.columns, F.datediff("opened_at", "transaction_date").alias("days_to_open"))


@register("mdr_recompute")
def _mdr_recompute(m: Models) -> DataFrame:
    """MDR amount recomputed from the rate, net amount from the MDR."""
    t = m.transactions
    mdr = fn.mdr_amount("amount_brl", "mdr_rate_pct")
    return t.select(
        "transaction_id", mdr.alias("mdr_recomputed_brl"),
        fn.net_amount("amount_brl", mdr).alias("net_recomputed_brl"),
        (mdr == F.col("mdr_amount_brl")).alias("mdr_matches"),
    )


@register("explore_net_revenue")
def _explore_net_revenue(m: Models) -> DataFrame:
    """Q21: net revenue measure (finance grant) by quarter and method."""
    return model.EXPLORES["fin_revenue"].query(
        m, ["fin_revenue.revenue_quarter", "fin_revenue.payment_method", "fin_revenue.net_revenue",
            "fin_revenue.mdr_revenue"], principal=FINANCE)
