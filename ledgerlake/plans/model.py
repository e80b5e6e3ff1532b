"""The financial semantic model: views over the marts and explores.

Contexts passed to ``Explore.query`` provide the base DataFrames as
attributes (``daily_summary``, ``portfolio``, ``contracts``, ``rates``,
``customers``, ``merchants``, ``operations``, ``merchant_metrics``,
``revenue``), e.g. ``ledgerlake.registry.Models``.

Re-aimed parts (the reference's own definitions are broken, SURVEY §8):
the customer join of the portfolio lives on a contract-grain explore (the
mart has no customer_id); the undefined views (rates, customers, merchants,
operations, merchant performance) are built over staging and marts M3-M9.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payment_method_label, risk_level_order
from ..operators.governance import aggregate_only, with_business_unit
from .semantic import Dimension, Explore, Join, Measure, View

RISK = ("risk_team_only",)

# Our mapping of merchant segment to the business unit named by the finance
# row policy (no model in the reference carries business_unit).
BUSINESS_UNIT_BY_SEGMENT = {
    "food_delivery": "finance",
    "retail": "finance",
    "saas": "executive",
    "education": "executive",
    "healthcare": "operations",
    "logistics": "operations",
}

DAILY_FINANCIAL_SUMMARY = View(
    "daily_financial_summary",
    lambda ctx: ctx.daily_summary,
    dimensions=(
        Dimension("payment_method", "payment_method", "Método de Pagamento"),
        Dimension("payment_method_label", lambda: payment_method_label("payment_method"), "Método (PT)"),
    ),
    measures=(
        Measure("total_transactions", "sum", "total_transactions", value_format="decimal_0",
                drill_fields=("summary_date", "payment_method", "total_transactions")),
        Measure("approved_transactions", "sum", "approved_transactions", value_format="decimal_0"),
        Measure("total_tpv_brl", "sum", "total_tpv_brl", value_format="brazilian_real",
                drill_fields=("summary_date", "payment_method", "total_tpv_brl"), tags=("kpi", "primary")),
        Measure("total_mdr_revenue_brl", "sum", "total_mdr_revenue_brl", value_format="brazilian_real",
                tags=("kpi", "revenue")),
        Measure("avg_mdr_rate_pct", "average", "avg_mdr_rate_pct", value_format="percentage_2dp", tags=("kpi",)),
        Measure("approval_rate_pct", "average", "approval_rate_pct", value_format="percentage_2dp",
                tags=("kpi", "operations")),
        Measure("chargeback_rate_pct", "average", "chargeback_rate_pct", value_format="percentage_2dp",
                tags=("kpi", "risk")),
        Measure("avg_ticket_brl", "average", "avg_ticket_brl", value_format="brazilian_real"),
        # Weighted variants: summed numerators over summed denominators.
        Measure("approval_rate_weighted_pct", "ratio", "approved_transactions",
                denominator="total_transactions", times=100),
        Measure("chargeback_rate_weighted_pct", "ratio", "chargeback_transactions",
                denominator="approved_transactions", times=100),
        Measure("avg_ticket_weighted_brl", "ratio", "total_tpv_brl", denominator="approved_transactions", scale=2),
    ),
    time_groups={"summary": "summary_date"},
    label="Resumo Financeiro",
)

DAILY_RATES = View(
    "daily_rates",
    lambda ctx: ctx.rates,
    dimensions=tuple(Dimension(c, c) for c in (
        "rate_date", "cdi_annual_pct", "selic_annual_pct", "usd_brl", "eur_brl", "is_business_day")),
    measures=(Measure("avg_cdi_annual_pct", "average", "cdi_annual_pct"),),
)

CUSTOMERS = View(
    "customers",
    lambda ctx: ctx.customers,
    dimensions=tuple(Dimension(c, c) for c in (
        "customer_id", "customer_segment", "credit_rating", "city", "state", "is_active")),
    measures=(Measure("customer_count", "count_distinct", "customer_id"),),
)

MERCHANTS = View(
    "merchants",
    lambda ctx: ctx.merchants,
    dimensions=tuple(Dimension(c, c) for c in (
        "merchant_id", "merchant_name", "merchant_segment", "customer_id", "blended_mdr_pct", "is_active")),
    measures=(Measure("merchant_count", "count_distinct", "merchant_id"),),
)

CREDIT_PORTFOLIO = View(
    "credit_portfolio",
    lambda ctx: ctx.portfolio,
    dimensions=(
        Dimension("product_type", "product_type", "Produto de Crédito"),
        Dimension("risk_classification_bacen", "risk_classification_bacen", "Classificação BACEN",
                  order_by="risk_level_order"),
        Dimension("risk_level_order", lambda: risk_level_order("risk_classification_bacen"), hidden=True),
        Dimension("dpd_bucket", "dpd_bucket", "Bucket de Atraso"),
        Dimension("customer_segment", "customer_segment", "Segmento do Cliente"),
        Dimension("collateral_type", "collateral_type", "Tipo de Colateral"),
        Dimension("snapshot_date", "snapshot_date", "Data do Snapshot"),
    ),
    measures=(
        Measure("total_outstanding_brl", "sum", "total_outstanding_brl", grants=RISK,
                value_format="brazilian_real", tags=("kpi", "exposure")),
        Measure("npl_balance_brl", "sum", "npl_balance_brl", grants=RISK, value_format="brazilian_real",
                tags=("kpi", "npl")),
        Measure("npl_rate_pct", "average", "npl_rate_pct", grants=RISK, value_format="percentage_2dp",
                tags=("kpi", "npl", "primary")),
        Measure("total_expected_loss_brl", "sum", "total_expected_loss_brl", grants=RISK,
                value_format="brazilian_real"),
        Measure("portfolio_coverage_ratio", "average", "portfolio_coverage_ratio", grants=RISK,
                value_format="ratio_2dp"),
        Measure("total_contracts", "sum", "total_contracts", value_format="decimal_0"),
        Measure("npl_rate_weighted_pct", "ratio", "npl_balance_brl", denominator="total_outstanding_brl",
                times=100, grants=RISK),
    ),
    policy_table="risk_credit_portfolio",
    label="Portfolio de Crédito",
)

CREDIT_CONTRACTS = View(
    "credit_contracts",
    lambda ctx: ctx.contracts,
    dimensions=(
        *(Dimension(c, c) for c in ("contract_id", "customer_id", "product_type", "risk_classification_bacen",
                                     "collateral_type", "is_active", "is_npl", "is_written_off")),
        Dimension("individual_exposure_brl", "outstanding_balance_brl", grants=RISK),
    ),
    measures=(
        Measure("contract_count", "count"),
        Measure("exposure_brl", "sum", "outstanding_balance_brl", grants=RISK),
        Measure("npl_balance_brl", "sum", lambda: F.when(F.col("is_npl"), F.col("outstanding_balance_brl"))
                .otherwise(F.lit(0).cast("decimal(18,2)")), grants=RISK),
    ),
    time_groups={"contract": "contract_date"},
    policy_table="risk_credit_portfolio",
)

TRANSACTION_OPERATIONS = View(
    "transaction_operations",
    # One grain: days and months of one table must never be added together.
    lambda ctx: aggregate_only(ctx.operations),
    dimensions=tuple(Dimension(c, c) for c in ("granularity", "merchant_id", "acquirer")),
    measures=(
        Measure("total_transactions", "sum", "total_transactions"),
        Measure("approved_transactions", "sum", "approved_transactions"),
        Measure("chargeback_transactions", "sum", "chargeback_transactions"),
        Measure("tpv_brl", "sum", "tpv_brl"),
        Measure("mdr_revenue_brl", "sum", "mdr_revenue_brl"),
        Measure("approval_rate_pct", "average", "approval_rate_pct"),
        Measure("approval_rate_weighted_pct", "ratio", "approved_transactions",
                denominator="total_transactions", times=100),
    ),
    time_groups={"transaction": "period_start"},
    policy_table="ops_transaction_metrics",
)

MERCHANT_PERFORMANCE = View(
    "merchant_performance",
    lambda ctx: with_business_unit(ctx.merchant_metrics, "merchant_segment", BUSINESS_UNIT_BY_SEGMENT),
    dimensions=tuple(Dimension(c, c) for c in ("merchant_id", "merchant_segment", "business_unit")),
    measures=(
        Measure("total_tpv_brl", "sum", "total_tpv_brl", value_format="brazilian_real"),
        Measure("total_mdr_revenue_brl", "sum", "total_mdr_revenue_brl", value_format="brazilian_real"),
        Measure("effective_mdr_pct", "average", "effective_mdr_pct", value_format="percentage_2dp"),
        Measure("effective_mdr_weighted_pct", "ratio", "total_mdr_revenue_brl", denominator="total_tpv_brl",
                times=100),
        Measure("merchant_count", "count"),
    ),
    policy_table="fin_merchant_metrics",
)

FIN_REVENUE = View(
    "fin_revenue",
    lambda ctx: ctx.revenue,
    dimensions=(Dimension("payment_method", "payment_method"),),
    measures=(
        Measure("net_revenue", "sum", "net_revenue_brl", value_format="brazilian_real", grants=("finance_team",)),
        Measure("mdr_revenue", "sum", "mdr_revenue_brl", value_format="brazilian_real"),
    ),
    time_groups={"revenue": "month"},
)

EXPLORES = {
    "daily_financial_summary": Explore(
        "daily_financial_summary", DAILY_FINANCIAL_SUMMARY,
        joins=(Join(DAILY_RATES, "daily_financial_summary.summary_date", "rate_date"),),
        always_filter={"daily_financial_summary.summary_date": "90 days"},
        label="Resumo Financeiro Diário",
    ),
    "credit_portfolio": Explore("credit_portfolio", CREDIT_PORTFOLIO, required_grants=RISK,
                                label="Portfolio de Crédito"),
    "credit_contracts": Explore(
        "credit_contracts", CREDIT_CONTRACTS, required_grants=RISK,
        joins=(Join(CUSTOMERS, "credit_contracts.customer_id", "customer_id",
                    fields=("customer_segment", "customer_id", "state")),),
    ),
    "transaction_operations": Explore(
        "transaction_operations", TRANSACTION_OPERATIONS,
        joins=(
            Join(MERCHANTS, "transaction_operations.merchant_id", "merchant_id"),
            Join(CUSTOMERS, "merchants.customer_id", "customer_id",
                 fields=("customer_segment", "state", "customer_id")),
        ),
        always_filter={"transaction_operations.transaction_date": "30 days"},
    ),
    "merchant_performance": Explore(
        "merchant_performance", MERCHANT_PERFORMANCE,
        joins=(
            Join(MERCHANTS, "merchant_performance.merchant_id", "merchant_id"),
            Join(CUSTOMERS, "merchants.customer_id", "customer_id", fields=("customer_segment", "state")),
        ),
    ),
    "fin_revenue": Explore("fin_revenue", FIN_REVENUE),
}
