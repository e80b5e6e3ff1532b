"""Typed table specifications for the raw layer and the outputs we write.

Raw tables carry a fixed explicit schema (never inferred), the columns that
must not be NULL, a day-partition column and up to three clustering columns.
Money is DECIMAL(18,2) and rates DECIMAL(9,4); see SURVEY §1.2 for why not
the warehouse's (38,9).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 4)


def _f(name: str, dtype: T.DataType, nullable: bool = True, **meta) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata=meta or None)


TRANSACTIONS = T.StructType([
    _f("transaction_id", T.StringType(), False),
    _f("merchant_id", T.StringType()),
    _f("customer_id", T.StringType(), sensitivity="internal"),
    _f("amount_brl", MONEY),
    _f("mdr_rate_pct", RATE),
    _f("mdr_amount_brl", MONEY),
    _f("net_amount_brl", MONEY),
    _f("payment_method", T.StringType()),
    _f("status", T.StringType()),
    _f("transaction_date", T.DateType()),
    _f("transaction_ts", T.TimestampType()),
    _f("installments", T.LongType()),
    _f("authorization_code", T.StringType()),
    _f("acquirer", T.StringType()),
])

CUSTOMERS = T.StructType([
    _f("customer_id", T.StringType(), False),
    _f("company_name", T.StringType(), sensitivity="restricted"),
    _f("cnpj", T.StringType(), sensitivity="restricted", mask="cnpj"),
    _f("customer_segment", T.StringType()),
    _f("credit_rating", T.StringType()),
    _f("monthly_revenue_brl", MONEY, sensitivity="confidential"),
    _f("registration_date", T.DateType()),
    _f("city", T.StringType()),
    _f("state", T.StringType()),
    _f("is_active", T.BooleanType()),
    _f("account_manager_id", T.StringType()),
])

MERCHANTS = T.StructType([
    _f("merchant_id", T.StringType(), False),
    _f("merchant_name", T.StringType()),
    _f("merchant_segment", T.StringType()),
    _f("mdr_credit", RATE),
    _f("mdr_debit", RATE),
    _f("mdr_pix", RATE),
    _f("activated_at", T.DateType()),
    _f("is_active", T.BooleanType()),
    _f("customer_id", T.StringType()),
])

CREDIT_CONTRACTS = T.StructType([
    _f("contract_id", T.StringType(), False),
    _f("customer_id", T.StringType()),
    _f("product_type", T.StringType()),
    _f("principal_brl", MONEY, sensitivity="confidential"),
    _f("outstanding_balance_brl", MONEY, sensitivity="confidential"),
    _f("monthly_rate_pct", RATE),
    _f("term_months", T.LongType()),
    _f("contract_date", T.DateType()),
    _f("maturity_date", T.DateType()),
    _f("days_past_due", T.LongType()),
    _f("risk_classification_bacen", T.StringType()),
    _f("is_npl", T.BooleanType()),
    _f("is_written_off", T.BooleanType()),
    _f("collateral_type", T.StringType()),
    _f("collateral_value_brl", MONEY, sensitivity="confidential"),
])

DAILY_RATES = T.StructType([
    _f("rate_date", T.DateType(), False),
    _f("cdi_annual_pct", RATE),
    _f("selic_annual_pct", RATE),
    _f("usd_brl", RATE),
    _f("eur_brl", RATE),
    _f("is_business_day", T.BooleanType()),
])

# The reference names a chargebacks source but gives no schema; this one is ours.
CHARGEBACKS = T.StructType([
    _f("chargeback_id", T.StringType(), False),
    _f("transaction_id", T.StringType()),
    _f("opened_at", T.DateType()),
    _f("reason", T.StringType()),
    _f("amount_brl", MONEY),
])

PIPELINE_RUNS = T.StructType([
    _f("run_id", T.StringType(), False),
    _f("pipeline_name", T.StringType(), False),
    _f("step", T.StringType(), False),
    _f("status", T.StringType(), False),
    _f("rows_processed", T.LongType()),
    _f("rows_failed", T.LongType()),
    _f("started_at", T.TimestampType(), False),
    _f("finished_at", T.TimestampType()),
    _f("error_message", T.StringType()),
    _f("triggered_by", T.StringType()),
    _f("git_commit_sha", T.StringType()),
])

# Closed domains of the source columns.
STATUSES = ["approved", "denied", "cancelled", "chargeback", "pending"]
PAYMENT_METHODS = ["credit_card", "debit_card", "pix", "boleto", "ted"]
CUSTOMER_SEGMENTS = ["startup", "sme", "enterprise", "micro"]
RISK_CLASSES = ["AA", "A", "B", "C", "D", "E", "F", "G", "H"]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: str
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    accepted: dict[str, list[str]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


RAW_TABLES: dict[str, TableSpec] = {
    "transactions": TableSpec(
        "transactions", TRANSACTIONS, "transaction_id", "transaction_date",
        ("merchant_id", "payment_method", "status"),
        {"status": STATUSES, "payment_method": PAYMENT_METHODS},
    ),
    "customers": TableSpec(
        "customers", CUSTOMERS, "customer_id", None, ("customer_segment", "state"),
        {"customer_segment": CUSTOMER_SEGMENTS},
    ),
    "merchants": TableSpec("merchants", MERCHANTS, "merchant_id", None, ("merchant_segment",)),
    "credit_contracts": TableSpec(
        "credit_contracts", CREDIT_CONTRACTS, "contract_id", "contract_date",
        ("risk_classification_bacen", "product_type"),
        {"risk_classification_bacen": RISK_CLASSES},
    ),
    "daily_rates": TableSpec("daily_rates", DAILY_RATES, "rate_date"),
    "chargebacks": TableSpec("chargebacks", CHARGEBACKS, "chargeback_id", "opened_at"),
}
