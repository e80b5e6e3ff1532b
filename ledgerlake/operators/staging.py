"""Staging models: typed, trimmed, filtered views over the raw tables.

Each model is a function ``raw DataFrame -> lazy DataFrame``; nothing is
materialised, so Catalyst sees one plan from the scan to whatever mart
consumes it (filters and column pruning reach the parquet scan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blended_mdr_pct,
    clean,
    clean_lower,
    clean_upper,
    collateral_coverage_ratio,
    is_weekend,
    mask_pii,
    risk_level_num,
)
from ..schemas import MONEY, RATE


def _stamp(run_ts: dt.datetime | None) -> list[Column]:
    """Injected run timestamp (never the wall clock inside a query)."""
    return [] if run_ts is None else [F.lit(run_ts).cast("timestamp").alias("_updated_at")]


def _as_of(as_of: dt.date | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def stg_transactions(raw: DataFrame, *, normalize_flags: bool = False,
                     run_ts: dt.datetime | None = None) -> DataFrame:
    """M1. Flags read the *raw* status/installments by default (as the reference).

    ``normalize_flags=True`` derives them from the cleaned values instead, so
    ' APPROVED ' counts as approved.
    """
    status = clean_lower("status") if normalize_flags else F.col("status")
    installments = F.col("installments").cast("bigint")
    kept = raw.where(
        F.col("transaction_id").isNotNull()
        & (F.col("amount_brl") > 0)
        & F.col("transaction_date").isNotNull()
    )
    return kept.select(
        clean("transaction_id").alias("transaction_id"),
        clean("merchant_id").alias("merchant_id"),
        clean("customer_id").alias("customer_id"),
        clean("authorization_code").alias("authorization_code"),
        clean_lower("acquirer").alias("acquirer"),
        F.col("amount_brl").cast(MONEY).alias("amount_brl"),
        F.col("mdr_rate_pct").cast(RATE).alias("mdr_rate_pct"),
        F.col("mdr_amount_brl").cast(MONEY).alias("mdr_amount_brl"),
        F.col("net_amount_brl").cast(MONEY).alias("net_amount_brl"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("transaction_ts").cast("timestamp").alias("transaction_ts"),
        clean_lower("payment_method").alias("payment_method"),
        clean_lower("status").alias("status"),
        installments.alias("installments"),
        (status == F.lit("approved")).alias("is_approved"),
        (status == F.lit("chargeback")).alias("is_chargeback"),
        (installments > 1).alias("is_installment"),
        is_weekend(F.col("transaction_date").cast("date")).alias("is_weekend"),
        *_stamp(run_ts),
    )


def stg_credit_contracts(raw: DataFrame, *, as_of: dt.date | str | Column,
                         run_ts: dt.datetime | None = None) -> DataFrame:
    """M2. ``is_active`` = not written off and maturity on or after ``as_of``."""
    risk_class = clean_upper("risk_classification_bacen")
    kept = raw.where(F.col("contract_id").isNotNull() & (F.col("principal_brl") > 0))
    return kept.select(
        clean("contract_id").alias("contract_id"),
        clean("customer_id").alias("customer_id"),
        clean_lower("product_type").alias("product_type"),
        clean_lower("collateral_type").alias("collateral_type"),
        F.col("principal_brl").cast(MONEY).alias("principal_brl"),
        F.col("outstanding_balance_brl").cast(MONEY).alias("outstanding_balance_brl"),
        F.col("monthly_rate_pct").cast(RATE).alias("monthly_rate_pct"),
        F.col("collateral_value_brl").cast(MONEY).alias("collateral_value_brl"),
        F.col("term_months").cast("bigint").alias("term_months"),
        F.col("days_past_due").cast("bigint").alias("days_past_due"),
        F.col("contract_date").cast("date").alias("contract_date"),
        F.col("maturity_date").cast("date").alias("maturity_date"),
        risk_class.alias("risk_classification_bacen"),
        F.col("is_npl").cast("boolean").alias("is_npl"),
        F.col("is_written_off").cast("boolean").alias("is_written_off"),
        risk_level_num(risk_class).alias("risk_level_num"),
        collateral_coverage_ratio(
            F.col("collateral_value_brl").cast(MONEY), F.col("outstanding_balance_brl").cast(MONEY)
        ).alias("collateral_coverage_ratio"),
        (~F.col("is_written_off").cast("boolean")
         & (F.col("maturity_date").cast("date") >= _as_of(as_of))).alias("is_active"),
        *_stamp(run_ts),
    )


def stg_merchants(raw: DataFrame, *, run_ts: dt.datetime | None = None) -> DataFrame:
    """M3. Cleaned merchants with the blended MDR estimate."""
    credit, debit, pix = (F.col(c).cast(RATE) for c in ("mdr_credit", "mdr_debit", "mdr_pix"))
    return raw.where(F.col("merchant_id").isNotNull()).select(
        clean("merchant_id").alias("merchant_id"),
        clean("merchant_name").alias("merchant_name"),
        clean_lower("merchant_segment").alias("merchant_segment"),
        clean("customer_id").alias("customer_id"),
        credit.alias("mdr_credit_pct"),
        debit.alias("mdr_debit_pct"),
        pix.alias("mdr_pix_pct"),
        F.col("activated_at").cast("date").alias("activated_at"),
        F.col("is_active").cast("boolean").alias("is_active"),
        blended_mdr_pct(credit, debit, pix).alias("blended_mdr_pct"),
        *_stamp(run_ts),
    )


def stg_customers(raw: DataFrame, *, run_ts: dt.datetime | None = None) -> DataFrame:
    """M4. Customers with the tax id masked; raw PII never leaves staging."""
    return raw.where(F.col("customer_id").isNotNull()).select(
        clean("customer_id").alias("customer_id"),
        clean_lower("customer_segment").alias("customer_segment"),
        clean_upper("credit_rating").alias("credit_rating"),
        mask_pii("cnpj", "cnpj").alias("cnpj_masked"),
        clean("city").alias("city"),
        clean("state").alias("state"),
        F.col("registration_date").cast("date").alias("registration_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        clean("account_manager_id").alias("account_manager_id"),
        *_stamp(run_ts),
    )


def stg_daily_rates(raw: DataFrame) -> DataFrame:
    """M5. Typed passthrough of the daily market rates."""
    return raw.where(F.col("rate_date").isNotNull()).select(
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("cdi_annual_pct").cast(RATE).alias("cdi_annual_pct"),
        F.col("selic_annual_pct").cast(RATE).alias("selic_annual_pct"),
        F.col("usd_brl").cast(RATE).alias("usd_brl"),
        F.col("eur_brl").cast(RATE).alias("eur_brl"),
        F.col("is_business_day").cast("boolean").alias("is_business_day"),
    )


def stg_chargebacks(raw: DataFrame) -> DataFrame:
    """S20 (schema ours): cleaned chargebacks."""
    return raw.where(F.col("chargeback_id").isNotNull()).select(
        clean("chargeback_id").alias("chargeback_id"),
        clean("transaction_id").alias("transaction_id"),
        F.col("opened_at").cast("date").alias("opened_at"),
        clean_lower("reason").alias("reason"),
        F.col("amount_brl").cast(MONEY).alias("amount_brl"),
    )
