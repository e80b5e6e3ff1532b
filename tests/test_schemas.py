"""Output schemas against the reference's data dictionary (column, type family)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from ledgerlake.registry import Models

SF = "/root/testdata/sf0.001"
FAMILY = {"STRING": T.StringType, "NUMERIC": T.DecimalType, "INT64": T.LongType, "BOOL": T.BooleanType,
          "DATE": T.DateType, "TIMESTAMP": T.TimestampType}

# Documented columns and types of the staging and mart outputs.
DOCUMENTED = {
    "transactions": [
        ("transaction_id", "STRING"), ("merchant_id", "STRING"), ("customer_id", "STRING"),
        ("amount_brl", "NUMERIC"), ("mdr_rate_pct", "NUMERIC"), ("mdr_amount_brl", "NUMERIC"),
        ("net_amount_brl", "NUMERIC"), ("payment_method", "STRING"), ("status", "STRING"),
        ("transaction_date", "DATE"), ("transaction_ts", "TIMESTAMP"), ("installments", "INT64"),
        ("authorization_code", "STRING"), ("acquirer", "STRING"), ("is_approved", "BOOL"),
        ("is_chargeback", "BOOL"), ("is_installment", "BOOL"), ("is_weekend", "BOOL"),
    ],
    "contracts": [
        ("contract_id", "STRING"), ("customer_id", "STRING"), ("product_type", "STRING"),
        ("principal_brl", "NUMERIC"), ("outstanding_balance_brl", "NUMERIC"), ("monthly_rate_pct", "NUMERIC"),
        ("days_past_due", "INT64"), ("risk_classification_bacen", "STRING"), ("is_npl", "BOOL"),
        ("is_written_off", "BOOL"), ("risk_level_num", "INT64"), ("collateral_coverage_ratio", "NUMERIC"),
    ],
    "daily_summary": [
        ("summary_date", "DATE"), ("payment_method", "STRING"), ("total_transactions", "INT64"),
        ("approved_transactions", "INT64"), ("total_tpv_brl", "NUMERIC"), ("total_mdr_revenue_brl", "NUMERIC"),
        ("avg_mdr_rate_pct", "NUMERIC"), ("approval_rate_pct", "NUMERIC"), ("chargeback_rate_pct", "NUMERIC"),
        ("avg_ticket_brl", "NUMERIC"),
    ],
    "portfolio": [
        ("risk_classification_bacen", "STRING"), ("dpd_bucket", "STRING"), ("total_outstanding_brl", "NUMERIC"),
        ("npl_balance_brl", "NUMERIC"), ("npl_rate_pct", "NUMERIC"), ("total_expected_loss_brl", "NUMERIC"),
        ("portfolio_coverage_ratio", "NUMERIC"), ("written_off_balance_brl", "NUMERIC"), ("snapshot_date", "DATE"),
    ],
}


@pytest.mark.parametrize("model", sorted(DOCUMENTED))
def test_documented_columns_and_types(spark, model):
    schema = getattr(Models(spark, SF), model).schema
    for name, family in DOCUMENTED[model]:
        assert name in schema.fieldNames(), name
        assert isinstance(schema[name].dataType, FAMILY[family]), (name, schema[name].dataType)
