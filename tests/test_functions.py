"""Edge tables for the domain functions and staging rules (FIXTURES.md §5)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import functions as fn
from ledgerlake.operators import marts, staging
from ledgerlake.schemas import CREDIT_CONTRACTS, CUSTOMERS, TRANSACTIONS


def _tx_rows(spark, rows):
    """Rows as dicts over the transactions schema (missing fields NULL)."""
    names = [f.name for f in TRANSACTIONS.fields]
    base = {"transaction_id": "T", "amount_brl": Decimal("10.00"), "mdr_rate_pct": Decimal("2.0000"),
            "mdr_amount_brl": Decimal("0.20"), "net_amount_brl": Decimal("9.80"), "payment_method": "pix",
            "status": "approved", "transaction_date": dt.date(2024, 1, 2), "installments": 1}
    data = [tuple({**base, **r}.get(n) for n in names) for r in rows]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTIONS.fields])
    return spark.createDataFrame(data, schema)


def test_risk_class_and_bucket_edges(spark):
    dpds = [-1, 0, 1, 14, 15, 30, 31, 60, 61, 90, 91, 120, 121, 150, 151, 180, 181, None]
    df = spark.createDataFrame([(d,) for d in dpds], "dpd bigint")
    got = df.select("dpd", fn.classify_risk_bacen("dpd").alias("c"), fn.dpd_bucket("dpd").alias("b")).collect()
    cls = {r.dpd: r.c for r in got}
    bucket = {r.dpd: r.b for r in got}
    assert [cls[d] for d in dpds] == ["H", "AA", "A", "A", "B", "B", "C", "C", "D", "D", "E", "E",
                                      "F", "F", "G", "G", "H", "H"]
    assert bucket[0] == "Adimplente" and bucket[1] == bucket[30] == "1-30 dias"
    assert bucket[31] == "31-60 dias" and bucket[90] == "61-90 dias"
    assert bucket[91] == bucket[180] == "91-180 dias (NPL)"
    assert bucket[181] == bucket[None] == bucket[-1] == ">180 dias (Perda)"


def test_class_text_rank_and_provision(spark):
    raw = spark.createDataFrame([(" aa ",), ("h",), ("Z",), (None,)], "c string")
    out = raw.select(
        fn.risk_level_num(fn.clean_upper("c")).alias("rank"),
        fn.provision_rate(fn.clean_upper("c")).alias("rate"),
    ).collect()
    assert [r.rank for r in out] == [0, 8, None, None]
    assert [r.rate for r in out] == [Decimal("0.000"), Decimal("1.000"), None, None]


def test_flags_read_raw_status_and_filters(spark):
    df = _tx_rows(spark, [
        {"transaction_id": "a", "status": " APPROVED "},
        {"transaction_id": "b", "status": "approved"},
        {"transaction_id": "c", "status": None},
        {"transaction_id": "d", "amount_brl": Decimal("0")},
        {"transaction_id": "e", "amount_brl": Decimal("-1")},
        {"transaction_id": "f", "amount_brl": None},
        {"transaction_id": "g", "amount_brl": Decimal("0.01")},
        {"transaction_id": "", "status": "denied"},
        {"transaction_id": " ", "status": "denied"},
        {"transaction_id": None},
        {"transaction_id": "h", "transaction_date": None},
    ])
    stg = {r.transaction_id: r for r in staging.stg_transactions(df).collect()}
    assert set(stg) == {"a", "b", "c", "g", ""}  # '' and ' ' both trim to '' and are kept
    assert stg["a"].status == "approved" and stg["a"].is_approved is False
    assert stg["b"].is_approved is True and stg["c"].is_approved is None
    norm = {r.transaction_id: r for r in staging.stg_transactions(df, normalize_flags=True).collect()}
    assert norm["a"].is_approved is True


def test_day_without_approvals_and_half_cent_average(spark):
    df = _tx_rows(spark, [
        {"transaction_id": "x", "status": "denied", "transaction_date": dt.date(2024, 1, 3)},
        {"transaction_id": "y", "amount_brl": Decimal("0.01"), "transaction_date": dt.date(2024, 1, 4)},
        {"transaction_id": "z", "amount_brl": Decimal("0.02"), "transaction_date": dt.date(2024, 1, 4)},
    ])
    rows = {r.summary_date: r for r in marts.mart_fin_daily_summary(staging.stg_transactions(df)).collect()}
    denied = rows[dt.date(2024, 1, 3)]
    assert denied.total_tpv_brl == Decimal("0.00") and denied.avg_ticket_brl is None
    assert denied.chargeback_rate_pct is None and denied.approval_rate_pct == Decimal("0.00")
    assert rows[dt.date(2024, 1, 4)].avg_ticket_brl == Decimal("0.02")  # 0.015 rounds half up


def test_portfolio_three_valued_filter_unmatched_customer_and_zero_outstanding(spark):
    names = [f.name for f in CREDIT_CONTRACTS.fields]
    base = {"contract_id": "C", "customer_id": "CUS1", "product_type": "credit_line", "principal_brl": Decimal("100.00"),
            "outstanding_balance_brl": Decimal("50.00"), "monthly_rate_pct": Decimal("1.0000"), "term_months": 12,
            "contract_date": dt.date(2020, 1, 1), "maturity_date": dt.date(2024, 1, 1), "days_past_due": 0,
            "risk_classification_bacen": "AA", "is_npl": False, "is_written_off": False,
            "collateral_type": "none", "collateral_value_brl": Decimal("100.00")}
    rows = [
        {"contract_id": "keep_null_true", "is_written_off": None, "is_npl": True, "days_past_due": 120,
         "risk_classification_bacen": "E"},
        {"contract_id": "drop_null_false", "is_written_off": None, "is_npl": False},
        {"contract_id": "mat_eq_asof", "maturity_date": dt.date(2024, 1, 1)},
        {"contract_id": "mat_before", "maturity_date": dt.date(2023, 12, 31)},
        {"contract_id": "mat_null", "maturity_date": None, "is_npl": None},
        {"contract_id": "orphan", "customer_id": "UNKNOWN"},
        {"contract_id": "zero_out", "outstanding_balance_brl": Decimal("0.00")},
    ]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in CREDIT_CONTRACTS.fields])
    contracts = spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], schema)
    cnames = [f.name for f in CUSTOMERS.fields]
    cust = spark.createDataFrame(
        [tuple({"customer_id": "CUS1", "customer_segment": "sme", "credit_rating": "A", "cnpj": "12.345.678/0001-90"}
               .get(n) for n in cnames)],
        T.StructType([T.StructField(f.name, f.dataType, True) for f in CUSTOMERS.fields]))
    stg = staging.stg_credit_contracts(contracts, as_of="2024-01-01")
    by_id = {r.contract_id: r for r in stg.collect()}
    assert by_id["mat_eq_asof"].is_active is True and by_id["mat_before"].is_active is False
    assert by_id["zero_out"].collateral_coverage_ratio is None
    mart = marts.mart_risk_credit_portfolio(stg, staging.stg_customers(cust))
    total = sum(r.total_contracts for r in mart.collect())
    # kept: keep_null_true, mat_eq_asof, orphan, zero_out
    assert total == 4
    segments = {r.customer_segment for r in mart.collect()}
    assert None in segments  # the unmatched customer forms a NULL group


def test_masks(spark):
    df = spark.createDataFrame([("12.345.678/0001-90", "123.456.789-09", "12345678", "ab@x.com", "11987654321"),
                                (None, None, None, None, None)], "cnpj string, cpf string, acct string, email string, phone string")
    r = df.select(
        fn.mask_pii("cnpj", "cnpj").alias("cnpj"), fn.mask_pii("cpf", "cpf").alias("cpf"),
        fn.mask_pii("acct", "bank_account").alias("acct"), fn.mask_pii("email", "email").alias("email"),
        fn.mask_pii("phone", "phone").alias("phone"), fn.mask_pii("cnpj").alias("hash"),
    ).collect()
    assert r[0].cnpj == "12.***.***/001-90"
    assert r[0].cpf == "123.***.***-**"
    assert r[0].acct == "****5678"
    assert r[0].email == "ab***@***.**"
    assert r[0].phone == "1198****4321"
    assert len(r[0].hash) == 64
    assert all(v is None for v in r[1])


def test_business_days(spark):
    pairs = [("2024-02-09", "2024-02-12"),  # Fri -> Mon
             ("2024-02-10", "2024-02-11"),  # Sat -> Sun
             ("2024-02-11", "2024-02-17"),  # Sun -> Sat
             ("2024-02-09", "2024-02-10"),  # Fri -> Sat
             ("2024-02-09", "2024-02-16")]  # across the Carnival holidays
    df = spark.createDataFrame(pairs, "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    r = df.select(fn.business_days_between("a", "b").alias("macro"), fn.weekdays_between("a", "b").alias("wd"),
                  fn.business_days_exact("a", "b").alias("exact")).collect()
    assert [x.macro for x in r] == [1, -1, 4, 0, 5]  # the formula is one low for a Saturday end
    assert [x.wd for x in r] == [1, 0, 5, 1, 5]
    assert [x.exact for x in r] == [1, 0, 3, 1, 3]  # Feb 12 and 13 are holidays


def test_national_holidays_rule():
    h = set(fn.national_holidays([2024]))
    assert dt.date(2024, 2, 12) in h and dt.date(2024, 2, 13) in h and dt.date(2024, 12, 25) in h
    assert dt.date(2024, 3, 29) in h  # Good Friday from the Easter rule


def test_small_formulas(spark):
    df = spark.createDataFrame([(Decimal("100.00"), Decimal("97.50"), Decimal("2.0000"))],
                               "g decimal(18,2), n decimal(18,2), m decimal(9,4)")
    r = df.select(
        fn.calculate_mdr("g", "n").alias("mdr"),
        F.round(fn.monthly_to_annual_rate("m"), 6).alias("annual"),
        fn.surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("sk"),
        fn.blended_mdr_pct(F.lit(Decimal("2.0")), F.lit(Decimal("1.0")), F.lit(Decimal("0.5"))).alias("blend"),
        fn.format_value(F.lit(Decimal("1234.5")), "brazilian_real").alias("fmt"),
    ).first()
    assert df.agg(fn.money_sum("g").alias("s")).first().s == Decimal("100.00")
    assert r.mdr == Decimal("2.5")
    assert abs(r.annual - 26.824179) < 1e-6
    assert r.sk == __import__("hashlib").md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert r.blend == Decimal("1.5250")
    assert r.fmt == "R$ 1,234.50"


def test_calendar_join_matches_expression_form(spark):
    hol = fn.national_holidays(range(2023, 2026))
    rows = [("2024-02-09", "2024-02-16"), ("2022-12-30", "2023-01-03"), ("2026-12-30", "2027-01-05"),
            ("2024-03-01", "2024-02-01"), (None, "2024-01-01")]
    df = spark.createDataFrame(rows, "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    got = fn.with_business_days(df, "a", "b", hol).select(
        "business_days", fn.business_days_exact("a", "b", hol).alias("expr")).collect()
    assert [r.business_days for r in got] == [r.expr for r in got]
    assert got[0].business_days == 3
