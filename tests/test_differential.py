"""Differential test: random raw transactions through Spark (staging + daily
mart) and through the independent DuckDB SQL of the oracle, compared exactly."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerlake.edge import to_edge
from ledgerlake.operators import marts, staging
from ledgerlake.oracle_sql import M6_COLUMNS, MART_SQL, STG
from ledgerlake.schemas import TRANSACTIONS
from tools.oracle_check import compare

money = st.one_of(st.none(), st.decimals(min_value=Decimal("-5"), max_value=Decimal("500"), places=2))
rate = st.one_of(st.none(), st.decimals(min_value=Decimal("0"), max_value=Decimal("9.9999"), places=4))
row = st.fixed_dictionaries({
    "transaction_id": st.one_of(st.none(), st.sampled_from(["a", " b ", "", "c"])),
    "amount_brl": money,
    "mdr_rate_pct": rate,
    "mdr_amount_brl": money,
    "net_amount_brl": money,
    "payment_method": st.one_of(st.none(), st.sampled_from(["pix", " PIX ", "ted", "credit_card"])),
    "status": st.one_of(st.none(), st.sampled_from(["approved", " APPROVED ", "denied", "chargeback", "pending"])),
    "transaction_date": st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 10))),
    "installments": st.one_of(st.none(), st.integers(0, 12)),
})


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_daily_mart_matches_sql_on_random_rows(spark, rows):
    names = [f.name for f in TRANSACTIONS.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTIONS.fields])
    df = spark.createDataFrame(data, nullable)
    got = to_edge(marts.mart_fin_daily_summary(staging.stg_transactions(df))).toPandas()

    con = duckdb.connect()
    con.register("transactions_src", df.toPandas())
    con.execute("CREATE TABLE transactions AS SELECT "
                "transaction_id, merchant_id, customer_id, CAST(amount_brl AS DECIMAL(18,2)) AS amount_brl, "
                "CAST(mdr_rate_pct AS DECIMAL(9,4)) AS mdr_rate_pct, CAST(mdr_amount_brl AS DECIMAL(18,2)) AS mdr_amount_brl, "
                "CAST(net_amount_brl AS DECIMAL(18,2)) AS net_amount_brl, payment_method, status, "
                "CAST(transaction_date AS DATE) AS transaction_date, CAST(transaction_ts AS TIMESTAMP) AS transaction_ts, "
                "CAST(installments AS BIGINT) AS installments, authorization_code, acquirer FROM transactions_src")
    sql = ("WITH " + STG["stg_transactions"] + ",\n" + MART_SQL["mart_fin_daily_summary"]
           + f"\nSELECT {M6_COLUMNS} FROM mart_fin_daily_summary")
    want = con.execute(sql).df()
    assert compare(got, want) == []


contract = st.fixed_dictionaries({
    "contract_id": st.one_of(st.none(), st.sampled_from(["k1", "k2", " k3 ", "k4", "k5"])),
    "customer_id": st.one_of(st.none(), st.sampled_from(["c1", "c2", "zz"])),
    "product_type": st.sampled_from(["credit_line", " Trade_Finance "]),
    "principal_brl": money,
    "outstanding_balance_brl": money,
    "days_past_due": st.one_of(st.none(), st.sampled_from([-1, 0, 1, 30, 31, 90, 91, 180, 181])),
    "risk_classification_bacen": st.one_of(st.none(), st.sampled_from(["AA", " b ", "H", "Z"])),
    "is_npl": st.one_of(st.none(), st.booleans()),
    "is_written_off": st.one_of(st.none(), st.booleans()),
    "maturity_date": st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 12, 31))),
    "collateral_type": st.sampled_from(["none", "real_estate"]),
    "collateral_value_brl": money,
})


@settings(max_examples=6, deadline=None)
@given(st.lists(contract, min_size=1, max_size=30))
def test_portfolio_mart_matches_sql_on_random_rows(spark, rows):
    from ledgerlake.oracle_sql import M7_COLUMNS
    from ledgerlake.schemas import CREDIT_CONTRACTS, CUSTOMERS
    from ledgerlake.sources.testviews import AS_OF

    names = [f.name for f in CREDIT_CONTRACTS.fields]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in CREDIT_CONTRACTS.fields])
    contracts = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], nullable)
    cnames = [f.name for f in CUSTOMERS.fields]
    cust_rows = [{"customer_id": "c1", "customer_segment": " SME ", "credit_rating": "a", "cnpj": "12.345.678/0001-90"},
                 {"customer_id": "c2", "customer_segment": "micro", "credit_rating": "B", "cnpj": None}]
    customers = spark.createDataFrame([tuple(r.get(n) for n in cnames) for r in cust_rows],
                                      T.StructType([T.StructField(f.name, f.dataType, True) for f in CUSTOMERS.fields]))
    got = to_edge(marts.mart_risk_credit_portfolio(
        staging.stg_credit_contracts(contracts, as_of=AS_OF.replace("2001", "2024")),
        staging.stg_customers(customers), snapshot_date="2024-06-01")).toPandas()

    con = duckdb.connect()
    con.register("contracts_src", contracts.toPandas())
    con.register("customers_src", customers.toPandas())
    casts = ", ".join(f"CAST({f.name} AS {'DECIMAL(18,2)' if 'decimal(18' in f.dataType.simpleString() else 'DECIMAL(9,4)' if 'decimal(9' in f.dataType.simpleString() else 'DATE' if f.dataType.simpleString() == 'date' else 'BIGINT' if f.dataType.simpleString() == 'bigint' else 'BOOLEAN' if f.dataType.simpleString() == 'boolean' else 'VARCHAR'}) AS {f.name}"
                      for f in CREDIT_CONTRACTS.fields)
    con.execute(f"CREATE TABLE credit_contracts AS SELECT {casts} FROM contracts_src")
    con.execute("CREATE TABLE customers AS SELECT * FROM customers_src")
    stg = STG["stg_credit_contracts"].replace("DATE '2001-08-01'", "DATE '2024-08-01'")
    sql = ("WITH " + stg + ",\n" + STG["stg_customers"] + ",\n" + MART_SQL["rated_contracts"] + ",\n"
           + MART_SQL["mart_risk_credit_portfolio"]
           + f"\nSELECT {M7_COLUMNS}, '2024-06-01' AS snapshot_date FROM mart_risk_credit_portfolio")
    want = con.execute(sql).df()
    assert compare(got, want) == []


ops_row = st.fixed_dictionaries({
    "transaction_id": st.sampled_from(["a", "b"]),
    "merchant_id": st.one_of(st.none(), st.sampled_from(["M1", "M2"])),
    "acquirer": st.one_of(st.none(), st.sampled_from(["cielo", " Rede "])),
    "amount_brl": st.decimals(min_value=Decimal("0.01"), max_value=Decimal("300"), places=2),
    "mdr_amount_brl": money,
    "status": st.one_of(st.none(), st.sampled_from(["approved", "denied", "chargeback"])),
    "transaction_date": st.dates(dt.date(2024, 1, 30), dt.date(2024, 2, 2)),
})


@settings(max_examples=6, deadline=None)
@given(st.lists(ops_row, min_size=1, max_size=40))
def test_operations_mart_matches_sql_on_random_rows(spark, rows):
    names = [f.name for f in TRANSACTIONS.fields]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTIONS.fields])
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], nullable)
    got = to_edge(marts.transaction_operations(staging.stg_transactions(df))).toPandas()

    con = duckdb.connect()
    con.register("transactions_src", df.toPandas())
    con.execute("CREATE TABLE transactions AS SELECT transaction_id, merchant_id, customer_id, "
                "CAST(amount_brl AS DECIMAL(18,2)) AS amount_brl, CAST(mdr_rate_pct AS DECIMAL(9,4)) AS mdr_rate_pct, "
                "CAST(mdr_amount_brl AS DECIMAL(18,2)) AS mdr_amount_brl, CAST(net_amount_brl AS DECIMAL(18,2)) AS net_amount_brl, "
                "payment_method, status, CAST(transaction_date AS DATE) AS transaction_date, "
                "CAST(transaction_ts AS TIMESTAMP) AS transaction_ts, CAST(installments AS BIGINT) AS installments, "
                "authorization_code, acquirer FROM transactions_src")
    from ledgerlake.oracle_sql import _OPS_COLS

    sql = ("WITH " + STG["stg_transactions"] + ",\n" + MART_SQL["transaction_operations"]
           + f"\nSELECT {_OPS_COLS} FROM transaction_operations")
    want = con.execute(sql).df()
    assert compare(got, want) == []
