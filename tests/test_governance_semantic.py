"""Row policies per principal, grants, and the explore builder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import governance as g
from ledgerlake.plans import dashboard
from ledgerlake.plans.model import EXPLORES, DAILY_FINANCIAL_SUMMARY
from ledgerlake.plans.semantic import Explore, Measure
from ledgerlake.registry import Models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def policy_frame(spark):
    return spark.createDataFrame(
        [("finance", "daily"), ("executive", "monthly"), ("operations", "monthly"), ("operations", "daily")],
        "business_unit string, granularity string")


@pytest.mark.parametrize("dept,table,expected", [
    ("risk", "risk_credit_portfolio", 4),
    ("finance", "risk_credit_portfolio", 0),
    ("finance", "fin_merchant_metrics", 2),
    ("sales", "fin_merchant_metrics", 0),
    ("sales", "ops_transaction_metrics", 2),
    ("executive", "ops_transaction_metrics", 0),
    ("data_engineering", "fin_merchant_metrics", 0),
    ("unknown", "risk_credit_portfolio", 0),
    ("unknown", "some_unpoliced_table", 4),
])
def test_row_policies(spark, policy_frame, dept, table, expected):
    assert g.apply_row_policies(policy_frame, table, g.Principal.of(dept)).count() == expected


def test_grants():
    assert g.has_grant(g.Principal.of("data_engineering"), ["risk_team_only", "executive_only"])
    assert not g.has_grant(g.Principal.of("finance"), ["risk_team_only"])
    with pytest.raises(g.AccessDenied):
        g.require_grants(g.Principal.of("sales"), ["risk_team_only"], "explore credit_portfolio")


def test_explore_grant_refuses_whole_request(spark):
    with pytest.raises(g.AccessDenied):
        EXPLORES["credit_portfolio"].query(Models(spark, SF), ["credit_portfolio.total_contracts"],
                                           principal=g.Principal.of("finance"))


def test_field_grant_drops_silently(spark):
    view = DAILY_FINANCIAL_SUMMARY.extend("t", measures=[Measure("secret_tpv", "sum", "total_tpv_brl",
                                                            grants=("executive_only",))])
    ex = Explore("t", view)
    df = ex.query(Models(spark, SF), ["t.payment_method", "t.secret_tpv", "t.total_transactions"],
                  principal=g.Principal.of("risk"))
    assert df.columns == ["payment_method", "total_transactions"]


def test_join_on_demand_and_always_filter(spark):
    m = Models(spark, SF)
    ex = EXPLORES["daily_financial_summary"]
    no_join = ex.query(m, ["daily_financial_summary.payment_method", "daily_financial_summary.total_tpv_brl"],
                       principal=g.Principal.of("finance"), filters={"daily_financial_summary.summary_date": (None, None)})
    with_join = ex.query(m, ["daily_rates.is_business_day", "daily_financial_summary.total_tpv_brl"],
                         principal=g.Principal.of("finance"), filters={"daily_financial_summary.summary_date": (None, None)})
    plan_a = no_join._jdf.queryExecution().optimizedPlan().toString()
    plan_b = with_join._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan_a  # the rates view is not joined when unused
    assert "LeftOuter" in plan_b
    # The always-filter (last 90 days) applies when the caller does not filter the date.
    last90 = ex.query(m, ["daily_financial_summary.total_transactions"], principal=g.Principal.of("finance"),
                      as_of="2001-08-01").first()[0]
    manual = m.daily_summary.where((F.col("summary_date") > F.date_sub(F.lit("2001-08-01").cast("date"), 90))
                                   & (F.col("summary_date") <= F.lit("2001-08-01").cast("date"))
                                   ).agg(F.sum("total_transactions")).first()[0]
    assert last90 == manual
    with pytest.raises(ValueError):
        ex.query(m, ["daily_financial_summary.total_transactions"], principal=g.Principal.of("finance"))


def test_hidden_sort_field_orders_classes(spark):
    df = dashboard.tile_by_risk_class(Models(spark, SF), g.Principal.of("risk"))
    assert df.columns == ["risk_classification_bacen", "total_outstanding_brl", "npl_balance_brl"]
    classes = [r.risk_classification_bacen for r in df.collect()]
    order = ["AA", "A", "B", "C", "D", "E", "F", "G", "H"]
    assert classes == sorted(classes, key=order.index)


def test_drill_uses_drill_fields(spark):
    df = dashboard.drill(Models(spark, SF), "daily_financial_summary", "total_tpv_brl", g.Principal.of("finance"),
                         {"daily_financial_summary.summary_date": ("2000-01-01", "2000-02-01")})
    assert df.columns == ["summary_date", "payment_method", "total_tpv_brl"]


def test_tags_and_restricted_masking(spark):
    df = spark.createDataFrame([("12.345.678/0001-90", "x")], "cnpj string, other string")
    tagged = g.tag_columns(df, {"cnpj": {"sensitivity": "restricted", "mask": "cnpj"}})
    assert g.columns_at_or_above(tagged, "confidential") == ["cnpj"]
    assert g.mask_restricted(tagged).first().cnpj == "12.***.***/001-90"


def test_fanout_check(spark):
    from ledgerlake.plans.semantic import FanOutError

    class Ctx:
        as_of = "2001-08-01"
        def __init__(self, m):
            self.daily_summary = m.daily_summary
            self.rates = m.rates.unionByName(m.rates)  # every rate date twice

    ex = EXPLORES["daily_financial_summary"]
    fields = ["daily_rates.is_business_day", "daily_financial_summary.total_tpv_brl"]
    flt = {"daily_financial_summary.summary_date": (None, None)}
    ctx = Ctx(Models(spark, SF))
    with pytest.raises(FanOutError):
        ex.query(ctx, fields, principal=g.Principal.of("finance"), filters=flt, check_fanout=True)
    ex.query(Models(spark, SF), fields, principal=g.Principal.of("finance"), filters=flt, check_fanout=True)


def test_compare_relations_duplicate_keys_do_not_multiply(spark):
    from ledgerlake.operators.reconcile import compare_relations

    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, "x"), (2, "w"), (4, "q")], "k int, v string")
    got = {r.k: (r.status, r.changed_columns) for r in compare_relations(a, b, ["k"]).collect()}
    assert got == {1: ("duplicate_key", ""), 2: ("changed", "v"), 3: ("only_in_a", None), 4: ("only_in_b", None)}
