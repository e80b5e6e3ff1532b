"""Executive dashboard: the data behind each tile, one lazy DataFrame each.

Dashboard filters: a date range (half-open [start, end); default the last
30 days up to ``as_of``) and a payment-method list (empty = all methods),
bound to the financial tiles. Rendering (layout, colours, charts) is not
data work and is not built; the approval-rate colour band is returned as
a column.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.finance import PAYMENT_METHOD_LABELS
from ..operators.governance import Principal
from .model import EXPLORES

# Tile thresholds.
APPROVAL_GREEN_ABOVE = 85
APPROVAL_RED_BELOW = 75
NPL_HEALTHY_BELOW = 3
DEFAULT_DATE_RANGE = "30 days"


def _fin_filters(date_range: Any, methods: Sequence[str] = ()) -> dict[str, Any]:
    f: dict[str, Any] = {"daily_financial_summary.summary_date": date_range}
    if methods:
        f["daily_financial_summary.payment_method"] = list(methods)
    return f


def _fin(ctx, fields, principal, date_range, methods, **kw) -> DataFrame:
    return EXPLORES["daily_financial_summary"].query(
        ctx, fields, principal=principal, filters=_fin_filters(date_range, methods),
        as_of=getattr(ctx, "as_of", None), **kw)


def tile_tpv(ctx, principal: Principal, date_range: Any = DEFAULT_DATE_RANGE, methods: Sequence[str] = ()) -> DataFrame:
    return _fin(ctx, ["daily_financial_summary.total_tpv_brl"], principal, date_range, methods)


def tile_mdr_revenue(ctx, principal: Principal, date_range: Any = DEFAULT_DATE_RANGE,
                     methods: Sequence[str] = ()) -> DataFrame:
    return _fin(ctx, ["daily_financial_summary.total_mdr_revenue_brl"], principal, date_range, methods)


def tile_approval_rate(ctx, principal: Principal, date_range: Any = DEFAULT_DATE_RANGE,
                       methods: Sequence[str] = ()) -> DataFrame:
    """Average approval rate with its colour band (> 85 green, < 75 red)."""
    df = _fin(ctx, ["daily_financial_summary.approval_rate_pct",
                    "daily_financial_summary.approval_rate_weighted_pct"], principal, date_range, methods)
    rate = F.col("approval_rate_pct")
    band = (F.when(rate > APPROVAL_GREEN_ABOVE, "green")
            .when(rate < APPROVAL_RED_BELOW, "red").otherwise("none"))
    return df.withColumn("band", band)


def tile_chargeback_rate(ctx, principal: Principal, date_range: Any = DEFAULT_DATE_RANGE,
                         methods: Sequence[str] = ()) -> DataFrame:
    return _fin(ctx, ["daily_financial_summary.chargeback_rate_pct",
                      "daily_financial_summary.chargeback_rate_weighted_pct"], principal, date_range, methods)


OTHER_LABEL = "Outros"


def tile_tpv_weekly(ctx, principal: Principal, date_range: Any = DEFAULT_DATE_RANGE,
                    methods: Sequence[str] = ()) -> DataFrame:
    """Weekly TPV pivoted by the Portuguese method label, oldest week first.

    The pivot values are the fixed label list, so Spark needs no extra job
    to discover them; all other labels share the column ``OTHER_LABEL``, so that
    a row's columns add up to the week's TPV.
    """
    return _fin(ctx, ["daily_financial_summary.summary_week", "daily_financial_summary.total_tpv_brl"],
                principal, date_range, methods,
                pivot="daily_financial_summary.payment_method_label",
                pivot_values=list(PAYMENT_METHOD_LABELS.values()), pivot_other=OTHER_LABEL,
                sorts=[("daily_financial_summary.summary_week", "asc")])


def tile_npl_rate(ctx, principal: Principal) -> DataFrame:
    df = EXPLORES["credit_portfolio"].query(
        ctx, ["credit_portfolio.npl_rate_pct", "credit_portfolio.npl_rate_weighted_pct"], principal=principal)
    return df.withColumn("is_healthy", F.col("npl_rate_weighted_pct") < NPL_HEALTHY_BELOW)


def tile_exposure(ctx, principal: Principal) -> DataFrame:
    return EXPLORES["credit_portfolio"].query(ctx, ["credit_portfolio.total_outstanding_brl"], principal=principal)


def tile_by_risk_class(ctx, principal: Principal) -> DataFrame:
    """Exposure and NPL per class, sorted AA..H through the hidden order field."""
    return EXPLORES["credit_portfolio"].query(
        ctx, ["credit_portfolio.risk_classification_bacen", "credit_portfolio.total_outstanding_brl",
              "credit_portfolio.npl_balance_brl"],
        principal=principal, sorts=[("credit_portfolio.risk_classification_bacen", "asc")])


def tile_npl_by_segment(ctx, principal: Principal) -> DataFrame:
    return EXPLORES["credit_portfolio"].query(
        ctx, ["credit_portfolio.customer_segment", "credit_portfolio.npl_balance_brl"],
        principal=principal, sorts=[("credit_portfolio.npl_balance_brl", "desc")])


def drill(ctx, explore: str, measure: str, principal: Principal, filters: dict[str, Any] | None = None) -> DataFrame:
    """Re-query a measure with its drill fields as the dimensions."""
    ex = EXPLORES[explore]
    _, m = ex.resolve(measure)
    fields = [f if "." in f else f"{ex.base.name}.{f}" for f in m.drill_fields]
    return ex.query(ctx, fields, principal=principal, filters=filters, as_of=getattr(ctx, "as_of", None))
