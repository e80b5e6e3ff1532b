"""Row policies, field and explore grants, classification tags.

Policies are plain ``where`` predicates applied to the base rows *before*
any aggregation (an aggregate built first cannot be filtered safely), so
they also push down into the scan. Principals are arguments; no identity
system is modelled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Access grants (department values allowed by each grant).
ACCESS_GRANTS: dict[str, tuple[str, ...]] = {
    "risk_team_only": ("risk", "executive", "data_engineering"),
    "finance_team": ("finance", "risk", "executive", "data_engineering"),
    "executive_only": ("executive", "data_engineering"),
}

# Sensitivity levels, least to most restricted.
SENSITIVITY_LEVELS = ("public", "internal", "confidential", "restricted")


@dataclass(frozen=True)
class Principal:
    """Who asks: a department (the grant attribute) plus group memberships."""

    department: str
    groups: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, department: str, *groups: str) -> Principal:
        return cls(department, frozenset(groups or (department,)))


def has_grant(principal: Principal, grants: Iterable[str]) -> bool:
    """All named grants must allow the principal's department."""
    return all(principal.department in ACCESS_GRANTS[g] for g in grants)


class AccessDenied(PermissionError):
    pass


def require_grants(principal: Principal, grants: Iterable[str], what: str) -> None:
    """Explore-level grant: refuse the whole request before planning."""
    grants = list(grants)
    if grants and not has_grant(principal, grants):
        raise AccessDenied(f"{principal.department!r} may not use {what} (needs {grants})")


@dataclass(frozen=True)
class RowPolicy:
    name: str
    table: str
    grantees: frozenset[str]
    predicate: Column


def policy(name: str, table: str, grantees: Iterable[str], predicate: Column | bool = True) -> RowPolicy:
    pred = predicate if isinstance(predicate, Column) else F.lit(bool(predicate))
    return RowPolicy(name, table, frozenset(grantees), pred)


# Identity the semantic layer queries with (granted like a service account).
SERVICE_GROUP = "bi_service"


def default_policies() -> list[RowPolicy]:
    """The three row policies of the governance guide."""
    return [
        policy("rls_risk_credit", "risk_credit_portfolio", {"risk", SERVICE_GROUP}, True),
        policy("rls_finance_bu", "fin_merchant_metrics", {"finance"},
               F.col("business_unit").isin("finance", "executive")),
        policy("rls_sales_aggregated", "ops_transaction_metrics", {"sales"},
               F.col("granularity") == "monthly"),
    ]


def row_filter(table: str, principal: Principal, policies: Sequence[RowPolicy]) -> Column:
    """Visible-row predicate of ``principal`` on ``table``.

    No policy on the table: every row. Policies exist: the OR of the ones
    granted to any of the principal's groups; none granted: no row.
    """
    on_table = [p for p in policies if p.table == table]
    if not on_table:
        return F.lit(True)
    granted = [p.predicate for p in on_table if p.grantees & principal.groups]
    if not granted:
        return F.lit(False)
    pred = granted[0]
    for g in granted[1:]:
        pred = pred | g
    return F.coalesce(pred, F.lit(False))


def apply_row_policies(df: DataFrame, table: str, principal: Principal,
                       policies: Sequence[RowPolicy] | None = None) -> DataFrame:
    return df.where(row_filter(table, principal, default_policies() if policies is None else policies))


def with_business_unit(df: DataFrame, source_col: str, mapping: Mapping[str, str],
                       default: str | None = None) -> DataFrame:
    """Attach the ``business_unit`` policy column from a value mapping."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(source_col) == k, v) if expr is None else expr.when(F.col(source_col) == k, v)
    expr = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return df.withColumn("business_unit", expr.cast("string"))


def visible_columns(columns: Sequence[str], field_grants: Mapping[str, Sequence[str]],
                    principal: Principal) -> list[str]:
    """Columns whose required grants the principal holds (others vanish)."""
    return [c for c in columns if has_grant(principal, field_grants.get(c, ()))]


def select_granted(df: DataFrame, field_grants: Mapping[str, Sequence[str]], principal: Principal) -> DataFrame:
    return df.select(*visible_columns(df.columns, field_grants, principal))


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach classification metadata (sensitivity, owner, domain) to columns."""
    out = df
    for c, meta in tags.items():
        out = out.withMetadata(c, {**(df.schema[c].metadata or {}), **dict(meta)})
    return out


def columns_at_or_above(df: DataFrame, level: str) -> list[str]:
    """Columns tagged with a sensitivity at or above ``level``."""
    rank = {lvl: i for i, lvl in enumerate(SENSITIVITY_LEVELS)}
    out = []
    for f in df.schema.fields:
        tag = (f.metadata or {}).get("sensitivity")
        if tag in rank and rank[tag] >= rank[level]:
            out.append(f.name)
    return out


def mask_restricted(df: DataFrame, masks: Mapping[str, str] | None = None) -> DataFrame:
    """Replace every column tagged 'restricted' by its mask (default: SHA-256)."""
    from ..functions import mask_pii

    masks = masks or {}
    cols = []
    for f in df.schema.fields:
        meta = f.metadata or {}
        if meta.get("sensitivity") == "restricted":
            cols.append(mask_pii(f.name, masks.get(f.name, meta.get("mask", "default"))).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def aggregate_only(df: DataFrame, granularity_col: str = "granularity", level: str = "monthly") -> DataFrame:
    """Aggregate-only release: keep rolled-up rows only."""
    return df.where(F.col(granularity_col) == level)
