"""Domain tables derived from the driver's TPC-H-style parquet tables.

The reference ships no data, only schemas. These views map the driver tables
onto the five raw schemas (see FIXTURES.md §3). Each view is one SQL
expression list over one FROM clause, used twice: by Spark through
``selectExpr`` (lazy, prunable, one plan with whatever consumes it) and by the
DuckDB oracle as a CTE, so both sides start from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed test date: contract activity and policy windows are evaluated here.
AS_OF = "2001-08-01"

_DPD = (
    "case when o_orderkey % 8 <> 0 then 0 "
    "else 1 + cast(floor(o_orderkey/8) as bigint) % 240 end"
)



def _id(prefix: str, key: str, width: int) -> str:
    """An id with its number padded to ``width`` at least; a longer number stays whole."""
    text = f"cast({key} as string)"
    return f"concat('{prefix}', lpad({text}, cast(greatest(length({text}), {width}) as int), '0'))"


_TERM = (
    "case cast(o_orderkey % 6 as int) when 0 then 6 when 1 then 12 when 2 then 18 "
    "when 3 then 24 when 4 then 36 else 48 end"
)


@dataclass(frozen=True)
class ViewSpec:
    name: str
    tables: tuple[str, ...]
    from_sql: str
    columns: tuple[tuple[str, str], ...]
    inner: tuple[tuple[str, str], ...] = ()  # optional first projection
    where: str | None = None

    def select_sql(self, business_day_expr: str | None = None) -> str:
        cols = []
        for name, expr in self.columns:
            if name == "is_business_day" and business_day_expr:
                expr = business_day_expr
            cols.append(f"{expr} AS {name}")
        body = f"SELECT {', '.join(cols)} FROM "
        if self.inner:
            inner_cols = ", ".join(f"{e} AS {n}" for n, e in self.inner)
            src = f"(SELECT *, {inner_cols} FROM {self.from_sql}"
            src += f" WHERE {self.where})" if self.where else ")"
            return body + src + " src"
        return body + self.from_sql + (f" WHERE {self.where}" if self.where else "")


TRANSACTIONS = ViewSpec(
    "transactions",
    ("lineitem", "orders"),
    "lineitem JOIN orders ON l_orderkey = o_orderkey",
    (
        ("transaction_id", "concat('TXN-', cast(l_orderkey as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(l_linenumber as string))"),
        ("merchant_id", _id("MER", "l_suppkey", 5)),
        ("customer_id", _id("CUS", "o_custkey", 6)),
        ("amount_brl", "cast(l_extendedprice as decimal(18,2))"),
        ("mdr_rate_pct", "cast(cast(l_discount as decimal(9,2)) * 100 as decimal(9,4))"),
        ("mdr_amount_brl", "cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(9,2)), 2) as decimal(18,2))"),
        ("net_amount_brl", "cast(cast(l_extendedprice as decimal(18,2)) - cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(9,2)), 2) as decimal(18,2)) as decimal(18,2))"),
        ("payment_method", "case substring(o_orderpriority,1,1) when '1' then 'credit_card' when '2' then 'debit_card' when '3' then 'pix' when '4' then 'boleto' else 'ted' end"),
        ("status", "case when l_returnflag = 'N' or (l_returnflag = 'A' and l_linestatus = 'F') then 'approved' when l_returnflag = 'A' then 'denied' when l_linestatus = 'F' then 'chargeback' when o_orderstatus = 'P' then 'pending' else 'cancelled' end"),
        ("transaction_date", "cast(l_shipdate as date)"),
        ("transaction_ts", "l_shipdate"),
        ("installments", "case when substring(o_orderpriority,1,1) = '1' then 1 + cast(l_quantity as bigint) % 12 else cast(1 as bigint) end"),
        ("authorization_code", "concat('AUTH', lpad(cast(l_orderkey % 1000000 as string), 6, '0'))"),
        ("acquirer", "case cast(l_suppkey % 4 as int) when 0 then 'cielo' when 1 then 'rede' when 2 then 'getnet' else 'stone' end"),
    ),
)

CUSTOMERS = ViewSpec(
    "customers",
    ("customer", "nation", "region"),
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    (
        ("customer_id", _id("CUS", "c_custkey", 6)),
        ("company_name", "c_name"),
        ("cnpj", "concat(lpad(cast(10 + c_custkey % 90 as string), 2, '0'), '.', lpad(cast(c_custkey % 1000 as string), 3, '0'), '.', lpad(cast((c_custkey * 7) % 1000 as string), 3, '0'), '/0001-', lpad(cast(10 + (c_custkey * 3) % 90 as string), 2, '0'))"),
        ("customer_segment", "case c_mktsegment when 'AUTOMOBILE' then 'startup' when 'BUILDING' then 'sme' when 'FURNITURE' then 'enterprise' when 'HOUSEHOLD' then 'micro' else 'sme' end"),
        ("credit_rating", "case when c_acctbal < 0 then 'CCC' when c_acctbal < 1500 then 'B' when c_acctbal < 3000 then 'BB' when c_acctbal < 4500 then 'BBB' when c_acctbal < 6000 then 'A' when c_acctbal < 8000 then 'AA' else 'AAA' end"),
        ("monthly_revenue_brl", "cast(abs(c_acctbal) * 100 as decimal(18,2))"),
        ("registration_date", "cast(date '1995-01-01' + cast(c_custkey % 366 as int) as date)"),
        ("city", "r_name"),
        ("state", "n_name"),
        ("is_active", "c_custkey % 20 <> 0"),
        ("account_manager_id", "concat('AM', lpad(cast(1 + c_custkey % 20 as string), 3, '0'))"),
    ),
)

MERCHANTS = ViewSpec(
    "merchants",
    ("supplier",),
    "supplier",
    (
        ("merchant_id", _id("MER", "s_suppkey", 5)),
        ("merchant_name", "s_name"),
        ("merchant_segment", "case cast(s_suppkey % 6 as int) when 0 then 'food_delivery' when 1 then 'retail' when 2 then 'saas' when 3 then 'healthcare' when 4 then 'education' else 'logistics' end"),
        ("mdr_credit", "cast(cast(1500 + s_suppkey % 1700 as decimal(9,0)) * cast(0.001 as decimal(4,3)) as decimal(9,4))"),
        ("mdr_debit", "cast(cast(900 + s_suppkey % 1000 as decimal(9,0)) * cast(0.001 as decimal(4,3)) as decimal(9,4))"),
        ("mdr_pix", "cast(cast(400 + s_suppkey % 200 as decimal(9,0)) * cast(0.001 as decimal(4,3)) as decimal(9,4))"),
        ("activated_at", "cast(date '1995-01-01' + cast(s_suppkey % 181 as int) as date)"),
        ("is_active", "s_suppkey % 12 <> 0"),
        ("customer_id", _id("CUS", "s_suppkey", 6)),
    ),
)

CREDIT_CONTRACTS = ViewSpec(
    "credit_contracts",
    ("orders",),
    "orders",
    (
        ("contract_id", _id("CTR", "o_orderkey", 7)),
        ("customer_id", _id("CUS", "o_custkey", 6)),
        ("product_type", "case cast(cast(floor(o_orderkey/3) as bigint) % 4 as int) when 0 then 'working_capital' when 1 then 'credit_line' when 2 then 'equipment_finance' else 'trade_finance' end"),
        ("principal_brl", "cast(o_totalprice as decimal(18,2))"),
        ("outstanding_balance_brl", "cast(round(cast(o_totalprice as decimal(18,2)) * cast(o_orderkey % 101 as decimal(9,0)) * cast(0.01 as decimal(3,2)), 2) as decimal(18,2))"),
        ("monthly_rate_pct", "cast(cast(8 + o_orderkey % 28 as decimal(9,0)) * cast(0.1 as decimal(2,1)) as decimal(9,4))"),
        ("term_months", f"cast({_TERM} as bigint)"),
        ("contract_date", "cast(o_orderdate as date)"),
        ("maturity_date", f"cast(cast(o_orderdate as date) + cast(30 * ({_TERM}) as int) as date)"),
        ("days_past_due", "cast(dpd as bigint)"),
        ("risk_classification_bacen", "case when dpd = 0 then 'AA' when dpd <= 14 then 'A' when dpd <= 30 then 'B' when dpd <= 60 then 'C' when dpd <= 90 then 'D' when dpd <= 120 then 'E' when dpd <= 150 then 'F' when dpd <= 180 then 'G' else 'H' end"),
        ("is_npl", "dpd > 90"),
        ("is_written_off", "dpd > 180 and cast(floor(o_orderkey/8) as bigint) % 2 = 0"),
        ("collateral_type", "case cast(floor(o_orderkey/5) as bigint) % 4 when 0 then 'none' when 1 then 'receivables' when 2 then 'real_estate' else 'equipment' end"),
        ("collateral_value_brl", "cast(round(cast(o_totalprice as decimal(18,2)) * cast((o_orderkey * 7) % 200 as decimal(9,0)) * cast(0.01 as decimal(3,2)), 2) as decimal(18,2))"),
    ),
    inner=(("dpd", _DPD),),
)

DAILY_RATES = ViewSpec(
    "daily_rates",
    ("lineitem",),
    "(SELECT DISTINCT cast(l_shipdate as date) AS d FROM lineitem WHERE extract(day from l_shipdate) <> 13) x",
    (
        ("rate_date", "d"),
        ("cdi_annual_pct", "cast(8 + cast(extract(day from d) as decimal(9,0)) * cast(0.05 as decimal(3,2)) as decimal(9,4))"),
        ("selic_annual_pct", "cast(8.1 + cast(extract(day from d) as decimal(9,0)) * cast(0.05 as decimal(3,2)) as decimal(9,4))"),
        ("usd_brl", "cast(4.5 + cast(extract(month from d) as decimal(9,0)) * cast(0.1 as decimal(2,1)) as decimal(9,4))"),
        ("eur_brl", "cast((4.5 + cast(extract(month from d) as decimal(9,0)) * cast(0.1 as decimal(2,1))) * 1.09 as decimal(9,4))"),
        ("is_business_day", "dayofweek(d) not in (1, 7)"),
    ),
)
DUCKDB_BUSINESS_DAY = "dayofweek(d) not in (0, 6)"

# Our own schema: one chargeback per transaction whose status is chargeback.
CHARGEBACKS = ViewSpec(
    "chargebacks",
    ("transactions",),
    "transactions",
    (
        ("chargeback_id", "concat('CBK-', transaction_id)"),
        ("transaction_id", "transaction_id"),
        ("opened_at", "cast(transaction_date + 10 as date)"),
        ("reason", "case payment_method when 'credit_card' then 'fraud' when 'debit_card' then 'not_recognized' else 'product_not_received' end"),
        ("amount_brl", "amount_brl"),
    ),
    where="status = 'chargeback'",
)

# Cost inputs for net revenue and acquisition cost (the reference has none).
# Processing cost per approved line item is 10% of its tax amount.
OPERATING_COSTS = ViewSpec(
    "operating_costs",
    ("lineitem", "orders"),
    "(SELECT cast(date_trunc('month', l_shipdate) as date) AS cost_month, "
    "case substring(o_orderpriority,1,1) when '1' then 'credit_card' when '2' then 'debit_card' "
    "when '3' then 'pix' when '4' then 'boleto' else 'ted' end AS payment_method, "
    "cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(9,2)) * cast(0.1 as decimal(2,1)), 2) as decimal(18,2)) AS line_cost "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey) c GROUP BY cost_month, payment_method",
    (
        ("cost_month", "cost_month"),
        ("payment_method", "payment_method"),
        ("cost_brl", "cast(sum(line_cost) as decimal(18,2))"),
    ),
)

# Marketing spend per month is 1% of the month's order value.
MARKETING_COSTS = ViewSpec(
    "marketing_costs",
    ("orders",),
    "(SELECT cast(date_trunc('month', o_orderdate) as date) AS cost_month, "
    "cast(round(cast(o_totalprice as decimal(18,2)) * cast(0.01 as decimal(3,2)), 2) as decimal(18,2)) AS spend "
    "FROM orders) m GROUP BY cost_month",
    (
        ("cost_month", "cost_month"),
        ("cost_brl", "cast(sum(spend) as decimal(18,2))"),
    ),
)

VIEWS: dict[str, ViewSpec] = {
    v.name: v
    for v in (TRANSACTIONS, CUSTOMERS, MERCHANTS, CREDIT_CONTRACTS, DAILY_RATES,
              CHARGEBACKS, OPERATING_COSTS, MARKETING_COSTS)
}
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


# Analysed DataFrames of the (read-only) driver tables and views, per session
# and folder: building them costs footer reads and plan analysis, not data.
_PLAN_CACHE: dict[tuple[str, int, str, str], DataFrame] = {}


class TestCatalog:
    """Name -> lazy DataFrame over one driver folder (the `source()` role)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _cached(self, kind: str, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, id(self.spark), f"{kind}:{self.sf_dir}", name)
        if key not in _PLAN_CACHE:
            _PLAN_CACHE[key] = build()
        return _PLAN_CACHE[key]

    def driver(self, name: str) -> DataFrame:
        return self._cached("driver", name, lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def table(self, name: str) -> DataFrame:
        return self._cached("view", name, lambda: self._build(name))

    def _build(self, name: str) -> DataFrame:
        spec = VIEWS[name]
        # Each view gets its own uniquely named temp views for its inputs, so
        # SQL text resolves without touching the caller's catalog names.
        tag = f"_ll_{abs(hash((self.sf_dir, name))) % 10**8}"
        sql = spec.select_sql()
        for t in spec.tables:
            src = self.table(t) if t in VIEWS else self.driver(t)
            src.createOrReplaceTempView(f"{tag}_{t}")
            sql = _replace_table(sql, t, f"{tag}_{t}")
        return self.spark.sql(sql)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.table(name)
        raise AttributeError(name)


def _replace_table(sql: str, table: str, alias: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN)\s+{table}\b", rf"\1 {alias}", sql)


def duckdb_ctes(names: list[str]) -> str:
    """CTE text defining the named domain views for the DuckDB oracle."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for t in VIEWS[n].tables:
            if t in VIEWS:
                visit(t)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in ordered:
        spec = VIEWS[n]
        sql = spec.select_sql(DUCKDB_BUSINESS_DAY if n == "daily_rates" else None)
        parts.append(f"{n} AS ({sql})")
    return "WITH " + ",\n".join(parts)
