"""Payment and credit-risk formulas as ``Column`` builders.

Every function returns a plain Spark expression, so it folds into whole-stage
codegen and costs nothing extra at any scale. Decimal inputs stay decimal:
rounding is HALF_UP on exact values, never on doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col, lookup

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's rules).
# Risk class by days past due, regulatory scale, inclusive day ranges:
#   0 -> AA; 1-14 -> A; 15-30 -> B; 31-60 -> C; 61-90 -> D; 91-120 -> E;
#   121-150 -> F; 151-180 -> G; anything else (including NULL, < 0) -> H.
RISK_CLASS_BY_DPD = [
    (0, 0, "AA"),
    (1, 14, "A"),
    (15, 30, "B"),
    (31, 60, "C"),
    (61, 90, "D"),
    (91, 120, "E"),
    (121, 150, "F"),
    (151, 180, "G"),
]
RISK_CLASS_FALLBACK = "H"

# Minimum provision rate by risk class.
PROVISION_RATE = {
    "AA": "0.000",
    "A": "0.005",
    "B": "0.010",
    "C": "0.030",
    "D": "0.100",
    "E": "0.300",
    "F": "0.500",
    "G": "0.700",
    "H": "1.000",
}

# Numeric risk level by class (AA lowest).
RISK_LEVEL = {"AA": 0, "A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7, "H": 8}

# Delinquency buckets for regulatory reports, inclusive day ranges.
DPD_BUCKETS = [
    (0, 0, "Adimplente"),
    (1, 30, "1-30 dias"),
    (31, 60, "31-60 dias"),
    (61, 90, "61-90 dias"),
    (91, 180, "91-180 dias (NPL)"),
]
DPD_BUCKET_FALLBACK = ">180 dias (Perda)"

# Blended MDR mix: 60% credit, 25% debit, 15% pix.
BLENDED_MDR_WEIGHTS = ("0.60", "0.25", "0.15")

# Portuguese labels of the payment methods.
PAYMENT_METHOD_LABELS = {
    "credit_card": "Cartão de Crédito",
    "debit_card": "Cartão de Débito",
    "pix": "PIX",
    "boleto": "Boleto",
    "ted": "TED",
}

NPL_THRESHOLD_DAYS = 90
WRITE_OFF_THRESHOLD_DAYS = 180
RECONCILIATION_TOLERANCE_BRL = "0.01"
# ---------------------------------------------------------------------------


def dec(value: str | int, precision: int | None = None, scale: int | None = None) -> Column:
    """Exact decimal literal (never a double)."""
    d = Decimal(str(value))
    if precision is None:
        exp = -d.as_tuple().exponent if d.as_tuple().exponent < 0 else 0
        digits = max(len(d.as_tuple().digits), exp + 1)
        precision, scale = max(digits, 1), exp
    return F.lit(d).cast(f"decimal({precision},{scale})")


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """NULL when the denominator is 0 or NULL (no ANSI error)."""
    return F.try_divide(as_col(num), as_col(den))


def calculate_mdr(gross: ColumnOrName, net: ColumnOrName) -> Column:
    """Merchant discount rate in percent: (gross - net) / gross * 100."""
    g, n = as_col(gross), as_col(net)
    return safe_divide(g - n, g) * dec(100, 3, 0)


def classify_risk_bacen(dpd: ColumnOrName) -> Column:
    """Risk class AA..H from days past due; NULL and negatives land in H."""
    d = as_col(dpd)
    expr = None
    for lo, hi, label in RISK_CLASS_BY_DPD:
        cond = (d == lo) if lo == hi else d.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(RISK_CLASS_FALLBACK)


def provision_rate(risk_class: ColumnOrName) -> Column:
    """Minimum provision rate of a class as DECIMAL(4,3); NULL if unknown."""
    return lookup(as_col(risk_class), {k: dec(v, 4, 3) for k, v in PROVISION_RATE.items()})


def expected_loss(risk_class: ColumnOrName, outstanding: ColumnOrName) -> Column:
    """Provision rate of the (upper-cased) class times the outstanding balance."""
    return provision_rate(F.upper(as_col(risk_class))) * as_col(outstanding)


def risk_level_num(risk_class: ColumnOrName) -> Column:
    """AA=0 .. H=8 as BIGINT, NULL for anything else."""
    return lookup(as_col(risk_class), {k: F.lit(v).cast("bigint") for k, v in RISK_LEVEL.items()})


def risk_level_order(risk_class: ColumnOrName) -> Column:
    """Hidden string sort key '0'..'8' used to order classes AA..H."""
    return lookup(as_col(risk_class), {k: F.lit(str(v)) for k, v in RISK_LEVEL.items()})


def dpd_bucket(dpd: ColumnOrName) -> Column:
    d = as_col(dpd)
    expr = None
    for lo, hi, label in DPD_BUCKETS:
        cond = (d == lo) if lo == hi else d.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DPD_BUCKET_FALLBACK)


def collateral_coverage_ratio(collateral: ColumnOrName, outstanding: ColumnOrName) -> Column:
    return safe_divide(as_col(collateral), as_col(outstanding))


def blended_mdr_pct(credit: ColumnOrName, debit: ColumnOrName, pix: ColumnOrName) -> Column:
    wc, wd, wp = (dec(w, 3, 2) for w in BLENDED_MDR_WEIGHTS)
    return F.round(as_col(credit) * wc + as_col(debit) * wd + as_col(pix) * wp, 4)


def monthly_to_annual_rate(monthly_pct: ColumnOrName) -> Column:
    """Compounded annual rate in percent: ((1 + m/100)^12 - 1) * 100 (DOUBLE)."""
    m = as_col(monthly_pct).cast("double")
    return (F.pow(F.lit(1.0) + m / F.lit(100.0), F.lit(12.0)) - F.lit(1.0)) * F.lit(100.0)


def format_brl(amount: ColumnOrName, decimals: int = 2) -> Column:
    """Numeric rounding for presentation (not text)."""
    return F.round(as_col(amount).cast("decimal(38,9)"), decimals)


def is_npl(dpd: ColumnOrName, threshold_days: int = NPL_THRESHOLD_DAYS) -> Column:
    return as_col(dpd) > F.lit(threshold_days)


def is_written_off_by_rule(dpd: ColumnOrName, threshold_days: int = WRITE_OFF_THRESHOLD_DAYS) -> Column:
    return as_col(dpd) > F.lit(threshold_days)


def mdr_amount(amount: ColumnOrName, rate_pct: ColumnOrName) -> Column:
    """round(amount * rate / 100, 2) in exact decimal arithmetic."""
    return F.round(as_col(amount) * as_col(rate_pct) * dec("0.01", 3, 2), 2).cast("decimal(18,2)")


def net_amount(amount: ColumnOrName, mdr: ColumnOrName) -> Column:
    return (as_col(amount) - as_col(mdr)).cast("decimal(18,2)")


def payment_method_label(method: ColumnOrName) -> Column:
    """Portuguese label; unknown values fall through unchanged."""
    m = as_col(method)
    return lookup(m, {k: F.lit(v) for k, v in PAYMENT_METHOD_LABELS.items()}, default=m)


def unscaled(c: ColumnOrName, scale: int = 2) -> Column:
    """A DECIMAL(p, scale) value as its exact unscaled BIGINT (ANSI raises on overflow).

    A column of finer scale would lose its last digits, so it raises. The type is known
    before the query runs: the condition is folded away and costs nothing per row.
    """
    value = as_col(c)
    exact = F.typeof(value).rlike(rf"^(decimal\(\d+,[0-{scale}]\)|bigint|int|smallint|tinyint|void)$")
    wrong = F.raise_error(F.concat(F.lit(f"more than {scale} decimal places in a "), F.typeof(value)))
    return F.when(exact, (value * dec(10**scale, scale + 1, 0)).cast("bigint")).otherwise(wrong.cast("bigint"))


def from_unscaled(c: ColumnOrName, scale: int = 2) -> Column:
    """Back from an unscaled BIGINT (e.g. its SUM) to DECIMAL(38, scale)."""
    return as_col(c).cast("decimal(38,0)") * dec(f"{10**-scale:.{scale}f}", scale + 1, scale)


def money_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Exact SUM of a DECIMAL(p, scale) column, accumulated as unscaled BIGINT.

    Spark widens sum(decimal(18,2)) to DECIMAL(28,2), whose aggregation buffer
    is a BigDecimal; summing the unscaled value as a long takes
    about two thirds of the time and is exact. Under ANSI mode an overflow (beyond 9.2e18
    units) raises instead of wrapping. Result: DECIMAL(38, scale); NULL when
    every input is NULL, like SUM.
    """
    return from_unscaled(F.sum(unscaled(c, scale)), scale)


COUNT_TYPE = "decimal(20,0)"
MONEY_SUM_TYPE = "decimal(22,2)"


def exact_ratio(num: ColumnOrName, den: ColumnOrName, scale: int, times: int = 1,
                num_type: str = COUNT_TYPE, den_type: str = COUNT_TYPE) -> Column:
    """round(num * times / den, scale), HALF_UP on the exact quotient.

    Operands are cast to narrow decimals first so that Spark's decimal
    division keeps at least 11 fractional digits before the final round;
    a wide operand would cut the quotient to 6 digits and round twice.
    Counts use DECIMAL(20,0), money sums DECIMAL(22,2). NULL when den = 0.
    """
    n = as_col(num).cast(num_type)
    if times != 1:
        n = n * F.lit(times).cast(f"decimal({len(str(abs(times)))},0)")
    return F.round(safe_divide(n, as_col(den).cast(den_type)), scale)


def money_ratio(num: ColumnOrName, den: ColumnOrName, scale: int, times: int = 1) -> Column:
    return exact_ratio(num, den, scale, times, MONEY_SUM_TYPE, MONEY_SUM_TYPE)


def money_per_count(num: ColumnOrName, den: ColumnOrName, scale: int) -> Column:
    return exact_ratio(num, den, scale, 1, MONEY_SUM_TYPE, COUNT_TYPE)
