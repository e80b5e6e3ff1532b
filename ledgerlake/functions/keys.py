"""Surrogate keys and value formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col

# NULL marker and separator of the common surrogate-key recipe
# (md5 over '-'-joined text, NULL replaced by the marker).
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def surrogate_key(*cols: ColumnOrName) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


# Presentation formats of the semantic layer.
#   brazilian_real  "R$" #,##0.00      percentage_2dp 0.00"%"
#   large_brl       "R$" #,##0,,"M"    billions       "R$" #,##0,,,"B"
#   ratio           0.00"x"            percentage_3dp 0.000"%"   decimal_0 #,##0
VALUE_FORMATS = {
    "brazilian_real": ("R$ ", 1, 2, ""),
    "large_brl": ("R$ ", 1_000_000, 0, "M"),
    "billions_brl": ("R$ ", 1_000_000_000, 0, "B"),
    "percentage_2dp": ("", 1, 2, "%"),
    "percentage_3dp": ("", 1, 3, "%"),
    "ratio_2dp": ("", 1, 2, "x"),
    "decimal_0": ("", 1, 0, ""),
}


def format_value(c: ColumnOrName, fmt: str) -> Column:
    """Optional presentation column, e.g. 'R$ 1,234.50' or '12.34%'."""
    prefix, scale, decimals, suffix = VALUE_FORMATS[fmt]
    v = as_col(c).cast("decimal(38,6)")
    if scale != 1:
        v = v / F.lit(scale)
    return F.concat(F.lit(prefix), F.format_number(v, decimals), F.lit(suffix))
