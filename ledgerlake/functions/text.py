"""Text cleanup and personal-data masking as ``Column`` builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col

# Mask layouts (kept text around the visible characters).
#   cnpj         -> first 2 + ".***.***/" + last 6
#   cpf          -> first 3 + ".***.***-**"
#   bank_account -> "****" + last 4
#   email        -> first 2 + "***@***.**"
#   phone        -> first 4 + "****" + last 4
#   anything else -> SHA-256 hex of the text
MASK_TYPES = ("cnpj", "cpf", "bank_account", "email", "phone", "default")


def clean(c: ColumnOrName) -> Column:
    """TRIM only; '' stays '' (it is not turned into NULL)."""
    return F.trim(as_col(c))


def clean_lower(c: ColumnOrName) -> Column:
    return F.lower(F.trim(as_col(c)))


def clean_upper(c: ColumnOrName) -> Column:
    return F.upper(F.trim(as_col(c)))


def _left(s: Column, n: int) -> Column:
    return F.left(s, F.lit(n))


def _right(s: Column, n: int) -> Column:
    return F.right(s, F.lit(n))


def mask_pii(c: ColumnOrName, mask_type: str = "default") -> Column:
    """Mask a personal-data column; NULL in gives NULL out for every type."""
    s = as_col(c).cast("string")
    if mask_type == "cnpj":
        return F.concat(_left(s, 2), F.lit(".***.***/"), _right(s, 6))
    if mask_type == "cpf":
        return F.concat(_left(s, 3), F.lit(".***.***-**"))
    if mask_type == "bank_account":
        return F.concat(F.lit("****"), _right(s, 4))
    if mask_type == "email":
        return F.concat(_left(s, 2), F.lit("***@***.**"))
    if mask_type == "phone":
        return F.concat(_left(s, 4), F.lit("****"), _right(s, 4))
    return F.sha2(s, 256)
