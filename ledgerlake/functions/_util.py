from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, mapping: dict[str, Column], default: Column | None = None) -> Column:
    """Simple CASE key WHEN k THEN v ... as a foldable ``when`` chain."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), v) if expr is None else expr.when(key == F.lit(k), v)
    return expr if default is None else expr.otherwise(default)
