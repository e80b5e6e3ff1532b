"""Normalise result types at the query edge for cross-engine comparison.

Inside the library money stays DECIMAL. At the edge of a registered query,
exact decimals become DOUBLE (a correctly rounded conversion of the same
exact value on both engines), small integers become BIGINT, and dates and
timestamps become ISO text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_edge(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
