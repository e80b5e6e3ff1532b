"""Latest-row-per-key deduplication (the intermediate layer's job).

``latest_per_key`` ranks rows in a window and keeps the first; Spark limits the groups before
the shuffle already, so each task sends at most one row a key and a hot key costs one row a task. One
scan, one exchange. It needs a sort of each task's rows by the key.

``dedup_latest`` gives the same rows without sorting the input, for few and very large groups.
It is written as aggregates, not a window, so that a key holding a third of all rows
never lands whole in one task. First the greatest ordering value of each key
is found by a hash aggregate on that column alone (partially aggregated, no
sort). Rows that hold it, about one a key, are then reduced by
``max(struct(...))``, which decides ties by all other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order_by`` values.

    NULL ordering values lose against non-NULL ones (latest = NULLS LAST).
    Remaining columns break ties (greatest wins), making the pick stable.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    # Keys may be NULL and so may the ordering value: both sides are compared NULL-safely.
    head = order_by[0]
    top = df.groupBy(*keys).agg(F.max(head).alias("_top")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_top")
    match = F.col(head).eqNullSafe(F.col("_top"))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    latest = df.join(top, match, "left_semi")
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    fields += [F.col(c).alias(f"p{i}") for i, c in enumerate(rest)]
    best = latest.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_best"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"_best.o{i}").alias(c) for i, c in enumerate(order_by)]
    out += [F.col(f"_best.p{i}").alias(c) for i, c in enumerate(rest)]
    return best.select(*out).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The same choice as ``dedup_latest`` by ``row_number() = 1``.

    NULL keys form a group of their own; NULL ordering values come last; the other columns
    decide ties, greatest first, so that equal input gives equal output.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in [*order_by, *rest]])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
