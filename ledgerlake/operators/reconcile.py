"""Financial reconciliation and old-vs-new comparisons.

All comparisons are joins of *aggregates* (day, month, key) or a full outer
join on a key; nothing is collected. ``assert_passed`` is the blocking gate
that stops a pipeline after the check results have been written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money_sum
from ..functions._util import ColumnOrName, as_col
from ..functions.finance import RECONCILIATION_TOLERANCE_BRL


def _tol(tolerance: str) -> Column:
    return F.lit(str(tolerance)).cast("decimal(18,6)")


def financial_reconciliation(df: DataFrame, model: str, col_a: ColumnOrName, col_b: ColumnOrName,
                             tolerance: str = RECONCILIATION_TOLERANCE_BRL,
                             a_name: str | None = None, b_name: str | None = None) -> DataFrame:
    """Rows with abs(a - b) > tolerance (one summary row)."""
    diverges = F.abs(as_col(col_a) - as_col(col_b)) > _tol(tolerance)
    return df.agg(
        F.count_if(diverges).cast("bigint").alias("divergent_rows"),
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
    ).select(
        F.lit(model).alias("model"),
        F.lit(a_name or str(col_a)).alias("column_a"),
        F.lit(b_name or str(col_b)).alias("column_b"),
        _tol(tolerance).cast("double").alias("tolerance"),
        "divergent_rows",
        "total_rows",
        F.when(F.col("divergent_rows") > 0, "error").otherwise("pass").alias("status"),
    )


def tpv_daily_reconciliation(mart: DataFrame, stg_transactions: DataFrame,
                             tolerance: str = RECONCILIATION_TOLERANCE_BRL) -> DataFrame:
    """Mart TPV vs TPV recomputed from staging, both at day grain.

    The mart is date x payment method, so it is rolled up to the day before
    the join (joining it to a per-day total directly would compare one
    method's TPV to the whole day). Full outer join on the day: a day that one
    side lacks, or holds without a sum, diverges. ``status`` is what the gate reads.
    """
    mart_day = mart.groupBy("summary_date").agg(F.sum("total_tpv_brl").alias("mart_tpv"))
    source_day = (
        stg_transactions.where(F.col("status") == "approved")
        .groupBy(F.to_date("transaction_date").alias("summary_date"))
        .agg(money_sum("amount_brl").alias("source_tpv"))
    )
    # A day without any approved transaction is on the mart's side only, with a sum of 0.
    zero = F.lit(0).cast("decimal(38,2)")
    present = F.col("_mart").isNotNull() & (F.col("_source").isNotNull() | (F.col("mart_tpv") == zero))
    div = F.abs(F.coalesce("mart_tpv", zero) - F.coalesce("source_tpv", zero))
    divergent = ~present | (div > _tol(tolerance))
    both = mart_day.withColumn("_mart", F.lit(1)).join(source_day.withColumn("_source", F.lit(1)), "summary_date", "full_outer")
    return both.select(
        "summary_date", "mart_tpv", "source_tpv", div.alias("divergence_brl"), divergent.alias("is_divergent"),
        F.when(divergent, "error").otherwise("pass").alias("status"),
    )


def compare_row_counts(old: DataFrame, new: DataFrame, table_name: str, period: ColumnOrName) -> DataFrame:
    """Row counts per period in the old and new system, full outer joined."""
    p = as_col(period)
    o = old.groupBy(p.alias("period")).agg(F.count(F.lit(1)).alias("old_rows"))
    n = new.groupBy(p.alias("period")).agg(F.count(F.lit(1)).alias("new_rows"))
    zero = F.lit(0).cast("bigint")
    old_rows, new_rows = F.coalesce("old_rows", zero), F.coalesce("new_rows", zero)
    return o.join(n, "period", "full_outer").select(
        F.lit(table_name).alias("table_name"),
        "period",
        old_rows.alias("old_rows"),
        new_rows.alias("new_rows"),
        (new_rows - old_rows).alias("row_diff"),
        F.when(old_rows == new_rows, "match").otherwise("mismatch").alias("status"),
    )


def _digest(c: str, side: Column) -> list[Column]:
    """Order-free digest of a column: the two halves of its rows' hashes, added for one side and taken off for the other.

    Both sums are 0 if and only if (but for a chance of 2**-64) both sides hold the same values, each as often.
    Halves of 32 bits cannot overflow a BIGINT below 2**31 rows a key.
    """
    h = F.xxhash64(F.col(c), F.col(c).isNull())
    return [F.sum(side * F.shiftright(h, 32)).alias(f"_hi_{c}"), F.sum(side * h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias(f"_lo_{c}")]


def compare_relations(a: DataFrame, b: DataFrame, keys: Sequence[str],
                      compare: Sequence[str] | None = None) -> DataFrame:
    """Per key: only_in_a / only_in_b / changed / same / duplicate_key.

    Rows of both sides meet in one hash aggregate by key, which counts them and adds up a digest of
    each compared column (``_digest``): no values are shuffled twice, nothing is sorted or
    joined, and rows are combined before the exchange, so a key repeated on both sides neither
    multiplies into pairs nor fills a task; it is reported as ``duplicate_key``. ``changed_columns``
    lists the columns whose values differ (of a repeated key: differ as a collection). A key with a NULL
    part matches nothing on the other side, as in a join.
    """
    keys = list(keys)
    compare = list(compare) if compare is not None else [c for c in a.columns if c not in keys]
    side = F.col("_side")
    rows = a.select(*keys, *compare, F.lit(1).cast("bigint").alias("_side")).unionByName(
        b.select(*keys, *compare, F.lit(-1).cast("bigint").alias("_side")))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    apart = F.when(null_key, side).otherwise(F.lit(0).cast("bigint"))
    digests = [d for c in compare for d in _digest(c, side)]
    j = rows.groupBy(*keys, apart.alias("_apart")).agg(
        F.count_if(side == 1).alias("_n_a"), F.count_if(side == -1).alias("_n_b"), *digests)
    changed = F.concat_ws(",", *[F.when((F.col(f"_hi_{c}") != 0) | (F.col(f"_lo_{c}") != 0), F.lit(c)) for c in compare]) if compare else F.lit("")
    both = (F.col("_n_a") > 0) & (F.col("_n_b") > 0)
    status = (
        F.when(F.col("_n_a") == 0, "only_in_b")
        .when(F.col("_n_b") == 0, "only_in_a")
        .when((F.col("_n_a") > 1) | (F.col("_n_b") > 1), "duplicate_key")
        .when(changed != "", "changed")
        .otherwise("same")
    )
    return j.select(*keys, status.alias("status"), F.when(both, changed).alias("changed_columns"))


def relation_diff_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keyless comparison: rows of A missing in B and the reverse (multiset)."""
    only_a = a.exceptAll(b).agg(F.count(F.lit(1)).alias("n")).select(F.lit("only_in_a").alias("side"), "n")
    only_b = b.exceptAll(a).agg(F.count(F.lit(1)).alias("n")).select(F.lit("only_in_b").alias("side"), "n")
    return only_a.unionByName(only_b)


class CheckFailed(RuntimeError):
    """Raised by the blocking gate when a reconciliation check fails."""


def assert_passed(results: DataFrame, status_col: str = "status", failing: Sequence[str] = ("error",)) -> None:
    """Blocking gate: raise if any result row has a failing status.

    Reads back only the count of failing rows (one number), never the data.
    """
    bad = results.where(F.col(status_col).isin(list(failing))).count()
    if bad:
        raise CheckFailed(f"{bad} failing check row(s)")
