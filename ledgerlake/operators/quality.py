"""Data-quality checks (not_null, unique, accepted values, expressions,
sum / proportion ranges, freshness, foreign-key coverage).

Row-level checks on one table compile into ONE aggregate: every check is a
``count_if`` in the same ``agg`` (partial per task, a one-row exchange), so
ten checks cost one scan. Only key checks (unique, proportion of unique,
foreign keys) need a shuffle by key. Results never leave the cluster: each
check yields a row (table_name, check_name, column_name, failing_rows,
total_rows, status) in a small DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_ratio
from ..functions._util import ColumnOrName, as_col
from ..schemas import RAW_TABLES

RESULT_COLUMNS = ["table_name", "check_name", "column_name", "failing_rows", "total_rows", "status"]


@dataclass(frozen=True)
class RowCheck:
    """A per-row predicate; ``fails`` is TRUE on a failing row (NULL = pass)."""

    check_name: str
    column_name: str
    fails: Column
    severity: str = "error"


def not_null(c: str) -> RowCheck:
    return RowCheck("not_null", c, F.col(c).isNull())


def accepted_values(c: str, values: Sequence[str]) -> RowCheck:
    """Values outside the list fail; NULL passes."""
    return RowCheck("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(values)))


def expression_is_true(c: str, expr: Column, label: str = "expression_is_true") -> RowCheck:
    """Rows where ``expr`` is FALSE fail; NULL results are not counted."""
    return RowCheck(label, c, ~expr)


def in_range(c: str, low, high, label: str = "in_range") -> RowCheck:
    return RowCheck(label, c, ~F.col(c).between(low, high))


def reconciles(col_a: ColumnOrName, col_b: ColumnOrName, tolerance: str = "0.01",
               label: str = "financial_reconciliation", name: str | None = None) -> RowCheck:
    """abs(a - b) > tolerance fails (the reconciliation macro, row form)."""
    diff = F.abs(as_col(col_a) - as_col(col_b))
    return RowCheck(label, name or str(col_a), diff > F.lit(tolerance).cast("decimal(18,6)"))


def run_row_checks(df: DataFrame, table_name: str, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks of one table in a single aggregate, one row per check."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(c.fails).alias(f"_c{i}") for i, c in enumerate(checks)]
    one_row = df.agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(c.check_name).alias("check_name"),
            F.lit(c.column_name).alias("column_name"),
            F.col(f"_c{i}").cast("bigint").alias("failing_rows"),
            F.lit(c.severity).alias("_severity"),
        )
        for i, c in enumerate(checks)
    ])
    out = one_row.select(F.inline(rows), F.col("_total").cast("bigint").alias("total_rows"))
    return out.select(
        *RESULT_COLUMNS[:4], "total_rows",
        F.when(F.col("failing_rows") > 0, F.col("_severity")).otherwise(F.lit("pass")).alias("status"),
    )


def source_row_checks(table: str, as_of: dt.date | str | None = None) -> list[RowCheck]:
    """The checks declared on a raw source (key not_null + accepted values),
    plus the staging expectations on transactions."""
    spec = RAW_TABLES[table]
    checks = [not_null(spec.key)]
    if table == "transactions":
        checks += [not_null("amount_brl"), expression_is_true("amount_brl", F.col("amount_brl") > 0)]
    checks += [accepted_values(c, v) for c, v in spec.accepted.items()]
    if table == "transactions":
        checks.append(not_null("transaction_date"))
        if as_of is not None:
            checks.append(expression_is_true(
                "transaction_date", F.col("transaction_date") <= F.lit(as_of).cast("date")))
        checks.append(reconciles("amount_brl", F.col("mdr_amount_brl") + F.col("net_amount_brl"),
                                 label="debit_equals_credit", name="amount_brl"))
        checks.append(in_range("mdr_rate_pct", F.lit(0), F.lit(10), label="mdr_rate_range"))
    return checks


def unique(df: DataFrame, table_name: str, key: str | Sequence[str]) -> DataFrame:
    """Key values (non-NULL) that occur more than once; one result row.

    One scan and one shuffle: rows are counted per key, partially before the
    shuffle, so a repeated key is one row per task. Keys with a NULL part
    count towards the total only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    key_present = F.lit(True)
    for k in keys:
        key_present = key_present & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    both = per_key.agg(F.count_if(key_present & (F.col("_n") > 1)).cast("bigint").alias("failing_rows"),
                       F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"))
    return both.select(
        F.lit(table_name).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(",".join(keys)).alias("column_name"),
        "failing_rows",
        "total_rows",
        F.when(F.col("failing_rows") > 0, "error").otherwise("pass").alias("status"),
    )


def proportion_of_unique(df: DataFrame, table_name: str, column: str,
                         min_value: float | None = None, max_value: float | None = None,
                         approximate: bool = False) -> DataFrame:
    """distinct(column) / rows within [min, max]; one row."""
    distinct = (F.approx_count_distinct(column) if approximate else F.count_distinct(column))
    row = df.agg(distinct.cast("bigint").alias("distinct_values"), F.count(F.lit(1)).cast("bigint").alias("total_rows"))
    prop = exact_ratio("distinct_values", "total_rows", 6)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & (prop >= F.lit(str(min_value)).cast("decimal(12,6)"))
    if max_value is not None:
        ok = ok & (prop <= F.lit(str(max_value)).cast("decimal(12,6)"))
    return row.select(
        F.lit(table_name).alias("table_name"),
        F.lit(column).alias("column_name"),
        "distinct_values",
        "total_rows",
        prop.alias("proportion"),
        F.when(ok, "pass").otherwise("error").alias("status"),
    )


def sum_between(df: DataFrame, table_name: str, column: str, min_value, max_value,
                group_by: Sequence[str] = ()) -> DataFrame:
    """Column sum within [min, max], for the whole table or per group.

    One row: grain, groups, failing_groups, min_sum, max_sum, status. The
    per-group form aggregates first (partial, one shuffle by the group
    keys) and then summarises the group sums in one more tiny aggregate.
    """
    lo, hi = F.lit(str(min_value)).cast("decimal(38,2)"), F.lit(str(max_value)).cast("decimal(38,2)")
    sums = (df.groupBy(*group_by) if group_by else df.groupBy()).agg(F.sum(column).alias("_s"))
    return sums.agg(
        F.count(F.lit(1)).cast("bigint").alias("groups"),
        F.count_if(F.col("_s").isNull() | ~F.col("_s").between(lo, hi)).cast("bigint").alias("failing_groups"),
        F.min("_s").alias("min_sum"),
        F.max("_s").alias("max_sum"),
    ).select(
        F.lit(table_name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(",".join(group_by) if group_by else "table").alias("grain"),
        "groups",
        "failing_groups",
        "min_sum",
        "max_sum",
        F.when(F.col("failing_groups") > 0, "error").otherwise("pass").alias("status"),
    )


FRESHNESS_WARN_HOURS = 25
FRESHNESS_ERROR_HOURS = 49


def freshness(df: DataFrame, source_name: str, loaded_at: str, now: dt.datetime | str,
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """max(loaded_at) against an injected ``now``: pass / warn / error."""
    now_ts = F.lit(now).cast("timestamp")
    latest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("_max"))
    age = (F.unix_seconds(now_ts) - F.unix_seconds(F.col("_max"))).cast("bigint")
    return latest.select(
        F.lit(source_name).alias("source_name"),
        F.col("_max").alias("max_loaded_at"),
        age.alias("age_seconds"),
        exact_ratio(age, F.lit(3600), 2).alias("age_hours"),
        F.when(F.col("_max").isNull(), "error")
        .when(age > error_hours * 3600, "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass").alias("status"),
    )


def _coverage(per_key: DataFrame, child_name: str, fk: str, parent: DataFrame, parent_name: str,
              pk: str) -> DataFrame:
    """Orphan rows from per-key row counts (``_k``, ``_n``) of the child."""
    keys = parent.select(F.col(pk).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    joined = per_key.join(keys, "_k", "left")
    orphan = F.col("_k").isNotNull() & F.col("_hit").isNull()
    return joined.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
    ).select(
        F.lit(child_name).alias("child_table"),
        F.lit(fk).alias("fk_column"),
        F.lit(parent_name).alias("parent_table"),
        "orphan_rows",
        "total_rows",
        F.when(F.col("orphan_rows") > 0, "error").otherwise("pass").alias("status"),
    )


def fk_coverage(child: DataFrame, child_name: str, fk: str,
                parent: DataFrame, parent_name: str, pk: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent row; one result row.

    The child is first reduced to one row per foreign-key value (a partial
    aggregate, so a key holding a third of the rows collapses inside each
    task and the shuffle carries distinct keys, not rows). Parent keys are
    de-duplicated, so the left join cannot fan out; AQE broadcasts them when
    they turn out small and sort-merges otherwise.
    """
    per_key = child.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return _coverage(per_key, child_name, fk, parent, parent_name, pk)


def fk_coverage_many(child: DataFrame, child_name: str,
                     refs: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Several foreign keys of one child table: (fk, parent, parent_name, pk).

    One pass over the child: a grouping-sets aggregate counts rows per value
    of every foreign key (tagged with the key's index), one left join checks
    them against the tagged, de-duplicated union of the parents' keys, and one
    final aggregate per index yields orphan and total rows. Keys are compared
    as text.
    """
    fks = [r[0] for r in refs]
    per_fk = child.groupingSets([[fk] for fk in fks], *fks).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(fk).alias(f"_g{i}") for i, fk in enumerate(fks)])
    index = None
    for i in range(len(fks)):
        index = (F.when(F.col(f"_g{i}") == 0, F.lit(i)) if index is None
                 else index.when(F.col(f"_g{i}") == 0, F.lit(i)))
    per_key = per_fk.select(index.alias("_i"), F.coalesce(*[F.col(fk).cast("string") for fk in fks]).alias("_k"), "_n")
    parents = None
    for i, (_, parent, _, pk) in enumerate(refs):
        p = parent.select(F.lit(i).alias("_i"), F.col(pk).cast("string").alias("_k"))
        parents = p if parents is None else parents.unionByName(p)
    hits = parents.distinct().withColumn("_hit", F.lit(True))
    orphan = F.col("_k").isNotNull() & F.col("_hit").isNull()
    per_index = per_key.join(hits, ["_i", "_k"], "left").groupBy("_i").agg(
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
    )

    # a child without rows still gets its result rows
    spark = child.sparkSession
    none = spark.range(len(refs)).select(F.col("id").cast("int").alias("_i"), F.lit(0).cast("bigint").alias("orphan_rows"),
                                         F.lit(0).cast("bigint").alias("total_rows"))
    per_index = per_index.unionByName(none).groupBy("_i").agg(F.sum("orphan_rows").alias("orphan_rows"),
                                                             F.sum("total_rows").alias("total_rows"))

    def label(pos: int) -> Column:
        expr = None
        for i, r in enumerate(refs):
            expr = (F.when(F.col("_i") == i, F.lit(r[pos])) if expr is None
                    else expr.when(F.col("_i") == i, F.lit(r[pos])))
        return expr

    return per_index.select(
        F.lit(child_name).alias("child_table"),
        label(0).alias("fk_column"),
        label(2).alias("parent_table"),
        "orphan_rows",
        "total_rows",
        F.when(F.col("orphan_rows") > 0, "error").otherwise("pass").alias("status"),
    )


def fk_coverage_all(refs: Sequence[tuple[DataFrame, str, str, str]], parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """All foreign keys of a schema at once: refs are (child, child name, fk, parent name), parents are name -> (table, pk).

    Every table is scanned once, whatever it is child or parent of: a row gives one narrow row per key it
    holds, (parent, key, role). One hash aggregate by (parent, key) counts them per foreign key and
    notes whether the parent has the key, so there is no join, and a key that holds a third
    of the rows is counted in the tasks before the only shuffle. Keys are compared as text; a NULL key
    counts towards the total only. Every foreign key has a result row, also of an empty child.
    """
    names = list(parents)
    tables: list[tuple[DataFrame, list[Column]]] = []

    def role(df: DataFrame, parent: str, key: str, ref: int) -> None:
        held = F.struct(F.lit(names.index(parent)).alias("parent"), F.col(f"`{key}`").cast("string").alias("key"), F.lit(ref).alias("ref"))
        for known, roles in tables:
            if known is df:
                roles.append(held)
                return
        tables.append((df, [held]))

    for name, (df, pk) in parents.items():
        role(df, name, pk, -1)
    for i, (df, _, fk, parent) in enumerate(refs):
        role(df, parent, fk, i)
    keys = None
    for df, roles in tables:
        part = df.select(F.inline(F.array(*roles)))
        keys = part if keys is None else keys.unionByName(part)
    per_key = keys.groupBy("parent", "key").agg(
        F.max((F.col("ref") == -1).cast("int")).alias("_hit"), *[F.count_if(F.col("ref") == i).alias(f"_n{i}") for i in range(len(refs))])
    orphan = F.col("key").isNotNull() & (F.col("_hit") == 0)
    sums = per_key.agg(*[a for i in range(len(refs)) for a in (
        F.coalesce(F.sum(F.when(orphan, F.col(f"_n{i}"))), F.lit(0)).cast("bigint").alias(f"_o{i}"),
        F.coalesce(F.sum(f"_n{i}"), F.lit(0)).cast("bigint").alias(f"_t{i}"))])
    rows = sums.select(F.inline(F.array(*[F.struct(
        F.lit(child).alias("child_table"), F.lit(fk).alias("fk_column"), F.lit(parent).alias("parent_table"),
        F.col(f"_o{i}").alias("orphan_rows"), F.col(f"_t{i}").alias("total_rows")) for i, (_, child, fk, parent) in enumerate(refs)])))
    return rows.withColumn("status", F.when(F.col("orphan_rows") > 0, "error").otherwise("pass"))
