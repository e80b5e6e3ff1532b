"""Typed scans: CSV with a fixed schema, quarantine of bad rows, JDBC options.

Schemas are never inferred (an inference pass reads the data twice and
guesses types); every raw table has its ``StructType`` in ``schemas``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_TABLES
from .sinks import _file_system

CORRUPT_COLUMN = "_corrupt_record"


class RequiredColumnError(ValueError):
    """A REQUIRED column holds NULL: the load fails."""


def _whole_rows(df: DataFrame) -> DataFrame:
    """Every column of every row is parsed, whatever columns a plan needs.

    The CSV reader converts requested fields only, so a count would never meet a
    bad amount. The condition always holds, but reads all fields.
    """
    return df.where(F.xxhash64(*[F.col(c) for c in df.columns if c != CORRUPT_COLUMN]) >= F.lit(-(1 << 63)))


PASS_BYTES = 1 << 30  # of text that a load takes in at once, a core
PACKED_TEXT = 6  # bytes of text that a byte of a compressed file stands for, about
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def csv_passes(spark: SparkSession, path: str, pass_bytes: int | None = None) -> list[list[str]]:
    """The files of a CSV folder in passes of ``pass_bytes`` of text: what a load shuffles at once follows the cluster, not the table.

    A folder of one pass, or of more than plain files, is given as it is.
    """
    limit = pass_bytes or PASS_BYTES * spark.sparkContext.defaultParallelism
    _, folder, fs = _file_system(spark, path)
    if not fs.exists(folder):
        return [[path]]
    found = sorted((s for s in fs.listStatus(folder) if not s.getPath().getName().startswith(("_", "."))), key=lambda s: s.getPath().getName())
    if any(s.isDirectory() or set(s.getPath().getName()) & set("*?[]{}\\") for s in found):
        return [[path]]
    passes, held = [], limit
    for s in found:
        name, size = str(s.getPath()), s.getLen() * (PACKED_TEXT if s.getPath().getName().endswith(_PACKED) else 1)
        if held + size > limit:
            passes.append([])
            held = 0
        passes[-1].append(name)
        held += size
    return passes if len(passes) > 1 else [[path]]


def read_typed_csv(spark: SparkSession, path: str | Sequence[str], table: str, *, mode: str = "FAILFAST",
                   schema: T.StructType | None = None) -> DataFrame:
    """Header skipped, fixed schema; in FAILFAST any bad row fails the read."""
    return _whole_rows(
        spark.read.option("header", True)
        .option("mode", mode)
        .option("multiLine", False)
        .schema(schema or RAW_TABLES[table].schema)
        .csv(path if isinstance(path, str) else list(path))
    )


def required_violations(df: DataFrame, table: str) -> DataFrame:
    """One row: NULL count per REQUIRED column (a single aggregate pass)."""
    req = RAW_TABLES[table].required
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req])


def check_required(df: DataFrame, table: str) -> None:
    """Raise if a REQUIRED column has NULLs (Spark's CSV reader keeps every
    field nullable, so the guard is an explicit check)."""
    raise_required(table, required_violations(df, table).first().asDict())


def raise_required(table: str, nulls: Mapping[str, int]) -> None:
    """Raise if any NULL count of a REQUIRED column is positive."""
    bad = {k: v for k, v in nulls.items() if v}
    if bad:
        raise RequiredColumnError(f"{table}: NULL in required column(s) {bad}")


def read_with_quarantine(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE read split into (good rows, quarantined rows).

    A row is quarantined when it does not parse against the schema or a
    REQUIRED column is NULL. The quarantine keeps the raw line text.
    """
    spec = RAW_TABLES[table]
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in spec.schema.fields],
                           T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    raw = _whole_rows(
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .schema(schema)
        .csv(path)
    )
    missing_key = F.lit(False)
    for c in spec.required:
        missing_key = missing_key | F.col(c).isNull()
    bad = F.col(CORRUPT_COLUMN).isNotNull() | missing_key
    good = raw.where(~bad).drop(CORRUPT_COLUMN)
    quarantine = raw.where(bad).select(
        F.lit(table).alias("table_name"),
        F.when(F.col(CORRUPT_COLUMN).isNotNull(), "parse_error").otherwise("missing_required").alias("reason"),
        F.coalesce(F.col(CORRUPT_COLUMN), F.to_json(F.struct(*[F.col(f.name) for f in spec.schema.fields])))
        .alias("raw_record"),
    )
    return good, quarantine


def with_loaded_at(df: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Stamp the load time used by the freshness check."""
    return df.withColumn("_loaded_at", F.lit(load_ts).cast("timestamp"))


def jdbc_options(url: str, table: str, *, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3: options for a parallel JDBC scan (one range query per partition)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower/upper bounds and num_partitions")
        opts |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                 "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
    return opts | dict(extra or {})


ROWS_PER_READ = 1_000_000
MAX_READS = 2_000  # connections that one scan opens over its life, not at once


@dataclass(frozen=True)
class SourceStats:
    """What a source says about a numeric or date column: least and greatest value, rows, rows without a value."""

    low: int | dt.date | dt.datetime | None
    high: int | dt.date | dt.datetime | None
    rows: int
    nulls: int = 0


def stats_query(table: str, column: str) -> str:
    """S3: one row of statistics, computed by the source from its index or catalog."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT(*) AS row_count, COUNT(*) - COUNT({column}) AS nulls FROM {table}"


def plan_ranges(column: str, stats: SourceStats, *, rows_per_read: int = ROWS_PER_READ, max_reads: int = MAX_READS) -> list[str]:
    """S3: predicates that cut a table into ranges of about ``rows_per_read`` rows.

    Every row fulfils exactly one of them: ranges are half-open, the first and the last are open-ended (rows
    that came after the statistics are read too), and rows without a value have one of their own.
    A table of one read, or of one value, gives a single predicate.
    """
    if stats.rows <= 0 or stats.low is None:
        return ["1 = 1"]
    reads = min(max_reads, max(1, -(-(stats.rows - stats.nulls) // rows_per_read)))
    low, high = stats.low, stats.high
    if isinstance(low, dt.datetime):
        unit, text = dt.timedelta(seconds=1), lambda v: f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    elif isinstance(low, dt.date):
        unit, text = dt.timedelta(days=1), lambda v: f"DATE '{v:%Y-%m-%d}'"
    else:
        unit, text = 1, str
    steps = (high - low) // unit + 1
    reads = min(reads, steps)
    cuts = [(steps * k) // reads for k in range(1, reads)]
    marks = [text(low + unit * c) for c in cuts]
    if not marks:
        return ["1 = 1"]
    ranges = [f"{column} < {marks[0]}", *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks[:-1], marks[1:], strict=True)], f"{column} >= {marks[-1]}"]
    return [*ranges, f"{column} IS NULL"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, column: str, *, properties: Mapping[str, str] | None = None,
                     rows_per_read: int = ROWS_PER_READ, stats: SourceStats | None = None) -> DataFrame:
    """S3: the whole table as one task per range, planned from the source's own statistics (needs a reachable database)."""
    if stats is None:
        row = spark.read.format("jdbc").options(url=url, query=stats_query(table, column), **dict(properties or {})).load().first()
        stats = SourceStats(*row)
    return spark.read.jdbc(url, table, predicates=plan_ranges(column, stats, rows_per_read=rows_per_read), properties=dict(properties or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """S3: full-table scan of a relational source (needs a reachable database)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


def source_row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (no driver round trip of rows)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
