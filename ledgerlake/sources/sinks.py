"""Sinks: CSV, truncate-and-load tables, day-partitioned and clustered layout,
dynamic partition overwrite, retention, and row counts observed on the write.

Layout for a partitioned table: rebalance on the day (AQE sizes the write
tasks and splits a day holding a third of all rows), then sort within each
task so parquet row groups carry tight min/max statistics for the cluster
columns (block skipping). See ``clustered``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 5_000_000
PACKED_RECORDS_PER_FILE = 1_000_000  # of a compressed CSV file, which one task reads


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int
    nulls: dict[str, int] = field(default_factory=dict)  # of the columns asked for


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str | None = None) -> bool:
    """CSV with header, compressed if a codec is named; an empty input is skipped (returns False).

    An overwrite computes the input once: rows are counted as they are written beside ``path``, and moved there if there are any.
    """
    packed = {"compression": compression, "maxRecordsPerFile": PACKED_RECORDS_PER_FILE} if compression else {}
    if mode != "overwrite":
        if df.isEmpty():
            return False
        df.write.mode(mode).option("header", True).options(**packed).csv(path)
        return True
    staged, obs = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}", Observation(f"csv-{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("header", True).options(**packed).csv(staged)
    if not int(obs.get["rows"]):
        _, folder, fs = _file_system(df.sparkSession, staged)
        fs.delete(folder, True)
        return False
    move_into_place(df.sparkSession, staged, path)
    return True


def clustered(df: DataFrame, partition_by: str | None, cluster_by: Sequence[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    """Balanced, sorted layout for the write.

    Day-partitioned tables use the REBALANCE hint on the partition column:
    AQE sizes the write tasks at runtime (advisory partition size), splits a
    day that holds a third of all rows into several tasks and coalesces small
    days, with no sampling pass. Tables without a partition column are
    range-partitioned on the cluster columns, so every file covers a
    disjoint key range (file-level min/max skipping). Rows are then sorted
    within each task for tight row-group statistics. ``num_partitions`` pins
    the task count instead (no adaptive resizing).
    """
    keys = ([partition_by] if partition_by else []) + list(cluster_by)
    if not keys:
        return df
    if num_partitions is not None:
        out = df.repartitionByRange(num_partitions, *keys)
    elif partition_by:
        out = df.hint("rebalance", partition_by)
    else:
        # A cluster value that holds much of the table is spread by the rows' hash within its range.
        return df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    return out.sortWithinPartitions(*keys)


def spread(df: DataFrame, partition_by: str) -> DataFrame:
    """Layout for few bytes in many day folders (a daily mart, a micro-batch).

    Such a write costs by the folder, not by the byte, but AQE would coalesce it by bytes into one task
    that creates every file in turn; here the days are dealt over all cores. Pass ``arrange=False`` on.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, partition_by)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: str | None = None,
                cluster_by: Sequence[str] = (), dynamic: bool = False, fmt: str = "parquet",
                num_partitions: int | None = None, count_nulls: Sequence[str] = (),
                arrange: bool = True, compression: str | None = None) -> WriteResult:
    """Write a table and return the rows written.

    The row count, and NULLs of ``count_nulls``, are observed during the write (no second scan). With
    ``dynamic=True`` only the partitions present in ``df`` are replaced.
    ``arrange=False`` writes the partitions of ``df`` as they are.
    """
    obs = Observation(f"write-{uuid.uuid4().hex}")  # unique: writes may run concurrently
    # Observed above the layout shuffle: a range shuffle's sampling job
    # re-reads the input, so an observation below it would count rows twice.
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in count_nulls]
    laid_out = clustered(df, partition_by, cluster_by, num_partitions) if arrange else df
    out = laid_out.observe(obs, F.count(F.lit(1)).alias("rows"), *nulls)
    writer = out.write.mode(mode).format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if compression:
        writer = writer.option("compression", compression)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)
    seen = obs.get
    return WriteResult(path, int(seen["rows"]), {c: int(seen[f"nulls_{c}"]) for c in count_nulls})


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder to ``target``; an earlier one steps aside first and is then deleted.

    Nothing is copied. Between the two renames there is no table at
    ``target``; readers that must not see that use a catalog table per version.
    """
    jvm, new, fs = _file_system(spark, source)
    place = jvm.org.apache.hadoop.fs.Path(target)
    aside = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(place.getParent())
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise OSError(f"{target} could not be set aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(aside, place)
        raise OSError(f"{source} could not be moved to {target}")
    if had:
        fs.delete(aside, True)


def incremental_window(df: DataFrame, date_col: str, start_date: dt.date | str) -> DataFrame:
    """Rows of the processing window (pushed into the scan / partitions)."""
    return df.where(F.col(date_col) >= F.lit(start_date).cast("date"))


def write_incremental(df: DataFrame, path: str, date_col: str, start_date: dt.date | str, **kw) -> WriteResult:
    """Recompute the window and replace its day partitions, and those only.

    A day of the window that has become empty loses its partition. The window is
    computed once, into a folder beside the table; its day names (one a day)
    tell which old partitions to drop.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.window-{uuid.uuid4().hex[:12]}"
    result = write_table(incremental_window(df, date_col, start_date), staged, partition_by=date_col, **kw)
    days = _days(spark, staged, date_col)
    start = str(start_date)
    for day, folder in _days(spark, path, date_col).items():
        if day >= start and day not in days:
            _file_system(spark, folder)[2].delete(_file_system(spark, folder)[1], True)
    for day, folder in days.items():
        move_into_place(spark, folder, f"{path.rstrip('/')}/{date_col}={day}")
    _file_system(spark, staged)[2].delete(_file_system(spark, staged)[1], True)
    return WriteResult(path, result.rows)


def _days(spark: SparkSession, path: str, date_col: str) -> dict[str, str]:
    """Day -> folder of a day-partitioned table (folder names only)."""
    _, folder, fs = _file_system(spark, path)
    if not fs.exists(folder):
        return {}
    found = [str(s.getPath()) for s in fs.listStatus(folder)]
    return {f.rsplit("=", 1)[1]: f for f in found if f.rsplit("/", 1)[1].startswith(f"{date_col}=")}


# How long each layer keeps its rows, in months or days.
RETENTION = {"raw": {"keep_months": 84}, "staging": {"keep_days": 90}, "marts": {"keep_months": 60}, "audit": {"keep_months": 84}}


def retention_cutoff(as_of: dt.date | str, keep_days: int = 0, keep_months: int = 0):
    return F.date_sub(F.add_months(F.lit(as_of).cast("date"), -keep_months), keep_days)


def retention_report(df: DataFrame, date_col: str, as_of: dt.date | str, keep_days: int = 0, keep_months: int = 0) -> DataFrame:
    """Per partition date, its rows and whether it expires."""
    cutoff = retention_cutoff(as_of, keep_days, keep_months)
    return df.groupBy(F.col(date_col).alias("partition_date")).agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("action", F.when(F.col("partition_date") < cutoff, "expire").otherwise("keep"))


def retained(df: DataFrame, date_col: str, as_of: dt.date | str, keep_days: int = 0, keep_months: int = 0) -> DataFrame:
    """The rows a retention run keeps; rows without a date stay."""
    return df.where(F.col(date_col).isNull() | (F.col(date_col) >= retention_cutoff(as_of, keep_days, keep_months)))


def drop_expired_partitions(spark: SparkSession, table: str, date_col: str,
                            as_of: dt.date | str, keep_days: int = 0, keep_months: int = 0) -> list[str]:
    """S18 on a catalog table: drop day partitions older than the cutoff.

    Only partition *names* (catalog metadata) reach the driver.
    """
    cutoff = spark.range(1).select(retention_cutoff(as_of, keep_days, keep_months).cast("string")).first()[0]
    dropped = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = dict(part.split("=", 1) for part in row[0].split("/"))
        value = spec.get(date_col)
        if value is not None and value < cutoff:
            dropped.append(value)
    for k in range(0, len(dropped), 500):  # a statement for many partitions, not one each
        some = ", ".join(f"PARTITION ({date_col} = DATE '{v}')" for v in dropped[k : k + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {some}")
    return dropped
