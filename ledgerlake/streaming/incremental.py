"""Incremental refresh of the daily summary mart with Structured Streaming.

New transaction files landing in a month-partitioned folder are picked up
by a file stream. Each micro-batch finds the days it touches, re-reads
those days from the landing folder (dynamic partition pruning limits the
scan to their months; rows of one day can arrive in several batches),
recomputes their summary and replaces exactly those day partitions
of the mart (dynamic partition overwrite). Replaying a batch after a
failure rewrites the same partitions, so the sink is idempotent; the
checkpoint folder records which files were consumed.

``start_additive_refresh`` needs no second look at landed files. Its state is M6's additive part, kept as a
versioned table by day: a micro-batch sums its own rows, adds them to the partials of the days it
touches (read by partition) and commits those days together with its batch number in one manifest. A
replayed batch finds its number committed and does nothing, so every file counts once, whatever
fails in between. Rates and averages are derived on reading (``read_summary``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.marts import add_daily_partials, daily_summary_of, daily_summary_partials, mart_fin_daily_summary
from ..operators.staging import stg_transactions
from ..schemas import TRANSACTIONS
from ..sources.sinks import spread, write_table
from ..sources.versions import VersionedTable

MONTH_COL = "transaction_month"
LANDING_SCHEMA = T.StructType([*TRANSACTIONS.fields, T.StructField(MONTH_COL, T.DateType(), True)])


def land(df: DataFrame, landing_path: str, mode: str = "append") -> None:
    """Write raw transactions into the month-partitioned landing folder."""
    (df.withColumn(MONTH_COL, F.date_trunc("month", F.col("transaction_date")).cast("date"))
     .repartitionByRange(MONTH_COL, "transaction_date")
     .write.mode(mode).partitionBy(MONTH_COL).parquet(landing_path))


def refresh_batch(spark: SparkSession, batch: DataFrame, landing_path: str, mart_path: str) -> None:
    days = batch.select(MONTH_COL, "transaction_date").distinct()
    landed = spark.read.schema(LANDING_SCHEMA).parquet(landing_path)
    affected = landed.join(days, [MONTH_COL, "transaction_date"], "left_semi").drop(MONTH_COL)
    mart = mart_fin_daily_summary(stg_transactions(affected))
    # A micro-batch is small (bounded by maxFilesPerTrigger) but touches many
    # day partitions: spread its write over the cluster instead of letting
    # AQE coalesce it into one task that creates every file in turn.
    spread = mart.repartition(spark.sparkContext.defaultParallelism, "summary_date")
    write_table(spread, mart_path, partition_by="summary_date", dynamic=True, arrange=False)


def start_refresh(spark: SparkSession, landing_path: str, mart_path: str, checkpoint_path: str, *,
                  max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what has landed, then stops."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_path)
    writer = (stream.writeStream
              .foreachBatch(lambda batch, _epoch: refresh_batch(spark, batch, landing_path, mart_path))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def add_batch(state: VersionedTable, batch: DataFrame, epoch: int) -> bool:
    """Add one micro-batch to the state; False if it was added before."""
    done = state.manifest().batch
    if done is not None and done >= epoch:
        return False
    fresh = daily_summary_partials(stg_transactions(batch.drop(MONTH_COL)))
    # The batch is summed once: its partials are written, and give the days to read of the state.
    sums = VersionedTable(state.spark, f"{state.root}/_batch")
    sums.overwrite(fresh)
    fresh = sums.read()
    if state.exists():
        days = fresh.select("summary_date").distinct()
        held = state.read().join(days, "summary_date", "left_semi")
        fresh = add_daily_partials(held.unionByName(fresh))
    staged = state.stage(spread(fresh, "summary_date"), partition_by="summary_date", arrange=False)
    state.commit_days(staged, lambda d: False, f"batch {epoch}", epoch)
    sums.vacuum(keep_versions=1, older_than_hours=0)
    return True


def read_summary(state: VersionedTable) -> DataFrame:
    """M6 as the state has it."""
    return daily_summary_of(state.read())


def start_additive_refresh(spark: SparkSession, landing_path: str, state_root: str, checkpoint_path: str, *,
                           max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream that adds each micro-batch to the state; ``available_now`` drains what has landed, then stops."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    state = VersionedTable(spark, state_root)
    writer = (reader.parquet(landing_path).writeStream
              .foreachBatch(lambda batch, epoch: add_batch(state, batch, epoch) and None)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
