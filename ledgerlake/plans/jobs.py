"""Batch jobs: ingest raw CSVs, build the marts behind a blocking check gate.

``ingest``: per table, typed FAILFAST scan -> load stamp -> partitioned/clustered
write that observes rows and NULLs of REQUIRED columns -> commit as the table's new
version if there are none -> audit row; the tables load as concurrent jobs. A large day-partitioned
table is written in passes, still one version, and a pass's shuffle files go when it ends. A failing table is recorded and the others
continue; the job raises at the end. Only one metrics row per table
reaches the driver.

``build_mart``: compute -> write to a staging folder (this also cuts the
lineage, so a lost executor re-reads files instead of recomputing the
whole plan) -> run the checks on the staged copy -> write the check results
-> raise if any failed (the published mart is left untouched) -> publish by
renaming the staged folder into place: the mart is written once, and a
crash leaves either the old or the new mart, beside a folder to clean up.

``publish_mart`` does the same on a versioned table: stage, check, then commit the staged
write by one manifest. Readers never meet a missing or mixed mart, and an earlier
version can be read or restored. ``refresh_window`` recomputes a window of days that way.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.reconcile import CheckFailed, assert_passed
from ..schemas import RAW_TABLES
from ..session import shuffles_freed
from ..sources.audit import append_audit, audit_row
from ..sources.catalog import Catalog
from ..sources.files import csv_passes, raise_required, read_typed_csv, with_loaded_at
from ..sources.sinks import WriteResult, incremental_window, move_into_place, write_table
from ..sources.versions import NO_DAY, Manifest, Staged, VersionedTable


class LoadFailed(RuntimeError):
    pass


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _load_one(spark: SparkSession, catalog: Catalog, csv_root: str, name: str, *, run_id: str,
              load_ts: dt.datetime, pipeline_name: str) -> tuple[str, int | None, DataFrame]:
    spec = RAW_TABLES[name]
    started = _now()
    try:
        path = f"{csv_root.rstrip('/')}/{name}"
        passes = csv_passes(spark, path) if spec.partition_by else [[path]]  # other tables' files cover disjoint key ranges
        # One pass over the CSV: it is parsed into a staged write while NULLs of the
        # required columns are counted; only a clean load becomes the table's next version.
        table = catalog.versioned("raw", name)
        staged = table.stage([with_loaded_at(read_typed_csv(spark, some, name), load_ts) for some in passes],
                             partition_by=spec.partition_by, cluster_by=spec.cluster_by, count_nulls=spec.required,
                             compression="zstd")
        res = staged.result
        raise_required(name, res.nulls)
        table.commit(staged, f"run {run_id}")
        row = audit_row(spark, run_id=run_id, pipeline_name=pipeline_name, step=f"load_{name}",
                        status="success", rows_processed=res.rows, started_at=started, finished_at=_now())
        return name, res.rows, row
    except Exception as e:  # noqa: BLE001 - recorded in the audit, re-raised as a summary
        row = audit_row(spark, run_id=run_id, pipeline_name=pipeline_name, step=f"load_{name}",
                        status="failed", rows_processed=None, started_at=started, finished_at=_now(),
                        error_message=str(e))
        return name, None, row


def ingest(spark: SparkSession, catalog: Catalog, csv_root: str, tables: Sequence[str] | None = None, *,
           audit_path: str, run_id: str | None = None, load_ts: dt.datetime | None = None,
           pipeline_name: str = "ingestion_load", max_parallel: int = 4) -> dict[str, int]:
    """Load each raw table, isolate failures.

    Tables load as concurrent Spark jobs (``max_parallel`` driver threads),
    so one table's tail does not leave the cluster idle; each load is
    independent and a failure only marks its own audit row.
    """
    run_id = run_id or str(uuid.uuid4())
    load_ts = load_ts or _now()
    names = list(tables or RAW_TABLES)
    with shuffles_freed(spark), ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(names)))) as pool:
        results = list(pool.map(lambda n: _load_one(spark, catalog, csv_root, n, run_id=run_id,
                                                    load_ts=load_ts, pipeline_name=pipeline_name), names))
    batch = results[0][2]
    for _, _, row in results[1:]:
        batch = batch.unionByName(row)
    append_audit(batch, audit_path)
    failures = [n for n, rows, _ in results if rows is None]
    if failures:
        raise LoadFailed(f"load failed for: {', '.join(failures)}")
    return {n: rows for n, rows, _ in results}


def build_mart(spark: SparkSession, mart: DataFrame, *, name: str, publish_path: str, staging_path: str,
               checks: Callable[[DataFrame], DataFrame] | None = None, results_path: str | None = None,
               partition_by: str | None = None, cluster_by: Sequence[str] = ()) -> WriteResult:
    """Stage, check, then publish a mart (T14 blocking gate)."""
    staged = write_table(mart, staging_path, partition_by=partition_by, cluster_by=cluster_by)
    staged_df = spark.read.parquet(staging_path)
    if checks is not None:
        results = checks(staged_df)
        if results_path:
            results.write.mode("overwrite").parquet(results_path)
            results = spark.read.parquet(results_path)
        try:
            assert_passed(results)
        except CheckFailed as e:
            raise CheckFailed(f"{name}: {e}; not published") from e
    move_into_place(spark, staging_path, publish_path)
    return WriteResult(publish_path, staged.rows)


def _gate(spark: SparkSession, name: str, staged: DataFrame, checks: Callable[[DataFrame], DataFrame] | None,
          results_path: str | None) -> None:
    if checks is None:
        return
    results = checks(staged)
    if results_path:
        results.write.mode("overwrite").parquet(results_path)
        results = spark.read.parquet(results_path)
    try:
        assert_passed(results)
    except CheckFailed as e:
        raise CheckFailed(f"{name}: {e}; not published") from e


def publish_mart(table: VersionedTable, mart: DataFrame, *, name: str,
                 checks: Callable[[DataFrame], DataFrame] | None = None, results_path: str | None = None,
                 partition_by: str | None = None, cluster_by: Sequence[str] = (), arrange: bool = True) -> Manifest:
    """Stage the mart, run the checks on the staged rows, commit it as the next version.

    A failing check leaves the table as it was and raises; the check results are
    written first, if a path is given.
    """
    staged: Staged = table.stage(mart, partition_by=partition_by, cluster_by=cluster_by, arrange=arrange)
    _gate(table.spark, name, table.staged(staged), checks, results_path)
    return table.commit(staged, f"mart {name}")


def refresh_window(table: VersionedTable, mart: DataFrame, date_col: str, start: dt.date | str, *, name: str,
                   checks: Callable[[DataFrame], DataFrame] | None = None, results_path: str | None = None,
                   cluster_by: Sequence[str] = (), arrange: bool = True) -> Manifest:
    """S17 behind the gate: the window's days are staged, checked, and replace the old ones by one commit."""
    first = str(start)
    staged = table.stage(incremental_window(mart, date_col, start), partition_by=date_col, cluster_by=cluster_by, arrange=arrange)
    _gate(table.spark, name, table.staged(staged), checks, results_path)
    return table.commit_days(staged, lambda d: d != NO_DAY and d >= first, f"mart {name} from {first}")
