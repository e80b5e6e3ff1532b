"""Operations mart, latest rows, relation comparison, holidays by rule, foreign keys, relational ranges and the additive stream."""

from __future__ import annotations

import bisect
import datetime as dt
import os
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake import functions as fn
from ledgerlake.functions.calendar import easter_sunday, national_holidays
from ledgerlake.operators import dedup, marts, quality, reconcile, staging
from ledgerlake.registry import QUERIES, Models
from ledgerlake.schemas import TRANSACTIONS
from ledgerlake.sources import files, sinks
from ledgerlake.sources.versions import VersionedTable
from ledgerlake.streaming import incremental

SF = "/root/testdata/sf0.001"


def plan_of(df, final=False):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("Initial Plan")] if "Initial Plan" in text else text


def initial(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.index("Initial Plan"):] if "Initial Plan" in text else text


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('raw')}/transactions"
    sinks.write_table(Models(spark, SF).cat.transactions.where("transaction_date < '1998-06-01'"), path, partition_by="transaction_date", num_partitions=8)
    return spark.read.parquet(path)


def test_both_grains_from_one_scan(spark, raw):
    stg = staging.stg_transactions(raw)
    both = marts.operations_periods(marts.operations_daily(stg))
    assert initial(both).count("Scan parquet") == 1 and initial(both).count("Exchange hashpartitioning") == 2
    want = sorted(map(tuple, marts.transaction_operations(stg).collect()), key=str)
    assert sorted(map(tuple, both.collect()), key=str) == want
    # filters above change neither the scans nor the rows
    part = both.where("period_start >= '1998-02-01' and total_transactions > 0")
    assert initial(part).count("Scan parquet") == 1
    assert sorted(map(tuple, part.collect()), key=str) == [r for r in want if str(r[1]) >= "1998-02-01"]


def test_bounds_reach_the_scan(spark, raw):
    stg = staging.stg_transactions(raw)
    some = marts.operations_periods(marts.operations_daily(stg, since="1998-02-01", until="1998-03-01"))
    filters = initial(some).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert filters.count("transaction_date") >= 2
    rows = some.collect()
    assert {r.period_start.month for r in rows} == {2} and {r.granularity for r in rows} == {"daily", "monthly"}
    months = marts.operations_monthly(stg, since="1998-02-01", until="1998-03-01")
    assert sorted(map(tuple, months.collect())) == sorted(tuple(r) for r in rows if r.granularity == "monthly")


def test_operations_of_nothing(spark, raw):
    none = staging.stg_transactions(raw.where("false"))
    assert marts.operations_periods(marts.operations_daily(none)).count() == 0


def test_latest_row_plan(spark, raw):
    df = raw.select("merchant_id", "transaction_date", "transaction_id", "amount_brl")
    plan = initial(dedup.latest_per_key(df, ["merchant_id"], ["transaction_date"]))
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2 and "SortAggregate" not in plan  # before and after the exchange


def test_latest_row_sends_one_row_of_a_hot_key_a_task(spark):
    """A third of the rows share a key; each task sends one of them."""
    n, tasks = 30_000, 8
    df = spark.range(0, n, 1, tasks).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.concat(F.lit("x"), "id").alias("v"))
    out = dedup.latest_per_key(df, ["k"], ["t"])
    assert out.where("k = 0").collect()[0].t == n - 3
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    sent = []

    def walk(node):
        if "ShuffleExchange" in node.getClass().getSimpleName():
            sent.append(node.metrics().get("shuffleRecordsWritten").get().value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(out._jdf.queryExecution().executedPlan())
    assert sent and max(sent) <= n - n // 3 + tasks


def test_latest_row_forms_agree(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice([None, dt.date(2020, 1, r.randrange(1, 4))]), r.choice([None, 1, 2]), r.choice([None, "x", "y"])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, d date, n int, s string")
    for keys, order in ((["k"], ["d"]), (["k", "s"], ["n", "d"]), (["n"], ["s"])):
        one, two = (f(df, keys, order) for f in (dedup.dedup_latest, dedup.latest_per_key))
        assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert dedup.latest_per_key(df.where("false"), ["k"], ["d"]).count() == 0


def brute(a, b):
    out = {}
    for k in {x[0] for x in a + b if x[0] is not None}:
        left, right = [x[1:] for x in a if x[0] == k], [x[1:] for x in b if x[0] == k]
        if not left or not right:
            out[k] = ("only_in_b" if not left else "only_in_a", None)
            continue
        diff = ",".join(c for i, c in enumerate(("v", "w", "x")) if sorted(map(str, (r[i] for r in left))) != sorted(map(str, (r[i] for r in right))))
        out[k] = ("duplicate_key" if max(len(left), len(right)) > 1 else "changed" if diff else "same", diff)
    return out


def test_compare_relations_against_brute_force(spark):
    r = random.Random(3)

    def side(n):
        return [(r.choice([None, *range(60)]), r.choice([None, "", "a", "b"]), r.choice([None, 0, 1]), r.choice([None, 0.0, -0.0, 1.5])) for _ in range(n)]

    a, b = side(70), side(70)
    b += [x for x in a if r.random() < 0.6]
    schema = "k int, v string, w int, x double"
    out = reconcile.compare_relations(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"])
    plan = initial(out)
    assert "SortAggregate" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    norm = lambda rows: [tuple(0.0 if v == 0 and isinstance(v, float) else v for v in x) for x in rows]
    got = out.collect()
    assert {x.k: (x.status, x.changed_columns) for x in got if x.k is not None} == brute(norm(a), norm(b))
    nulls = sorted(x.status for x in got if x.k is None)
    assert nulls == (["only_in_a"] if any(x[0] is None for x in a) else []) + (["only_in_b"] if any(x[0] is None for x in b) else [])


def test_compare_relations_hot_key_and_no_columns(spark):
    a = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    b = a.orderBy(F.desc("v"))
    assert reconcile.compare_relations(a, b, ["k"]).collect()[0].changed_columns == ""
    assert reconcile.compare_relations(a, b.where("v <> 7"), ["k"]).collect()[0].changed_columns == "v"
    assert [r.status for r in reconcile.compare_relations(a.limit(1), b.limit(1), ["k"], compare=[]).collect()] == ["same"]


# --- holidays by rule ---------------------------------------------------------------

def test_easter_by_rule(spark):
    got = {r.y: r.e for r in spark.range(1583, 4100).select(F.col("id").cast("int").alias("y"), fn.easter_date("id").alias("e")).collect()}
    assert got == {y: easter_sunday(y) for y in got}


def test_business_days_by_rule_from_1900_to_2200(spark):
    hol = set(national_holidays(range(1880, 2230)))
    off = sorted(h for h in hol if h.weekday() < 5)
    r = random.Random(6)
    first = dt.date(1900, 1, 1).toordinal()
    last = dt.date(2200, 12, 31).toordinal()
    rows = []
    for _ in range(3000):
        s = r.randrange(first, last)
        e = s + r.choice([-3, 0, 1, 7, 40, 366, 1500, r.randrange(20000)])
        rows.append((dt.date.fromordinal(s), dt.date.fromordinal(min(e, last))))
    # every year with a Good Friday on 21 April, day by day around it
    for y in range(1900, 2201):
        if easter_sunday(y) == dt.date(y, 4, 23):
            rows += [(dt.date(y, 4, 1), dt.date(y, 4, d)) for d in range(19, 25)] + [(dt.date(y - 1, 6, 1), dt.date(y + 1, 6, 1))]
    rows += [(None, dt.date(2000, 1, 1)), (dt.date(2000, 1, 1), None)]
    df = spark.createDataFrame(rows, "s date, e date").repartition(8)
    out = df.select("s", "e", fn.business_days_exact("s", "e", None).alias("n"), fn.holidays_between("s", "e").alias("h"), fn.is_business_day("s", None).alias("b")).collect()

    def weekdays(s, e):
        n = max((e - s).days, 0)
        return sum(1 for k in range(n % 7) if (s.weekday() + k) % 7 < 5) + n // 7 * 5

    for x in out:
        if x.s is None or x.e is None:
            assert x.n is None and x.h is None
            continue
        h = max(0, bisect.bisect_left(off, x.e) - bisect.bisect_left(off, x.s)) if x.e > x.s else 0
        assert (x.h, x.n, x.b) == (h, weekdays(x.s, x.e) - h, x.s.weekday() < 5 and x.s not in hol), x


# --- foreign keys -------------------------------------------------------------------

def test_all_foreign_keys_from_one_scan_a_table(spark, tmp_path):
    def stored(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    t = stored("t", [("m1", "c1"), ("m1", "cX"), ("mX", None), (None, "c1"), *[("m1", "c1")] * 50], "m string, c string")
    m = stored("m", [("m1", "c1"), ("m1", "c9"), ("m2", None)], "m string, c string")
    c = stored("c", [("c1",), ("c2",), (None,)], "c string")
    none = stored("n", [], "c string")
    out = quality.fk_coverage_all([(t, "t", "m", "m"), (t, "t", "c", "c"), (m, "m", "c", "c"), (none, "n", "c", "c")], {"m": (m, "m"), "c": (c, "c")})
    plan = initial(out)
    assert plan.count("Scan parquet") == 4 and "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r.child_table, r.fk_column): (r.parent_table, r.orphan_rows, r.total_rows, r.status) for r in out.collect()}
    assert got == {("t", "m"): ("m", 1, 54, "error"), ("t", "c"): ("c", 1, 54, "error"), ("m", "c"): ("c", 1, 3, "error"), ("n", "c"): ("c", 0, 0, "pass")}


# --- relational scans ---------------------------------------------------------------

@pytest.mark.parametrize(("low", "high", "rows"), [(1, 1000, 5000), (-50, 49, 100), (7, 7, 90), (1, 3, 10**6), (0, 10**12, 10**9), (dt.date(2020, 1, 1), dt.date(2021, 12, 31), 10**7), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), 4000)])
def test_every_value_falls_in_one_range(low, high, rows):
    con = duckdb.connect()
    predicates = files.plan_ranges("k", files.SourceStats(low, high, rows, nulls=3), rows_per_read=1000, max_reads=64)
    assert 1 <= len(predicates) <= 65
    if low != high and rows > 2000:
        assert len(predicates) > 1
    unit = {int: 1, dt.date: dt.timedelta(days=1), dt.datetime: dt.timedelta(seconds=1)}[type(low)]
    r = random.Random(1)
    steps = (high - low) // unit
    values = [None, low, high, low - 5 * unit, high + 5 * unit, *(low + r.randrange(steps + 1) * unit for _ in range(300))]
    kind = {int: "BIGINT", dt.date: "DATE", dt.datetime: "TIMESTAMP"}[type(low)]
    con.execute(f"CREATE TABLE t (k {kind})")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert con.execute(f"SELECT min({hits}), max({hits}) FROM t").fetchone() == (1, 1)


def test_source_without_rows_is_one_read():
    assert files.plan_ranges("k", files.SourceStats(None, None, 0)) == ["1 = 1"]
    assert files.plan_ranges("k", files.SourceStats(None, None, 5, nulls=5)) == ["1 = 1"]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (1), (5), (NULL)) x(k)")
    assert con.execute(files.stats_query("t", "k")).fetchone() == (1, 5, 3, 1)


# --- stream -------------------------------------------------------------------------

def _transactions(spark, rows):
    def one(i, day, amount, status="approved", method="pix"):
        return (f"T{i}", "M1", "C1", Decimal(amount), Decimal("2.0000"), Decimal("0.10"), Decimal(amount) - Decimal("0.10"), method, status, day, dt.datetime.combine(day, dt.time()), 1, "A", "stone")

    return spark.createDataFrame([one(*r) for r in rows], TRANSACTIONS)


def test_stream_reads_its_own_files_only(spark, tmp_dir):
    land, root, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/state", f"{tmp_dir}/ckpt"
    first = _transactions(spark, [(1, dt.date(2024, 1, 2), "10.00"), (2, dt.date(2024, 2, 1), "5.00"), (3, dt.date(2024, 1, 2), "1.00", "denied")])
    second = _transactions(spark, [(4, dt.date(2024, 1, 2), "7.00"), (5, dt.date(2024, 1, 2), "3.00", "approved", "ted")])
    incremental.land(first, land)
    incremental.start_additive_refresh(spark, land, root, ckpt).awaitTermination()
    whole = marts.mart_fin_daily_summary(staging.stg_transactions(first.unionByName(second))).collect()
    # the files of the first batch are gone: a second look at them would fail
    for folder, _, names in os.walk(land):
        for name in names:
            os.remove(os.path.join(folder, name))
    incremental.land(second, land)
    incremental.start_additive_refresh(spark, land, root, ckpt).awaitTermination()
    state = VersionedTable(spark, root)
    got = incremental.read_summary(state)
    assert sorted(map(str, got.select(*whole[0].asDict()).collect())) == sorted(map(str, whole))
    untouched = [w for w, days in state.manifest().writes.items() if days == ["2024-02-01"]]
    assert len(untouched) == 1  # 1 February was not written again


def test_replayed_batch_changes_nothing(spark, tmp_dir, monkeypatch):
    state = VersionedTable(spark, f"{tmp_dir}/state")
    batch = _transactions(spark, [(1, dt.date(2024, 1, 2), "10.00"), (2, dt.date(2024, 1, 3), "4.00")])
    assert incremental.add_batch(state, batch, 0) and not incremental.add_batch(state, batch, 0)
    monkeypatch.setattr(VersionedTable, "_commit", lambda self, m: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        incremental.add_batch(state, batch, 1)
    monkeypatch.undo()
    assert incremental.add_batch(state, batch, 1)  # the batch comes again after the crash
    state.expire_before("2024-01-03")
    assert not incremental.add_batch(state, batch, 1)  # known whatever came after it
    got = incremental.read_summary(state).collect()
    assert [(r.summary_date, r.total_transactions, r.total_tpv_brl) for r in got] == [(dt.date(2024, 1, 3), 2, Decimal("8.00"))]


def test_partials_add_up(spark):
    stg = Models(spark, SF).transactions
    halves = [marts.daily_summary_partials(stg.where(c)) for c in ("amount_brl < 20000", "amount_brl >= 20000")]
    added = marts.daily_summary_of(marts.add_daily_partials(halves[0].unionByName(halves[1])))
    whole = marts.mart_fin_daily_summary(stg)
    assert added.schema == whole.schema or [f.dataType for f in added.schema] == [f.dataType for f in whole.schema]
    assert sorted(map(str, added.collect())) == sorted(map(str, whole.collect()))


def test_refused_explore_and_granted_columns(spark):
    rows = {(r.department, r.explore): r.refused for r in QUERIES["explore_refusals"](spark, SF).collect()}
    assert {d for (d, e), no in rows.items() if no} == {"finance", "sales", "marketing"} and not any(no for (d, e), no in rows.items() if e == "merchant_performance")
    plan = initial(QUERIES["granted_fields"](spark, SF))
    assert plan.count("Scan parquet") == 1  # summed once for all departments


def test_portfolio_sketches_merge(spark):
    m = Models(spark, SF)
    # halves that share customers, and a quarter of the contracts twice
    parts = [marts.portfolio_partials(m.contracts.where(c), m.customers) for c in ("days_past_due < 60", "days_past_due >= 60", "days_past_due > 200")]
    merged = marts.merge_portfolio_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["product_type"])
    got = {r.product_type: (r.total_contracts, r.total_customers) for r in marts.portfolio_estimates(merged).collect()}
    rows = marts.enriched_contracts(m.contracts, m.customers).where("is_active or is_npl").groupBy("product_type").agg(
        F.count_distinct("contract_id").alias("k"), F.count_distinct("customer_id").alias("c")).collect()
    assert set(got) == {r.product_type for r in rows} and len(rows) > 2
    for r in rows:
        assert abs(got[r.product_type][0] - r.k) <= 0.03 * r.k + 1 and abs(got[r.product_type][1] - r.c) <= 0.03 * r.c + 1
    whole = {tuple(r)[:5]: r for r in marts.portfolio_estimates(marts.portfolio_partials(m.contracts, m.customers)).collect()}
    for r in m.portfolio.collect():
        e = whole[tuple(r[k] for k in marts.PORTFOLIO_KEYS)]
        assert (e.total_outstanding_brl, e.npl_rate_pct, e.total_expected_loss_brl) == (r.total_outstanding_brl, r.npl_rate_pct, r.total_expected_loss_brl)
    plan = initial(marts.portfolio_partials(m.contracts, m.customers))
    assert "Expand" not in plan


def test_gate_and_csv_compute_their_input_once(spark, tmp_dir, monkeypatch):
    """The gate's attempts read staged transactions, and a CSV's input runs once, empty or not."""
    from pyspark.sql import functions as F

    from ledgerlake import registry
    from ledgerlake.sources import sinks

    m, reads = registry.Models(spark, "/root/testdata/sf0.001"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    raw = m.cat.transactions
    n = raw.count()

    class Counted:
        def __getattr__(self, name):
            return raw.mapInArrow(seen, raw.schema) if name == "transactions" else getattr(m.cat, name)

    got = {r.step: (r.verdict, r.rows) for r in registry.BUILDERS["mart_gate"](registry.Models(spark, cat=Counted())).collect()}
    assert [got[s][0] for s in ("whole", "lost_days", "lost_window", "whole_window")] == ["published", "blocked", "blocked", "published"]
    assert reads.value == n
    reads.value = 0
    path = f"{tmp_dir}/csv"
    counted = raw.mapInArrow(seen, raw.schema)
    assert sinks.write_csv(counted, path) and reads.value == n
    assert not sinks.write_csv(raw.where(F.lit(False)), path)
    assert spark.read.option("header", True).csv(path).count() == n
    assert not sinks.write_csv(raw.where("amount_brl < 0"), f"{tmp_dir}/none")
    assert [p.name for p in __import__("pathlib").Path(tmp_dir).iterdir()] == ["csv"]
