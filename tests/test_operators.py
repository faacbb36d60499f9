"""Operators, write modes, gates and comparisons on small rows."""

from __future__ import annotations

import tempfile
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.dates import crossings, date_key
from martloom.functions.money import is_income, tiered_commission
from martloom.functions.text import agreement_link, field_label, try_decimal
from martloom.operators import quality
from martloom.operators.compare import compare_metrics, diff_rows
from martloom.operators.keys import clustered, stable_key, unique_key
from martloom.operators.latest import latest_per_key, position_in_group
from martloom.operators.listagg import Listed, listagg_distinct
from martloom.operators.star import Lookup, star_lookup
from martloom.plans import measures, metrics, pipeline, report
from martloom.settings import MartSettings
from martloom.sinks import writers
from martloom.sinks.versions import VersionedTable
from martloom.sinks.runlog import PROCESSES, RunLog, etl_status, run_state
from martloom.sources.readers import read_sources
from martloom.operators.distinct import sums_with_distinct
from martloom.streaming.refresh import BucketedTable, changed_since, refresh_from_stream, upsert


def folder():
    return tempfile.mkdtemp(prefix="martloom-test-")


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


# ---- expressions ---------------------------------------------------------------------------------------------------
def test_expressions(spark):
    one = spark.range(1)
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    got = one.select(
        crossings("HOUR", stamp("2024-01-01 10:59:59"), stamp("2024-01-01 11:00:00")),
        crossings("MINUTE", stamp("2024-01-01 10:00:00"), stamp("2024-01-01 10:00:59")),
        date_key(F.lit(date(2024, 1, 31))),
        field_label(F.lit("SA Year 1 Commission%")),
        agreement_link(F.lit(3), F.lit(None).cast("bigint")),
        agreement_link(F.lit(3), F.lit(4)),
    ).first()
    assert tuple(got) == (1, 0, 20240131, "SAYear1Commission%Employee", None, "customer/3/service-agreement/4")


@pytest.mark.parametrize(
    ("text", "number"),
    [("5.005", D("5.01")), (" 7 ", D("7.00")), ("abc", None), ("123456789.00", None), (None, None), ("-1.5", D("-1.50"))],
)
def test_try_decimal(spark, text, number):
    assert spark.range(1).select(try_decimal(F.lit(text).cast("string"))).first()[0] == number


def test_income_rule(spark):
    names = spark.createDataFrame([("Income",), ("other income x",), ("Expense",), (None,)], "n string")
    assert [r[0] for r in names.select(is_income(F.col("n"))).collect()] == [True, True, False, True]


def test_commission_tiers(spark):
    years = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 10.0), (None, 10.0), (0, 10.0)], "y int, r double")
    rate = F.col("r").cast("decimal(10,4)")
    missing = F.lit(None).cast("decimal(10,4)")
    got = years.select(
        tiered_commission(F.col("y"), F.lit(D("-200.00")), rate, missing, rate * 2),
        tiered_commission(F.col("y"), F.lit(D("-200.00")), rate, missing, rate * 2, F.lit(0)),
    ).collect()
    assert [r[0] for r in got] == [D(-20), D(0), D(-40), None, None]
    assert [r[1] for r in got] == [D(-20), D(0), D(-40), D(0), D(0)]


# ---- latest, position, lists ---------------------------------------------------------------------------------------
def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, datetime(2024, 1, 1), "old"), (1, 2, datetime(2024, 1, 2), "new"), (1, 3, None, "undated"),
         (2, 4, None, "a"), (2, 5, None, "b"), (None, 6, None, "null key")],
        "k int, id int, at timestamp, v string",
    )
    for partitions in (1, 5):
        assert rows(latest_per_key(df.repartition(partitions), ["k"], ["at", "id"]), "k", "v") == [
            (None, "null key"), (1, "new"), (2, "b"),
        ]


@pytest.mark.parametrize("pieces", [1, 12])
def test_position_in_a_group_that_holds_most_rows(spark, pieces):
    hot = spark.range(6000).selectExpr("CASE WHEN id % 10 < 9 THEN NULL ELSE id % 100 END AS g", "id", "date_add(DATE'2024-01-01', CAST((id * 37) % 60 AS INT)) AS day")
    expected = hot.selectExpr("id", "row_number() OVER (PARTITION BY g ORDER BY day, id) AS p")
    got = position_in_group(hot.repartition(5), ["g"], "day", "id", "p", pieces).select("id", "p")
    assert got.exceptAll(expected.selectExpr("id", "p")).count() == 0 and got.count() == 6000


def test_listagg(spark):
    df = spark.createDataFrame(
        [(1, 3, "b", True), (1, 1, "a", True), (1, 10, None, True), (1, 3, "b", True), (1, 70000, "ab", True),
         (2, 5, None, True), (3, 6, "x", False)],
        "k int, n bigint, t string, posted boolean",
    )
    got = listagg_distinct(
        df, ["k"], {"ns": Listed(F.col("n"), True), "ts": Listed(F.col("t"), False, chunk=1)},
        where=F.col("posted"), sums={"total": F.col("n")},
    )
    assert rows(got, "k", "ns", "ts", "total") == [
        (1, "1, 3, 10, 70000", "a, ab, b", 70017), (2, "5", "", 5), (3, None, None, 6),
    ]


def test_star_lookup_keeps_rows_without_a_member(spark):
    fact = spark.createDataFrame([(1, 7), (2, None), (3, 9)], "id int, d bigint")
    dim = spark.createDataFrame([(7, "seven", 70)], "DimId bigint, Name string, DimKey bigint")
    got = star_lookup(fact, [Lookup(dim, {"d": "DimId"}, {"DimKey": "k"}), Lookup(dim, {"d": "DimId"}, {"Name": "n"})])
    assert got.columns == ["id", "d", "k", "n"]
    assert rows(got) == [(1, 7, 70, "seven"), (2, None, None, None), (3, 9, None, None)]


# ---- write modes ---------------------------------------------------------------------------------------------------
def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("1", "2.345")], "b string, a string")
    got = schemas.conform(df, {"a": "decimal(10,2)", "b": "bigint", "c": "date"})
    assert got.dtypes == [("a", "decimal(10,2)"), ("b", "bigint"), ("c", "date")]
    assert rows(got) == [(D("2.35"), 1, None)]


def test_period_replace(spark):
    path = folder()
    shape = "v int, PeriodStartDate date, PeriodEndDate date, TenantId bigint"
    first, second = (date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29))

    def write(period, values, tenants=(1, 2)):
        df = spark.createDataFrame([(v, *period, t) for v, t in values], shape)
        return writers.write_period(df, path, *period, tenants)

    read = lambda: rows(VersionedTable(spark, path).read(shape), "v", "TenantId", "PeriodStartDate")
    assert write(first, [(1, 1), (2, 2)]) == 2
    assert write(second, [(3, 1)]) == 1
    assert write(second, [(3, 1)]) == 1
    assert read() == [(1, 1, first[0]), (2, 2, first[0]), (3, 1, second[0])]
    assert write(first, [(4, 1)]) == 1
    assert read() == [(3, 1, second[0]), (4, 1, first[0])]
    assert write(first, [], (1,)) == 0
    assert read() == [(3, 1, second[0])]
    # Only the folders of the wanted part are read.
    part = VersionedTable(spark, path).read(shape, {"PeriodStartDate": second[0], "TenantId": [1, 2]})
    assert len({f.rsplit("/", 1)[0] for f in part.inputFiles()}) == 1 and rows(part, "v") == [(3,)]
    assert VersionedTable(spark, path).read(shape, {"TenantId": 2}).count() == 0


def test_insert_missing(spark):
    path = folder() + "/t"
    shape = "k int, v string"
    writers.write_full(spark.createDataFrame([(1, "a")], shape), path)
    new = spark.createDataFrame([(1, "x"), (2, "y")], shape)
    for expected in (1, 0):
        assert writers.insert_missing(new, VersionedTable(spark, path).read(shape), path, ["k"]) == expected
    assert rows(VersionedTable(spark, path).read(shape)) == [(1, "a"), (2, "y")]


def test_upsert_and_changed_since(spark):
    shape = "k int, v string, at timestamp"
    old = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 1))], shape)
    new = spark.createDataFrame([(2, "B", datetime(2024, 1, 3)), (3, "C", datetime(2024, 1, 2))], shape)
    assert rows(upsert(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    unknown = spark.createDataFrame([(4, "D", None), (5, "E", datetime(2024, 1, 1))], shape)
    assert rows(changed_since(new.union(unknown), "at", datetime(2024, 1, 2)), "k") == [(2,), (3,), (4,)]
    assert changed_since(new, "at", None).count() == 2


def test_refresh_from_stream(spark):
    shape = "k int, v string, at timestamp"
    source, root = folder(), folder()
    for batch in (
        [(1, "b", datetime(2024, 1, 2)), (1, "c", datetime(2024, 1, 3))], [(2, "d", datetime(2024, 1, 4)), (1, "late", datetime(2024, 1, 1))],
    ):
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
    changes = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
    target = BucketedTable(spark, f"{root}/t", shape, ["k"], buckets=16)
    target.apply(spark.createDataFrame([(i, "a", datetime(2024, 1, 1)) for i in range(1, 40)], shape), ["at"])
    refresh_from_stream(changes, target, ["at"], f"{root}/c").awaitTermination(120)
    assert rows(target.read().filter("k < 4"), "k", "v") == [(1, "c"), (2, "d"), (3, "a")]
    assert target.last_batch("stream") == 1 and target.read().count() == 39


def test_a_batch_rewrites_its_buckets_once(spark):
    shape = "k int, v string, at int"
    path = folder() + "/t"
    target = BucketedTable(spark, path, shape, ["k"], buckets=8)
    assert target.read().count() == 0 and target.last_batch("s") == -1
    target.apply(spark.createDataFrame([(i, "a", 1) for i in range(200)], shape), ["at"], "s", 0)
    folders = {dict(p.key)["bucket"]: p.folder for p in target.table.current().parts}
    assert len(folders) == 8
    change = spark.createDataFrame([(5, "b", 2), (5, "old", 0), (None, "n", 1)], shape)
    assert 1 <= target.apply(change, ["at"], "s", 1) <= 2
    moved = {b for b, f in {dict(p.key)["bucket"]: p.folder for p in target.table.current().parts}.items() if folders[b] != f}
    touched = {str(r[0]) for r in change.select(target._bucket()).collect()}
    assert moved == touched
    number = target.table.current().number
    # The same batch again, under its number: nothing is read or written.
    assert target.apply(spark.createDataFrame([(5, "x", 9)], shape), ["at"], "s", 1) == 0
    assert target.table.current().number == number
    assert rows(target.read().filter("k = 5 OR k IS NULL"), "k", "v") == [(None, "n"), (5, "b")]
    # A table keeps its number of buckets; another stream has numbers of its own.
    again = BucketedTable(spark, path, shape, ["k"], buckets=3)
    assert again.buckets == 8 and again.apply(spark.createDataFrame([(6, "z", 5)], shape), ["at"], "other", 0) == 1


def test_positions_of_hashed_ids_and_one_group(spark):
    import random

    rng = random.Random(3)
    data = [(None if i % 3 else i % 5, None if i % 11 == 0 else date(2024, 1, 1 + i % 4), rng.getrandbits(62)) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, day date, id bigint").repartition(6)
    got = position_in_group(df, ["g"], "day", "id", "p", pieces=16)
    expected = {}
    for g in {r[0] for r in data}:
        for i, r in enumerate(sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, r[1] or date.min, r[2]))):
            expected[r[2]] = i + 1
    assert {r.id: r.p for r in got.select("id", "p").collect()} == expected
    # No piece of the large group holds much more than its share of a day.
    cuts = sorted(df.agg(F.percentile_approx("id", [i / 16 for i in range(1, 16)])).first()[0])
    sizes = [sum(1 for r in data if r[0] is None and r[1] == date(2024, 1, 2) and a < r[2] <= b) for a, b in zip(cuts, cuts[1:])]
    assert max(sizes) < 3 * 500 / 16 + 20


@pytest.mark.parametrize("shift", [1, 256])
def test_distinct_counts_with_marks(spark, shift):
    data = [(1, i * shift) for i in range(300)] + [(2, i * shift) for i in range(40)] + [(2, 0), (2, None), (3, None), (None, 5), (None, 5), (4, -7), (4, -8)]
    df = spark.createDataFrame(data, "k int, id bigint").repartition(5)
    got = sums_with_distinct(df, ["k"], "id", "n", F.count(F.lit(1)).alias("rows"))
    assert rows(got, "k", "n", "rows") == [(None, 1, 2), (1, 300, 300), (2, 40, 42), (3, 0, 1), (4, 2, 2)]


def test_unique_ids_are_exchanged_once(spark, tables, capsys):
    lines = [{"id": i * 8 + n, "invoice_id": i, "total": 1} for i in range(50) for n in range(4)]
    invoices = [{"id": i, "status": 2, "invoicedon": "2024-01-01", "job_id": 1} for i in range(50)]
    got = measures.invoice_revenue(tables(invoiceitem=lines, invoice=invoices), MartSettings(tenant_ids=(1,)))
    assert got.filter("LineItemCount <> 4").count() == 0
    got.explain()
    plan = capsys.readouterr().out
    # No exchange by (invoice, id) of all lines: the second look at them follows a semi join.
    assert plan.count("LeftSemi") >= 1 and "Expand" not in plan


# ---- run log -------------------------------------------------------------------------------------------------------
def test_run_log(spark):
    log = RunLog(spark, folder() + "/log")
    log.seed()
    log.seed()
    assert log.read().count() == len(PROCESSES)
    assert log.run("Dim_Job", lambda: 5) == 5
    assert log.run("Dim_SKU", lambda: 0) == 0
    with pytest.raises(ZeroDivisionError):
        log.run("Dim_Job", lambda: 1 // 0)
    state = {r.ProcessName: r for r in run_state(log.read()).collect()}
    job = state["Dim_Job"]
    assert (job.LastRunStatus, job.RowsProcessed) == ("FAILED", 5) and "division" in job.ErrorMessage
    assert job.LastRunStart <= job.LastRunEnd and job.LastSuccessfulRunEnd < job.LastRunEnd
    assert state["Dim_SKU"].LastRunStatus == "SUCCESS_NO_DATA"
    assert state["Dim_Date"].LastRunStatus == "NOT_STARTED" and state["Dim_Date"].LastRunEnd is None
    assert etl_status(run_state(log.read())).filter("LastRunDurationMinutes IS NULL").count() == len(PROCESSES) - 2


# ---- gates and comparisons -----------------------------------------------------------------------------------------
def test_gates(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (3, 4)], "a int, b int")
    assert rows(quality.min_rows({"t": df}, {"t": 3, "gone": 1})) == [("gone", 1, 0, False), ("t", 3, 3, True)]
    assert rows(quality.duplicate_keys(df, ["a"])) == [(1, 2)]
    assert rows(quality.null_counts(df, ["a", "b"])) == [("a", 0, 3), ("b", 1, 3)]


def test_metric_comparison(spark):
    history = spark.createDataFrame(
        [("1", date(2024, 1, 1), "same", D(100)), ("2", date(2024, 2, 1), "same", D(200)), ("2", date(2024, 2, 1), "zero", D(0)),
         ("2", date(2024, 2, 1), "moved", D(100)), ("2", date(2024, 2, 1), "close", D(1000))],
        "RUN_VERSION string, RUN_DATE date, METRIC_NAME string, METRIC_VALUE decimal(20,2)",
    ).withColumns({"METRIC_COUNT": F.lit(1), "LOADDATETIME": F.lit(datetime(2024, 3, 1))})
    current = spark.createDataFrame(
        [("same", "c", D(200), 1), ("zero", "c", D(5), 1), ("moved", "c", D(80), 1), ("close", "c", D(1009), 1), ("new", "c", D(1), 1)],
        metrics.RESULT,
    )
    got = {r.name: r for r in compare_metrics(current, history).collect()}
    assert (got["same"].previous_version, got["same"].difference, got["same"].out_of_tolerance) == ("2", 0, False)
    assert (got["zero"].difference, got["zero"].difference_pct, got["zero"].out_of_tolerance) == (5, None, False)
    assert (float(got["moved"].difference_pct), got["moved"].out_of_tolerance) == (-20.0, True)
    assert not got["close"].out_of_tolerance
    assert (got["new"].previous_value, got["new"].difference, got["new"].out_of_tolerance) == (None, None, False)


def test_report_comparison(spark):
    shape = "k int, j string, `a%` int, b int"
    before = spark.createDataFrame([(1, None, 1, 1), (2, "x", 1, None), (3, "x", 1, 1)], shape)
    after = spark.createDataFrame([(1, None, 1, 1), (2, "x", 2, 5), (4, "x", 1, 1)], shape)
    assert rows(diff_rows(before, after, ["k", "j"])) == [
        (2, "x", "changed", "a%,b"), (3, "x", "removed", None), (4, "x", "added", None),
    ]


def test_a_failing_metric_leaves_the_others(spark):
    good = metrics.view_metrics(
        spark.range(3).selectExpr("id AS x"), [metrics.Metric("m", "c", "v", "sum(x)", "count(x)"), metrics.Metric("n", "c", "v", "max(NULL)", "count(NULL)")]
    )
    bad = spark.range(1).selectExpr("'m2' AS name", "'c' AS category", "CAST(raise_error('no') AS decimal(20,2)) AS value", "1L AS count")
    results, errors = metrics.run_metrics({"good": good, "bad": bad}, spark)
    assert rows(results) == [("m", "c", D(3), 3), ("n", "c", D(0), 0)] and list(errors) == ["bad"]


def test_metric_file_and_sql_metric(spark):
    pytest.importorskip("yaml")
    path = folder() + "/metrics.yaml"
    with open(path, "w") as handle:
        handle.write("version: '2'\nmetrics:\n  - name: n\n    category: c\n    query: SELECT sum(x) AS metric_value, count(*) AS metric_count FROM numbers\n")
    spark.range(4).selectExpr("id AS x").createOrReplaceTempView("numbers")
    loaded = metrics.load_metric_file(path, MartSettings())
    assert loaded.version == "2" and loaded.settings == MartSettings() and loaded.run_date == date.today()
    assert rows(metrics.sql_metric(spark, loaded.metrics[0], loaded.args)) == [("n", "c", D(6), 4)]


def test_employee_sides_meet_by_id_only(spark):
    """Only jobs, only agreements, both, and no employee on both sides: two NULL rows stay apart."""
    key = "EmployeeKey bigint, TenantId bigint"
    mart = {
        "dim_job": spark.createDataFrame([(1, 1, 1, "s", None, True), (9, 9, 1, "s", 5, True)], "JobKey bigint, JobId bigint, TenantId bigint, JobSummary string, ServiceAgreementId bigint, IsActive boolean"),
        "dim_employee": spark.createDataFrame([(k, k * 10, 1, f"E{k}", "Employee", k != 4) for k in (1, 2, 3, 4)], "EmployeeKey bigint, EmployeeId bigint, TenantId bigint, EmployeeName string, EmployeeType string, IsActive boolean"),
        "mat_employee_commissionrates": spark.createDataFrame([(10, 1, D(10)), (20, 1, D(20)), (40, 1, D(50))], "EmployeeId bigint, TenantId bigint, JobCommissionPct decimal(10,4)"),
        "mat_job_returns": spark.createDataFrame([(1, 1, D(-50))], "JobId bigint, TenantId bigint, TotalReturnCredit decimal(20,2)"),
        "fact_invoice": schemas.conform(
            spark.createDataFrame([(1, 1, 1, D(1000)), (2, 1, 1, D(1000)), (3, 1, None, D(1000)), (4, 9, 1, D(0)), (5, 9, 1, D(0)), (6, 1, 4, D(500)), (7, 1, 2, D(100))],
                                  f"InvoiceId bigint, JobKey bigint, {key.split(',')[0]}, IncomeRevenue decimal(20,2)")
            .withColumns({"TenantId": F.lit(1), "InvoiceStatus": F.lit(2), "TotalItemCost": F.when(F.col("JobKey") == 9, F.col("InvoiceId") * 10).otherwise(F.lit(0)), "TotalPOCost": F.lit(0), "TotalLaborCost": F.lit(0)}),
            schemas.MART["fact_invoice"]),
        "fact_serviceagreement": schemas.conform(
            spark.createDataFrame([(5, 3, 1, D(145)), (5, 2, 2, D(245)), (6, None, 3, D(100)), (7, 3, None, D(100))], "ServiceAgreementId bigint, EmployeeKey bigint, SARenewalYear int, RevenueRecognitionAmount decimal(20,2)")
            .withColumns({"TenantId": F.lit(1), "SAYear1CommissionPct": F.lit(10), "SAYear2CommissionPct": F.lit(5), "SAYear3PlusCommissionPct": F.lit(1)}),
            schemas.MART["fact_serviceagreement"]),
    }
    got = [(r.EmployeeId, float(r.JobCommission), float(r.SACommission), float(r.TotalCommission)) for r in report.employee_metrics(mart).collect()]
    # Mean visit cost of agreement 5 is 45 (the job dimension knows one return only for job 1).
    assert sorted(got, key=lambda r: (r[0] or 0, r[1], r[2])) == [
        (None, 0.0, 0.0, 0.0), (None, 0.0, 1.0, 1.0), (10, 210.0, 0.0, 210.0), (20, 30.0, 10.0, 40.0), (30, 0.0, 10.0, 10.0),
    ]


def test_sources_from_a_catalog(spark, tables):
    src = tables(job=[{"id": 1, "customer_id": 2}], report__dim_employee=[{"employee_id": 5, "user_id": 6}])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS martloom_raw LOCATION '{folder()}'")
    src["job"].select("active", "id", "_tenant_id", "customer_id").write.mode("overwrite").saveAsTable("martloom_raw.job")
    src["report.dim_employee"].write.mode("overwrite").saveAsTable("martloom_raw.report_dim_employee")
    opened = read_sources(spark, "table:martloom_raw", "table:martloom_raw")
    assert rows(opened["job"], "id", "customer_id", "summary", "active") == [(1, 2, None, 1)]
    assert rows(opened["report.dim_employee"], "employee_id", "user_id") == [(5, 6)]
    with pytest.raises(KeyError):
        opened["invoice"]


def test_facts_laid_out_by_date_can_skip_files(spark):
    days = spark.range(4000).selectExpr("id AS InvoiceId", "date_add(DATE'2024-01-01', CAST(id % 100 AS INT)) AS PostedDate")
    path = folder() + "/t"
    writers.write_full(unique_key(clustered(days.repartition(4), ["PostedDate", "InvoiceId"]), "k"), path)
    stored = VersionedTable(spark, path).read("InvoiceId bigint, PostedDate date, k bigint")
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min("PostedDate").alias("first"), F.max("PostedDate").alias("last")
    ).orderBy("first").collect()
    assert all(a.last <= b.first for a, b in zip(files, files[1:]))
    assert stored.select("k").distinct().count() == 4000


def test_stable_keys(spark):
    shape = "k int, t string"
    first, new = stable_key(spark.createDataFrame([(5, "a"), (None, "a"), (7, "b")], shape), "n", ["k", "t"])
    assert rows(first, "k", "t", "n") == rows(new, "k", "t", "n")
    known = {(r.k, r.t): r.n for r in first.collect()}
    assert sorted(known.values()) == [1, 2, 3]
    again, new = stable_key(spark.createDataFrame([(0, "a"), (None, "a"), (7, "b"), (9, "z")], shape), "n", ["k", "t"], first)
    got = {(r.k, r.t): r.n for r in again.collect()}
    assert got == {(None, "a"): known[None, "a"], (7, "b"): known[7, "b"], (0, "a"): 4, (9, "z"): 5}
    assert rows(new, "k") == [(0,), (9,)]


def test_dimension_keys_survive_new_and_deleted_members(spark, tables):
    root, settings = folder(), MartSettings(tenant_ids=(1,))

    def load(number, ids):
        raw = f"{root}/raw{number}"
        tables(customer=[{"id": i, "name": f"c{i}"} for i in ids])["customer"].write.parquet(f"{raw}/customer")
        pipeline.build_warehouse(spark, settings, raw, raw, f"{root}/mart", ("dim_customer",))
        return {r.CustomerId: r.CustomerKey for r in pipeline.open_mart(spark, f"{root}/mart")["dim_customer"].collect()}

    assert load(1, [5, 6, 7]) == {5: 1, 6: 2, 7: 3}
    assert load(2, [0, 5, 6]) == {0: 4, 5: 1, 6: 2}
    # The deleted member's number is not handed out again, and it is its own when the member returns.
    assert load(3, [1, 7]) == {1: 5, 7: 3}


def test_a_failing_load_leaves_the_old_table(spark):
    path = folder() + "/t"
    writers.write_full(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    bad = spark.range(4).selectExpr("CAST(id AS int) AS k", "CASE WHEN id = 3 THEN raise_error('no') ELSE 'x' END AS v")
    with pytest.raises(Exception, match="no"):
        writers.write_full(bad, path)
    read = lambda: VersionedTable(spark, path).read("k int, v string")
    assert rows(read()) == [(1, "a")]
    # A load may read what it replaces.
    assert writers.write_full(read().unionByName(spark.createDataFrame([(2, "b")], "k int, v string")), path) == 2
    assert rows(read()) == [(1, "a"), (2, "b")]


def test_a_run_stored_twice_is_there_once(spark):
    path = folder() + "/h"
    shape = "version string, name string, v int"
    run = spark.createDataFrame([("1.10", "m", 1), ("1.10", "n", 2)], shape)
    for frame, version in ((run, "1.10"), (run, "1.10"), (run.withColumn("version", F.lit("2024:rc/1 %")), "2024:rc/1 %")):
        writers.replace_run(frame, path, {"version": version})
    read = lambda **where: rows(VersionedTable(spark, path).read(shape, where), "version", "name", "v")
    assert read() == [("1.10", "m", 1), ("1.10", "n", 2), ("2024:rc/1 %", "m", 1), ("2024:rc/1 %", "n", 2)]
    assert read(version="2024:rc/1 %") == [("2024:rc/1 %", "m", 1), ("2024:rc/1 %", "n", 2)]
    # A repeated run without rows has none afterwards.
    assert writers.replace_run(run.limit(0), path, {"version": "1.10"}) == 0
    assert read() == [("2024:rc/1 %", "m", 1), ("2024:rc/1 %", "n", 2)]
