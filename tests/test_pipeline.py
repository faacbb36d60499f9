"""A whole run over synthetic sources: row counts, identities between tables, re-runs, metrics and snapshot."""

from __future__ import annotations

import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom import MartSettings, schemas
from martloom.operators import quality
from martloom.operators.compare import diff_rows
from martloom.plans import pipeline, report
from martloom.sinks.runlog import RunLog, run_state
from martloom.sinks.writers import write_full
from martloom.sources.readers import read_raw, read_sources
from martloom.sources.synth import SourceGenerator, SynthSettings, generate_sources

SETTINGS = MartSettings(as_of=date(2024, 6, 1))
SIZES = SynthSettings(
    customer=60, employee=10, location=30, gl_account=20, sku=40, service_agreement=24, job=200, invoice=320,
    invoice_item=900,
)


@pytest.fixture(scope="module")
def run(spark):
    root = tempfile.mkdtemp(prefix="martloom-run-")
    generate_sources(spark, f"{root}/raw", f"{root}/ext", SIZES)
    written = pipeline.build_warehouse(spark, SETTINGS, f"{root}/raw", f"{root}/ext", f"{root}/mart")
    return root, written, pipeline.open_mart(spark, f"{root}/mart"), read_sources(spark, f"{root}/raw", f"{root}/ext")


def total(df, expression):
    return df.agg(F.expr(expression)).first()[0]


def test_sources(spark, run):
    src = run[3]
    counts = {r.table: r.actual for r in pipeline.check_sources(src).collect()}
    assert 800 < counts["invoiceitem"] <= 900 and counts["job"] == 200 and counts["customfield"] == 160 + 50
    assert counts["serviceagreementvisit"] == 30
    assert total(src["invoiceitem"], "count(DISTINCT id)") == total(src["invoiceitem"], "max(id)") == counts["invoiceitem"]
    assert src["customer"].filter("active = 0").count() == 3
    assert src["invoice"].filter("adjustmentto_id IS NOT NULL").count() == 16
    assert src["generalledger.journalentry"].filter("postdate > '2024-12-31'").count() == 0
    with pytest.raises(KeyError):
        read_sources(spark, f"{run[0]}/nowhere", f"{run[0]}/ext")["job"]
    elsewhere = pipeline.check_sources(read_sources(spark, f"{run[0]}/nowhere", f"{run[0]}/ext"), {"job": 1, "report.dim_employee": 1})
    assert {r.table: r.ok for r in elsewhere.collect()} == {"job": False, "report.dim_employee": True}
    orphan = src["inventorybill"].join(
        src["purchaseorder"].select(F.col("id").alias("purchaseorder_id")), "purchaseorder_id", "left_anti"
    )
    assert orphan.count() == 0


def test_generation_is_repeatable(spark, run):
    root = tempfile.mkdtemp(prefix="martloom-run-")
    generator = SourceGenerator(spark, f"{root}/raw", f"{root}/ext", SIZES)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        generator.invoices()
        generator.purchases()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for name in ("invoiceitem", "purchaseorder", "inventoryshipment"):
        assert read_raw(spark, f"{root}/raw", name).exceptAll(run[3][name]).count() == 0


def test_rows_per_table(run):
    _, written, mart, src = run
    expected = {
        "dim_date": 4018, "dim_tenant": 1, "dim_businessunit": 10, "dim_customer": 60, "dim_employee": 10,
        "dim_glaccount": 20, "dim_job": 200, "dim_jobtype": 20, "dim_location": 30, "dim_serviceagreement": 24,
        "dim_sku": 40, "mat_employee_commissionrates": 10, "mat_invoice_revenue": 320, "fact_invoice": 320,
        "fact_invoiceitem": src["invoiceitem"].count(), "fact_serviceagreement": written["mat_sa_period_measures"],
    }
    assert {table: written[table] for table in expected} == expected
    assert all(count > 0 for count in written.values())
    assert {r.table: r.actual for r in quality.min_rows(mart, written).collect()} == written


def test_identities(run):
    mart, src = run[2], run[3]
    invoices = mart["fact_invoice"]
    assert invoices.filter("TotalPOCost <> POUnbilledCost + POBilledCost").count() == 0
    assert invoices.filter("abs(TotalItemCost - EquipmentCost - MaterialCost) > 0.01").count() == 0  # each is rounded
    assert total(invoices, "sum(LineItemCount)") == mart["fact_invoiceitem"].count()
    assert total(invoices, "sum(TotalRevenue)") == total(src["invoiceitem"], "CAST(sum(total) AS decimal(20,2))")
    jobs = report.report_jobs_side(mart, SETTINGS)
    assert jobs.filter("JobMargin <> JobRevenue - JobCost").count() == 0
    assert jobs.select("JobId").join(mart["dim_job"].filter("ServiceAgreementId IS NOT NULL"), "JobId").count() == 0


def test_declared_keys_and_required_columns(run):
    mart = run[2]
    for table, keys in schemas.UNIQUE_KEYS.items():
        assert quality.duplicate_keys(mart[table], keys).count() == 0, table
    for table, columns in schemas.REQUIRED.items():
        assert total(quality.null_counts(mart[table], columns), "sum(nulls)") == 0, table
    unresolved = {
        r.column: r.nulls
        for r in quality.null_counts(mart["fact_invoice"], schemas.DIMENSION_KEYS["fact_invoice"]).collect()
    }
    assert unresolved.pop("EmployeeKey") > 0 and set(unresolved.values()) == {0}


def test_the_line_filter_by_unique_ids_changes_nothing(run):
    mart, src = run[2], run[3]
    plain = pipeline.build("mat_invoice_revenue", None, src, mart, SETTINGS.with_(line_ids_unique=True))
    columns = [c for c in plain.columns if c not in ("LoadDateTime", "UpdatedDateTime")]
    assert diff_rows(mart["mat_invoice_revenue"].select(columns), plain.select(columns), ["InvoiceId", "TenantId"]).count() == 0


def test_run_log_and_rerun(spark, run):
    root, written, mart, _ = run
    state = run_state(RunLog(spark, f"{root}/mart/etl_run_log").read())
    assert state.filter("LastRunStatus <> 'SUCCESS'").count() == 0
    assert total(state, "sum(RowsProcessed)") == sum(written.values())
    before = total(mart["fact_serviceagreement"], "sum(RevenueRecognitionAmount)")
    tables = ("mat_sa_period_measures", "fact_serviceagreement", "dim_sku")
    again = pipeline.build_warehouse(spark, SETTINGS, f"{root}/raw", f"{root}/ext", f"{root}/mart", tables)
    assert again == {table: written[table] for table in tables}
    reread = pipeline.open_mart(spark, f"{root}/mart")
    assert total(reread["fact_serviceagreement"], "sum(RevenueRecognitionAmount)") == before


def test_metrics_and_snapshot(spark, run):
    root, _, _, _ = run
    mart = pipeline.open_mart(spark, f"{root}/mart")
    first, errors = pipeline.track_metrics(spark, f"{root}/mart", "1", date(2024, 6, 1), "first", SETTINGS)
    values = {r.name: r for r in first.collect()}
    assert not errors and len(values) == 9
    assert values["job_revenue_total"].value == total(report.report_jobs_side(mart, SETTINGS), "sum(JobRevenue)")
    assert values["invoice_count"].value == 320 and values["invoice_count"].previous_value is None
    second, _ = pipeline.track_metrics(
        spark, f"{root}/mart", "2", date(2024, 6, 2), "second", SETTINGS,
        sql_metrics=[
            {"name": "invoice_count", "query": "SELECT count(*) + 1 AS metric_value, count(*) AS metric_count FROM invoice_metrics"},
            {"name": "broken", "query": "SELECT nothing FROM nowhere"},
        ],
    )
    (row,) = second.collect()
    assert (row.previous_version, row.difference) == ("1", 1)
    assert pipeline.open_mart(spark, f"{root}/mart")["mat_metric_summary"].count() == 10
    again, _ = pipeline.track_metrics(spark, f"{root}/mart", "1", date(2024, 6, 1), "first", SETTINGS)
    assert {r.name: r.value for r in again.collect()} == {name: r.value for name, r in values.items()}
    assert pipeline.open_mart(spark, f"{root}/mart")["mat_metric_summary"].count() == 10
    assert pipeline.compare_baselines(spark, f"{root}/mart", "1", "2").count() == 0
    snapshot = pipeline.open_mart(spark, f"{root}/mart")["mat_report_baseline"]
    runs = {r.RUN_VERSION: r.n for r in snapshot.groupBy("RUN_VERSION").agg(F.count("*").alias("n")).collect()}
    assert runs["1"] == runs["2"] == report.commission_report(mart, SETTINGS).count()
    assert pipeline.read_baseline(spark, f"{root}/mart", "2").count() == runs["2"]
    with pytest.raises(KeyError):
        pipeline.open_mart(spark, f"{root}/nowhere")["mat_report_baseline"]


def test_an_empty_window_loads_no_rows(spark, run):
    root, _, _, src = run
    mart = pipeline.open_mart(spark, f"{root}/mart")
    settings = SETTINGS.with_(from_date=date(2025, 9, 1), to_date=date(2024, 11, 30))
    for table in ("mat_invoice_revenue", "mat_invoice_pocosts", "mat_job_returns", "fact_invoiceitem"):
        assert write_full(pipeline.build(table, spark, src, mart, settings), f"{root}/empty/{table}") == 0


def test_a_metric_file_from_end_to_end(spark, run, tmp_path):
    root = run[0]
    path = tmp_path / "metrics.yaml"
    path.write_text(
        """
version: 1.10
run_date: 2024-06-03
description: from a file
parameters: {from_date: "2024-01-01", to_date: "2024-12-31", tenant_ids: [3457543957], employee_id_specified: 0, employee_ids: [4], filter_status_specified: 1, filter_status: [2]}
metrics:
  - {name: jobs, category: job, query: "SELECT count(*) AS metric_value, count(*) AS metric_count FROM job_metrics WHERE PostedDate >= :from_date AND (:employee_id_specified = 0 OR array_contains(:employee_ids, EmployeeId))"}
  - {name: many, query: "SELECT JobId AS metric_value, 1 AS metric_count FROM job_metrics"}
  - {name: none, query: "SELECT 1 AS metric_value, 1 AS metric_count FROM job_metrics WHERE false"}
  - {name: injected, query: "SELECT :no_such AS metric_value, 1 AS metric_count"}
comparison: {tolerance_pct: 0.05}
"""
    )
    given = pipeline.metrics.load_metric_file(str(path), SETTINGS)
    assert (given.version, given.run_date, given.tolerance) == ("1.1", date(2024, 6, 3), 0.05)
    assert given.settings.employee_ids == () and given.settings.status_filter == (2,)
    compared, errors = pipeline.track_metric_file(spark, f"{root}/mart", str(path), SETTINGS)
    assert set(errors) == {"many", "none", "injected"} and "more than one row" in errors["many"] and "no row" in errors["none"]
    (row,) = compared.collect()
    assert row.name == "jobs" and row.value > 0
    stored = pipeline.open_mart(spark, f"{root}/mart")["mat_metric_summary"].filter("RUN_VERSION = '1.1'").collect()
    assert [(r.METRIC_NAME, r.RUN_DESCRIPTION) for r in stored] == [("jobs", "from a file")]
    assert pipeline.read_baseline(spark, f"{root}/mart", "1.1").count() > 0


def test_the_report_comes_in_order(run):
    rows = report.commission_report(run[2], SETTINGS).collect()
    def place(r):
        first = r["JobId"] if r["JobId"] is not None else r["ServiceAgreementId"]
        return (first is None, first or 0), (r["InvoiceId"] is None, r["InvoiceId"] or "")

    assert len(rows) > 200 and [place(r) for r in rows] == sorted(place(r) for r in rows)


def test_report_filters(run):
    mart = run[2]
    everyone = report.report_jobs_side(mart, SETTINGS)
    some = [r[0] for r in everyone.select("EmployeeId").distinct().collect() if r[0] is not None][:2]
    chosen = report.report_jobs_side(mart, SETTINGS.with_(employee_ids=tuple(some)))
    assert 0 < chosen.count() == everyone.filter(F.col("EmployeeId").isin(some)).count() < everyone.count()
    assert report.report_jobs_side(mart, SETTINGS.with_(status_filter=(3,))).count() == 0
