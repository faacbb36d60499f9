"""What keeps the jobs' time and disk in proportion to their input."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom import MartSettings, schemas
from martloom.operators.distinct import sums_with_distinct
from martloom.operators.latest import position_in_group
from martloom.operators.reduce import only_with
from martloom.plans import changes, dims, facts, measures
from martloom.session import cut_lineage, releasing
from tests.conftest import TENANT

SETTINGS = MartSettings(
    tenant_ids=(TENANT,), from_date=date(2024, 1, 1), to_date=date(2024, 12, 31), period_start=date(2024, 1, 1), period_end=date(2024, 2, 1),
)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_agreements_of_all_periods_are_numbered_once(tables, monkeypatch):
    src = dims.LoadSources(tables(
        serviceagreement=[{"id": i, "startdate": f"2024-01-0{i}", "renewalgroupinitialagreement_id": 1} for i in (1, 2, 3)],
        serviceagreementlocation=[{"id": 7, "serviceagreement_id": 2, "locationid": 5}],
        serviceagreementvisit=[{"id": 1, "serviceagreementlocation_id": 7, "jobid": 9}],
        job=[{"id": 9}], invoice=[{"id": 4, "job_id": 9}],
        invoiceitem=[{"id": 1, "invoice_id": 4, "totalcost": 10, "skureference_skutype": 1}, {"id": 2, "invoice_id": 5, "totalcost": 1}],
        grosspayitem=[{"id": 1, "job_id": 9, "invoice_id": 4, "amount": 3}],
    ))
    calls = []
    for module, name in ((dims, "with_renewal_year"), (measures, "visit_jobs")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _plain=plain, _name=name, **k: calls.append(_name) or _plain(*a, **k))
    spark = src["job"].sparkSession
    for month in (1, 2):
        settings = SETTINGS.with_(period_start=date(2024, month, 1), period_end=date(2024, month + 1, 1))
        stored = cut_lineage(measures.sa_period_measures(src, settings))
        mart = {t: spark.createDataFrame([], schemas.ddl(c)) for t, c in schemas.MART.items()} | {
            "mat_sa_period_measures": stored, "dim_serviceagreement": dims.keyed("dim_serviceagreement", src, settings),
        }
        (row,) = facts.fact_serviceagreement(src, mart, settings).collect()
        assert (row.ServiceAgreementId, row.SARenewalYear, row.ServiceAgreementDimKey, row.LaborCost, row.MaterialCost) == (2, 2, 2, 3, 10)
    assert sorted(calls) == ["visit_jobs", "with_renewal_year"]


def test_many_keys_are_still_left_out_early(spark):
    rows = spark.range(400_000).selectExpr("CAST(id AS INT) AS job", "IF(id % 2 = 0, 1, 2) AS tenant")
    keys = spark.range(300_000).selectExpr("id AS job", "1L AS tenant")
    assert only_with(rows, keys, ["job", "tenant"]).count() == 150_000
    assert only_with(rows, keys, ["job", "tenant"], most=10).count() == 400_000


def test_repeated_ids_that_lie_close_together_are_not_counted_again(spark):
    shape = "k int, id bigint"
    near = [(1, 5), (1, 5), (1, 260), (1, None), (2, -3), (2, -3), (None, 8), (None, 8), (3, None)]
    counted = sums_with_distinct(spark.createDataFrame(near, shape), ["k"], "id", "n")
    assert "strategy=broadcast" in plan(counted)
    assert {r.k: r.n for r in counted.collect()} == {1: 2, 2: 1, None: 1, 3: 0}
    # What is counted again is stored and empty, so the ids are not exchanged for it. 5 and 261 share a place; the ends of all numbers are too far apart to subtract.
    far = [(1, 5), (1, 5), (1, 261), (2, -(2**63)), (2, 2**63 - 1), (2, 2**63 - 1), (None, 0), (None, 256)]
    counted = sums_with_distinct(spark.createDataFrame(far, shape), ["k"], "id", "n")
    assert {r.k: r.n for r in counted.collect()} == {1: 2, 2: 2, None: 2}


@pytest.mark.parametrize("most", [1, 200, 1 << 18])
def test_positions_of_small_and_large_groups(spark, most):
    df = spark.range(3000).selectExpr("IF(id % 10 < 6, NULL, id % 400) AS g", "id", "IF(id % 7 = 0, NULL, date_add(DATE'2024-01-01', CAST(id % 5 AS INT))) AS day")
    expected = df.selectExpr("g", "id", "day", "row_number() OVER (PARTITION BY g ORDER BY day NULLS LAST, id) AS p")
    got = position_in_group(df, ["g"], "day", "id", "p", most=most)
    assert got.columns == expected.columns and got.exceptAll(expected).count() == 0 and got.count() == 3000


def test_a_name_that_many_employees_share_meets_a_job_once(spark, tables):
    src = tables(customfieldtype=[{"id": 1, "name": "Salesperson"}], customfield=[{"id": i, "owner_id": i, "type_id": 1, "value": " Jo "} for i in range(4)])
    people = [(i, TENANT, "Jo", "Employee", 1, 0, 0, 0, 0, None, None) for i in range(50, 20, -1)]
    mart = {"mat_employee_commissionrates": spark.createDataFrame(people, "EmployeeId bigint, TenantId bigint, EmployeeName string, EmployeeType string, "
        "CommissionType int, a int, b int, c int, d int, LoadDateTime timestamp, UpdatedDateTime timestamp")}
    found = facts.job_salespeople(src, mart, SETTINGS)
    assert {(r.JobId, r.EmployeeId) for r in found.collect()} == {(i, 21) for i in range(4)}
    # The employees are reduced below the join.
    assert plan(found).count("Aggregate") == 2
    assert facts.job_salespeople(src, mart, SETTINGS.with_(multi_salesperson="duplicate")).count() == 120


def test_an_invoice_has_one_digest(tables):
    src = tables(
        invoice=[{"id": 1}], invoiceitem=[{"id": 5, "invoice_id": 1}, {"id": 6, "invoice_id": 1}], purchaseorder=[{"id": 2, "invoice_id": 1}],
        grosspayitem=[{"id": 3, "invoice_id": 1}], payrolladjustment=[{"id": 4, "invoice_id": 1}],
        inventorybill=[{"id": 8, "purchaseorder_id": 2}], inventoryshipment=[{"id": 9, "purchaseorder_id": 2}],
    )
    every = [r for kinds in changes.GROUPS for r in changes.digests(src, SETTINGS, kinds).collect()]
    assert sorted((r.kind, r.owner, r["rows"]) for r in every) == [("invoice", 1, 6), ("order", 2, 2)]
    assert sorted(k for kinds in changes.GROUPS for k in kinds) == sorted(changes.WATCHED)


def test_shuffle_files_go_with_the_write(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with releasing(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
    kept = cut_lineage(spark.range(50).groupBy((F.col("id") % 5).alias("k")).count())
    assert spark.conf.get(name) == before and kept.count() == 5
