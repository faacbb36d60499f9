"""Hand-written rows with hand-computed results for dimensions, measures and facts."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from martloom import MartSettings
from martloom.operators.keys import dense_key
from martloom.plans import dims, facts, measures

S = MartSettings(tenant_ids=(1,), from_date=date(2024, 1, 1), to_date=date(2024, 12, 31),
                 period_start=date(2024, 1, 1), period_end=date(2024, 1, 31))
INVOICE = {"job_id": 10, "invoicedon": "2024-05-01", "modifiedon": "2024-05-02", "trans_number": "I", "status": 2}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_income_counts_unknown_types_and_mentions_of_income(tables):
    src = tables(
        invoice=[{"id": 1, **INVOICE}, {"id": 2, **INVOICE}, {"id": 3, **INVOICE, "status": 1},
                 {"id": 4, **INVOICE, "active": 0}, {"id": 5, **INVOICE, "invoicedon": "2025-01-01"},
                 {"id": 6, **INVOICE, "_tenant_id": 2}],
        invoiceitem=[
            {"id": 1, "invoice_id": 1, "generalledgeraccount_id": 1, "total": "10.00"},
            {"id": 2, "invoice_id": 1, "generalledgeraccount_id": 2, "total": "20.00"},
            {"id": 3, "invoice_id": 1, "generalledgeraccount_id": 3, "total": "40.00"},
            {"id": 4, "invoice_id": 1, "generalledgeraccount_id": 9, "total": "80.00"},
            {"id": 5, "invoice_id": 1, "generalledgeraccount_id": 1, "total": "1000.00", "active": 0},
            {"id": 4, "invoice_id": 1, "generalledgeraccount_id": 3, "total": "0.005"},
        ],
        generalledgeraccount=[{"id": 1, "type_id": 1}, {"id": 2, "type_id": 2}, {"id": 3, "type_id": 3}],
        generalledgeraccounttype=[{"id": 1, "name": "Income"}, {"id": 2, "name": "Other INCOME"}, {"id": 3, "name": "Expense"}],
    )
    columns = ("InvoiceId", "TotalRevenue", "IncomeRevenue", "LineItemCount")
    assert rows(measures.invoice_revenue(src, S), *columns) == [
        (1, D("150.01"), D("110.00"), 4),
        (2, D("0.00"), D("0.00"), 0),
    ]
    assert by(measures.invoice_revenue(src, S.with_(line_ids_unique=True)), "InvoiceId")[1].LineItemCount == 5


def test_material_and_equipment_ids_may_clash(tables):
    src = tables(
        invoice=[{"id": 1, **INVOICE}, {"id": 2, **INVOICE}],
        material=[{"id": 7}], equipment=[{"id": 7}, {"id": 8}],
        invoiceitem=[
            {"id": 1, "invoice_id": 1, "totalcost": "1", "skureference_skutype": 1, "skureference_skuid": 7},
            {"id": 2, "invoice_id": 1, "totalcost": "2", "skureference_skutype": 2, "skureference_skuid": 7},
            {"id": 3, "invoice_id": 1, "totalcost": "4", "skureference_skutype": 1, "skureference_skuid": 8},
            {"id": 4, "invoice_id": 1, "totalcost": "8"},
            {"id": 5, "invoice_id": 1, "totalcost": "16", "skureference_skutype": 2, "skureference_skuid": 8,
             "procurementsource_purchaseorderitemid": 99},
            {"id": 6, "invoice_id": 2, "totalcost": "32", "skureference_skutype": 3, "skureference_skuid": 7},
        ],
    )
    assert rows(
        measures.invoice_material_costs(src, S), "InvoiceId", "EquipmentCost", "MaterialCost", "TotalItemCost"
    ) == [(1, D("2.00"), D("1.00"), D("3.00"))]


def test_purchase_order_states(tables):
    """1: nothing; 2: shipment without bill id; 3: shipment with bill id and a bill; 4: bill without shipment."""
    src = tables(
        invoice=[{"id": 1, **INVOICE}],
        purchaseorder=[{"id": i, "invoice_id": 1, "amount": 10**i, "modifiedon": f"2024-06-0{i}"} for i in (1, 2, 3, 4)],
        inventoryshipment=[{"id": 1, "purchaseorder_id": 2}, {"id": 2, "purchaseorder_id": 3, "bill_id": 5},
                           {"id": 3, "purchaseorder_id": 1, "bill_id": 6, "active": 0}],
        inventorybill=[{"id": 5, "purchaseorder_id": 3, "total": "7"}, {"id": 6, "purchaseorder_id": 4, "total": "5"},
                       {"id": 7, "purchaseorder_id": 4, "total": "1"}],
    )
    (row,) = measures.invoice_po_costs(src, S).collect()
    assert (row.POUnbilledCost, row.POBilledCost, row.TotalPOCost, row.POCount) == (
        D("10110.00"), D("13.00"), D("10123.00"), 4,
    )
    assert row.LastPOModifiedOn == datetime(2024, 6, 4)


PAY = {"job_id": 10, "invoice_id": 1, "technician_id": 5}


@pytest.fixture(scope="module")
def labor_source(tables):
    return tables(
        invoice=[{"id": i, **INVOICE} for i in (1, 2, 3)],
        technician=[{"id": 5, "burdenrate": "2.50"}],
        grosspayitem=[
            {"id": 1, **PAY, "amount": "100", "paiddurationhours": "4", "grosspayitemtype": 2, "burdencostamount": "9"},
            {"id": 2, **PAY, "amount": "50", "paiddurationhours": "2", "grosspayitemtype": 5, "burdencostamount": "0",
             "_record_updated_ts_utc": "2024-02-02 00:00:00"},
        ],
        employeegrosspayitem=[
            {"id": 1, "job_id": 10, "invoice_id": 2, "employee_id": 5, "amount": "10", "paiddurationhours": "3",
             "grosspayitemtype": 1, "_record_updated_ts_utc": "2024-03-03 00:00:00"},
        ],
        payrolladjustment=[{"id": 1, "invoice_id": 1, "amount": "-7", "_record_updated_ts_utc": "2024-04-04 00:00:00"}],
        employeepayrolladjustment=[
            {"id": 1, "invoice_id": 1, "amount": "3", "_record_updated_ts_utc": "2024-04-05 00:00:00"},
        ],
    )


LABOR = ("RegularLaborCost", "PieceworkCost", "LaborBurdenCost", "PayrollAdjustmentCost", "TotalLaborCost",
         "RegularLaborHours", "PieceworkHours")


def test_labor_sides_are_summed_once(labor_source):
    got = by(measures.invoice_labor_costs(labor_source, S), "InvoiceId")
    assert set(got) == {1, 2}
    assert [got[1][c] for c in LABOR] == [D(v) for v in ("100", "0", "14", "-4", "160", "4", "0")]
    assert [got[2][c] for c in LABOR] == [D(v) for v in ("0", "10", "7.5", "0", "17.5", "0", "3")]
    # One pay line has no time of its own, so the adjustments' time counts for it.
    assert got[1].LastLaborModifiedOn == datetime(2024, 4, 5)
    assert got[2].LastLaborModifiedOn == datetime(2024, 3, 3)


def test_labor_multiplied_like_a_join_of_both_sides(labor_source):
    got = by(measures.invoice_labor_costs(labor_source, S.with_(labor_fanout="reference")), "InvoiceId")
    assert [got[1][c] for c in LABOR] == [D(v) for v in ("200", "0", "28", "-8", "320", "8", "0")]
    assert [got[2][c] for c in LABOR] == [D(v) for v in ("0", "10", "7.5", "0", "17.5", "0", "3")]


def test_returns_are_negative_and_an_inverted_window_is_empty(tables):
    back = {"job_id": 3, "datereturned": "2024-02-01", "createdon": "2024-02-03 10:00:00"}
    src = tables(inventoryreturn=[
        {"id": 1, **back, "amount": "5"}, {"id": 2, **back, "amount": "6", "createdon": "2024-02-04 10:00:00"},
        {"id": 3, **back, "amount": "7", "active": 0}, {"id": 4, **back, "amount": "8", "job_id": None},
    ])
    assert rows(measures.job_returns(src, S), "JobId", "LastReturnDate", "TotalReturnCredit", "ReturnCount") == [
        (3, date(2024, 2, 4), D("-11.00"), 2)
    ]
    assert measures.job_returns(src, S.with_(from_date=date(2025, 9, 1), to_date=date(2024, 11, 30))).count() == 0


def test_rates_take_the_latest_readable_value(tables):
    field = {"owner_id": 1}
    src = tables(
        employee=[{"id": 1, "name": "A"}, {"id": 2, "name": "B"}, {"id": 3, "name": "C", "active": 0}],
        customfieldtype=[{"id": 1, "name": "Salesperson", "ownertype": 4}, {"id": 2, "name": "Commission Type", "ownertype": 32},
                         {"id": 3, "name": "Job Commission%", "ownertype": 96}, {"id": 4, "name": "SA Year 1 Commission%", "ownertype": 32},
                         {"id": 5, "name": "SAYear2Commission%", "ownertype": 32}],
        customfield=[
            {"id": 1, **field, "type_id": 3, "value": "1", "createdon": "2024-01-01 00:00:00"},
            {"id": 2, **field, "type_id": 3, "value": "5.005", "createdon": "2024-01-02 00:00:00"},
            {"id": 3, **field, "type_id": 3, "value": "99"},
            {"id": 4, **field, "type_id": 4, "value": "abc", "createdon": "2024-01-01 00:00:00"},
            {"id": 5, **field, "type_id": 5, "value": "7", "createdon": "2024-01-01 00:00:00"},
            {"id": 6, **field, "type_id": 5, "value": "8", "createdon": "2024-01-01 00:00:00"},
            {"id": 7, **field, "type_id": 2, "value": "2.5", "createdon": "2024-01-01 00:00:00"},
            {"id": 8, **field, "type_id": 1, "value": "B", "createdon": "2024-01-01 00:00:00"},
            {"id": 9, "owner_id": 3, "type_id": 3, "value": "4", "createdon": "2024-01-01 00:00:00"},
        ],
    )
    (row,) = measures.employee_commission_rates(src, S).collect()
    assert row.EmployeeId == 1 and row.CommissionType == 3
    assert (row.JobCommissionPct, row.SAYear1CommissionPct, row.SAYear2CommissionPct, row.SAYear3PlusCommissionPct) == (
        D("5.01"), D(0), D(8), D(0),
    )


def agreement(number, start, group=1, **more):
    return {"id": number, "startdate": start, "renewalgroupinitialagreement_id": group, "customerid": 1,
            "businessunitid": 1, "soldbyid": 1, "name": f"SA-{number}", "templateinstance_id": 1, "status": 3, **more}


def test_renewal_years(tables):
    src = tables(serviceagreement=[
        agreement(1, "2021-01-01"), agreement(2, "2023-01-01"), agreement(3, "2022-01-01"),
        agreement(4, "2020-01-01", active=0), agreement(5, "2022-01-01"), agreement(6, "2019-01-01", group=None),
        agreement(7, "2018-01-01", group=None), agreement(8, None), agreement(9, "2021-01-01", group=2),
    ])
    got = rows(dims.with_renewal_year(src["serviceagreement"]), "id", "RenewalYear")
    assert got == [(1, 1), (2, 4), (3, 2), (4, 1), (5, 3), (6, 2), (7, 1), (8, 5), (9, 1)]


def test_agreement_dimension_has_one_row_per_agreement(tables):
    src = tables(
        serviceagreement=[agreement(1, "2021-01-01"), agreement(2, "2021-01-01", group=2, status=9, templateinstance_id=4)],
        serviceagreementtemplate=[{"id": 1, "name": "Basic"}],
        serviceagreementlocation=[{"id": 1, "serviceagreement_id": 1, "locationid": 30}, {"id": 2, "serviceagreement_id": 1, "locationid": 20},
                                  {"id": 3, "serviceagreement_id": 1, "locationid": 10, "active": 0}],
    )
    got = dims.keyed("dim_serviceagreement", src, S)
    assert rows(got, "ServiceAgreementKey", "ServiceAgreementId", "LocationId", "TemplateName", "StatusName") == [
        (1, 1, 20, "Basic", "Active"), (2, 2, None, None, "Unknown"),
    ]


PERIOD_JOURNAL = [("2023-12-31", 1), ("2024-01-01", 10), ("2024-01-30", 100), ("2024-01-31", 1000)]


@pytest.fixture(scope="module")
def agreement_source(tables):
    return tables(
        serviceagreement=[agreement(1, "2024-01-01"), agreement(2, "2024-01-01", group=2), agreement(3, "2024-01-01", group=3),
                          agreement(4, "2024-01-01", group=4, active=0)],
        generalledger__journalentry=[{"id": i, "postdate": day} for i, (day, _) in enumerate(PERIOD_JOURNAL)],
        generalledger__journalentryitem=[
            {"id": i, "journalentryid": i, "serviceagreementid": 1, "amount": amount, "transactiontype": 11, "entrytype": 1}
            for i, (_, amount) in enumerate(PERIOD_JOURNAL)
        ] + [{"id": 9, "journalentryid": 1, "serviceagreementid": 1, "amount": 5, "transactiontype": 10, "entrytype": 1},
             {"id": 10, "journalentryid": 1, "serviceagreementid": 4, "amount": 5, "transactiontype": 11, "entrytype": 1}],
        serviceagreementlocation=[{"id": 1, "serviceagreement_id": 2, "locationid": 1}, {"id": 2, "serviceagreement_id": 2, "locationid": 2}],
        serviceagreementvisit=[{"id": 1, "serviceagreementlocation_id": 1, "jobid": 10}, {"id": 2, "serviceagreementlocation_id": 2, "jobid": 10},
                               {"id": 3, "serviceagreementlocation_id": 2, "jobid": 11}],
        job=[{"id": 10}, {"id": 11, "active": 0}],
        invoice=[{"id": 1, **INVOICE}, {"id": 2, **INVOICE, "status": 1, "invoicedon": "2024-01-15"}],
        grosspayitem=[{"id": 1, **PAY, "amount": "3", "burdencostamount": "1"}, {"id": 2, **PAY, "invoice_id": 2, "amount": "4"}],
        invoiceitem=[{"id": 1, "invoice_id": 1, "totalcost": "20", "skureference_skutype": 1},
                     {"id": 2, "invoice_id": 2, "totalcost": "30", "skureference_skutype": 2},
                     {"id": 3, "invoice_id": 2, "totalcost": "50"}],
    )


AGREEMENT = ("ServiceAgreementId", "RevenueRecognitionAmount", "LaborCost", "BurdenCost", "MaterialCost", "EquipmentCost")


def test_period_ends_and_repeated_visits(agreement_source):
    got = rows(measures.sa_period_measures(agreement_source, S), *AGREEMENT)
    assert got == [
        (1, D("110.00"), D(0), D(0), D(0), D(0)),
        (2, D(0), D("14.00"), D("2.00"), D("40.00"), D("60.00")),
    ]


def test_costs_can_be_limited_to_the_period(agreement_source):
    got = rows(measures.sa_period_measures(agreement_source, S.with_(filter_costs_by_period=True)), *AGREEMENT)
    assert got[1] == (2, D(0), D("8.00"), D(0), D(0), D("60.00"))


def test_two_salespeople(spark, tables):
    src = tables(
        customfieldtype=[{"id": 1, "name": "Job Salesperson", "ownertype": 4}, {"id": 2, "name": "Other", "ownertype": 4}],
        customfield=[
            {"id": 1, "owner_id": 10, "type_id": 1, "value": " Bea "}, {"id": 2, "owner_id": 10, "type_id": 1, "value": "Al"},
            {"id": 3, "owner_id": 10, "type_id": 1, "value": "Bea"}, {"id": 4, "owner_id": 11, "type_id": 1, "value": "Cy", "active": 0},
            {"id": 5, "owner_id": 12, "type_id": 2, "value": "Al"}, {"id": 6, "owner_id": 13, "type_id": 1, "value": "Nobody"},
        ],
    )
    mart = {"mat_employee_commissionrates": spark.createDataFrame(
        [(2, 1, "Al "), (1, 1, "Bea"), (3, 1, "Cy"), (4, 2, "Al")], "EmployeeId bigint, TenantId bigint, EmployeeName string")}
    assert rows(facts.job_salespeople(src, mart, S), "JobId", "EmployeeId") == [(10, 1)]
    assert rows(facts.job_salespeople(src, mart, S.with_(multi_salesperson="duplicate")), "JobId", "EmployeeId") == [
        (10, 1), (10, 2),
    ]


def test_calendar(spark):
    days = by(dims.dim_date(spark, date(2020, 1, 1), date(2030, 12, 31), fiscal_start_month=10, as_of=date(2024, 12, 30)), "Date")
    assert len(days) == 4018
    monday = days[date(2024, 12, 30)]
    assert (monday.DateKey, monday.DayOfWeek, monday.DayName, monday.WeekOfYear, monday.MonthName) == (20241230, 1, "Mon", 1, "Dec")
    assert (monday.WeekBeginDate, monday.WeekEndDate) == (date(2024, 12, 29), date(2025, 1, 4))
    assert (monday.FiscalYear, monday.FiscalQuarter, monday.FiscalMonth) == (2025, 1, 3)
    assert monday.IsCurrentDay and days[date(2025, 1, 4)].IsCurrentWeek and not days[date(2025, 1, 5)].IsCurrentWeek
    leap = days[date(2024, 2, 29)]
    assert (leap.DayOfYear, leap.MonthEndDate, leap.QuarterEndDate, leap.IsWeekday) == (60, date(2024, 2, 29), date(2024, 3, 31), True)
    sunday = days[date(2020, 1, 5)]
    assert sunday.DayOfWeek == 0 and sunday.IsWeekend and not sunday.IsWeekday and sunday.HolidayName is None


def test_dense_key_does_not_depend_on_layout(spark):
    ids = spark.range(5000).selectExpr("(id * 7919) % 5000 AS id", "id % 3 AS tenant")
    first = dense_key(ids.repartition(7), "k", ["id", "tenant"])
    second = dense_key(ids.orderBy("tenant").repartition(3, "tenant"), "k", ["id", "tenant"])
    assert rows(first, "k", "id") == rows(second, "k", "id") == [(i + 1, i) for i in range(5000)]
    assert dense_key(ids.limit(0), "k", ["id"]).count() == 0
