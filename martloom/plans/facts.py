"""Facts P19-P21. ``mart`` holds the dimensions and measures written by the earlier layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from martloom import schemas
from martloom.functions.money import is_income, or_zero
from martloom.operators.keys import clustered, unique_key
from martloom.operators.reduce import only_with
from martloom.operators.star import Lookup, star_lookup
from martloom.plans.dims import Sources, active, attributes_of_agreements, of_tenants
from martloom.plans.measures import posted_invoices
from martloom.settings import MartSettings

Mart = Mapping[str, DataFrame]
_INVOICE = ["InvoiceId", "TenantId"]
_JOB = ["JobId", "TenantId"]


def _date_key(mart: Mart, column: str) -> Lookup:
    """J16. A calendar has one row per day - some hundred thousand for a thousand years - so it is always broadcast."""
    return Lookup(F.broadcast(mart["dim_date"]), {column: "Date"}, {"DateKey": "DateKey"})


def _dimension(mart: Mart, table: str, column: str, natural: str, key: str, alias: str | None = None) -> Lookup:
    return Lookup(mart[table], {column: natural, "TenantId": "TenantId"}, {key: alias or key})


def _finished(rows: DataFrame, table: str, key: str, layout: list[str], settings: MartSettings) -> DataFrame:
    if settings.cluster_facts:
        rows = clustered(rows, layout)
    return schemas.conform(unique_key(rows, key), schemas.MART[table])


def job_context(jobs: DataFrame, mart: Mart) -> DataFrame:
    """Dimension keys of each job. Resolved once per job, so facts with many rows per job need a single join."""
    base = jobs.select(
        F.col("id").alias("JobId"), F.col("_tenant_id").alias("TenantId"),
        "customer_id", "location_id", "businessunit_id", "type_id",
    )
    return star_lookup(
        base,
        [
            _dimension(mart, "dim_job", "JobId", "JobId", "JobKey"),
            _dimension(mart, "dim_customer", "customer_id", "CustomerId", "CustomerKey"),
            _dimension(mart, "dim_location", "location_id", "LocationId", "LocationKey"),
            _dimension(mart, "dim_businessunit", "businessunit_id", "BusinessUnitId", "BusinessUnitKey"),
            _dimension(mart, "dim_jobtype", "type_id", "JobTypeId", "JobTypeKey"),
        ],
    ).drop("customer_id", "location_id", "businessunit_id", "type_id")


def job_salespeople(src: Sources, mart: Mart, settings: MartSettings) -> DataFrame:
    """Employees named in a job's salesperson field (J11, J12, F14); one per job unless duplicates are asked for."""
    types = (
        src["customfieldtype"].filter(active() & F.col("name").ilike("%Salesperson%"))
        .select(F.col("id").alias("type_id"), "_tenant_id")
    )
    people = mart["mat_employee_commissionrates"].select(
        "EmployeeId", F.col("TenantId").alias("_tenant_id"), F.trim("EmployeeName").alias("person")
    )
    if settings.multi_salesperson != "duplicate":
        # Only the lowest id counts in the end, so a name that many employees share meets its jobs once.
        people = people.groupBy("person", "_tenant_id").agg(F.min("EmployeeId").alias("EmployeeId"))
    named = (
        of_tenants(src["customfield"], settings).filter(active())
        .select(F.col("owner_id").alias("JobId"), "_tenant_id", "type_id", F.trim("value").alias("person"))
        .join(types, ["type_id", "_tenant_id"])
        .join(people, ["person", "_tenant_id"])
        .select("JobId", F.col("_tenant_id").alias("TenantId"), "EmployeeId")
    )
    if settings.multi_salesperson == "duplicate":
        return named.distinct()
    return named.groupBy(*_JOB).agg(F.min("EmployeeId").alias("EmployeeId"))


def fact_invoice(src: Sources, mart: Mart, settings: MartSettings) -> DataFrame:
    """One row per invoice of the revenue measure, with the other measures (0 where absent) and dimension keys.

    The measure tables and the invoices share the key (invoice, tenant), the job parts share (job, tenant): one shuffle
    of the invoices for each of the two.
    """
    costs = {
        "mat_invoice_materialcosts": ("EquipmentCost", "MaterialCost", "TotalItemCost"),
        "mat_invoice_pocosts": ("POUnbilledCost", "POBilledCost", "TotalPOCost", "POCount"),
        "mat_invoice_laborcosts": (
            "RegularLaborCost", "PieceworkCost", "LaborBurdenCost", "PayrollAdjustmentCost", "TotalLaborCost",
            "RegularLaborHours", "PieceworkHours",
        ),
    }
    rows = mart["mat_invoice_revenue"].drop("LoadDateTime", "UpdatedDateTime", "InvoiceModifiedOn")
    rows = rows.join(
        src["invoice"].select(
            F.col("id").alias("InvoiceId"), F.col("_tenant_id").alias("TenantId"),
            F.col("adjustmentto_id").alias("AdjustmentToInvoiceId"),
        ),
        _INVOICE,
    )
    for table, columns in costs.items():
        rows = rows.join(mart[table].select(*_INVOICE, *columns), _INVOICE, "left")
    measured = [c for columns in costs.values() for c in columns]
    measured += ["TotalRevenue", "IncomeRevenue", "LineItemCount"]
    rows = (
        rows.withColumns(
            {
                **{c: or_zero(F.col(c)) for c in measured},
                "IsAdjustment": F.col("AdjustmentToInvoiceId").isNotNull(),
            }
        )
        .join(job_context(src["job"], mart), _JOB)
        .join(job_salespeople(src, mart, settings), _JOB, "left")
    )
    rows = star_lookup(
        rows,
        [
            _dimension(mart, "dim_employee", "EmployeeId", "EmployeeId", "EmployeeKey"),
            _date_key(mart, "InvoiceDate"),
        ],
    )
    return _finished(rows, "fact_invoice", "InvoiceKey", ["PostedDate", "InvoiceId"], settings)


def fact_invoiceitem(src: Sources, mart: Mart, settings: MartSettings) -> DataFrame:
    """P20: active lines of posted invoices in the window. Everything an invoice knows is resolved per invoice first."""
    invoices = star_lookup(
        posted_invoices(src, settings)
        .select(*_INVOICE, "JobId", "PostedDate")
        .join(job_context(src["job"].filter(active()), mart), _JOB),
        [_date_key(mart, "PostedDate")],
    )
    lines = (
        of_tenants(src["invoiceitem"], settings).filter(active())
        .select(
            F.col("id").alias("InvoiceItemId"),
            F.col("invoice_id").alias("InvoiceId"),
            F.col("_tenant_id").alias("TenantId"),
            F.col("description").alias("ItemDescription"),
            F.col("skureference_skutype").alias("SKUType"),
            F.col("total").alias("ItemRevenue"),
            F.col("quantity").alias("ItemQuantity"),
            F.col("totalcost").alias("ItemCost"),
            F.col("procurementsource_purchaseorderitemid").alias("POItemId"),
            "skureference_skuid",
            "generalledgeraccount_id",
        )
    )
    rows = star_lookup(
        lines.join(invoices, _INVOICE),
        [
            Lookup(
                mart["dim_glaccount"], {"generalledgeraccount_id": "GLAccountId", "TenantId": "TenantId"},
                {"GLAccountKey": "GLAccountKey", "GLAccountType": "GLAccountType"},
            ),
            Lookup(
                mart["dim_sku"], {"skureference_skuid": "SKUId", "SKUType": "SKUType", "TenantId": "TenantId"},
                {"SKUKey": "SKUKey"},
            ),
        ],
    ).withColumns(
        {
            "IsIncome": is_income(F.col("GLAccountType")),
            "IsPOItem": F.col("POItemId").isNotNull(),
            "InvoicedOn": F.col("PostedDate"),
            "InvoiceDate": F.col("PostedDate"),
        }
    )
    return _finished(rows, "fact_invoiceitem", "InvoiceItemKey", ["PostedDate", "InvoiceId", "InvoiceItemId"], settings)


def fact_serviceagreement(src: Sources, mart: Mart, settings: MartSettings) -> DataFrame:
    """The period's agreement measures with attributes, dimension keys and the seller's rates."""
    measures = mart["mat_sa_period_measures"].filter(
        (F.col("PeriodStartDate") == F.lit(settings.period_start))
        & (F.col("PeriodEndDate") == F.lit(settings.period_end))
        & F.col("TenantId").isin(*settings.tenant_ids)
    ).drop("LoadDateTime", "UpdatedDateTime")
    agreements = (
        attributes_of_agreements(src, settings).filter(active())
        .select(
            F.col("id").alias("ServiceAgreementId"),
            F.col("_tenant_id").alias("TenantId"),
            F.col("name").alias("SAName"),
            F.col("TemplateName").alias("SATemplateType"),
            F.col("startdate").cast("date").alias("SAStartDate"),
            F.col("enddate").cast("date").alias("SAEndDate"),
            F.col("RenewalYear").alias("SARenewalYear"),
            F.col("status").alias("SAStatus"),
            "customerid", "businessunitid", "soldbyid", "LocationId",
        )
    )
    key = ["ServiceAgreementId", "TenantId"]
    percents = ("JobCommissionPct", "SAYear1CommissionPct", "SAYear2CommissionPct", "SAYear3PlusCommissionPct")
    rows = star_lookup(
        # Most agreements have nothing in a period.
        measures.join(only_with(agreements, measures, key), key),
        [
            Lookup(
                only_with(mart["dim_serviceagreement"], measures, key), {c: c for c in key},
                {"ServiceAgreementKey": "ServiceAgreementDimKey"},
            ),
            Lookup(
                src["report.dim_employee"], {"soldbyid": "user_id", "TenantId": "_tenant_id"},
                {"employee_id": "SoldByEmployeeId"},
            ),
            _date_key(mart, "PeriodStartDate"),
            _dimension(mart, "dim_customer", "customerid", "CustomerId", "CustomerKey"),
            _dimension(mart, "dim_location", "LocationId", "LocationId", "LocationKey"),
            _dimension(mart, "dim_businessunit", "businessunitid", "BusinessUnitId", "BusinessUnitKey"),
            _dimension(mart, "dim_employee", "SoldByEmployeeId", "EmployeeId", "EmployeeKey"),
            Lookup(
                mart["mat_employee_commissionrates"], {"SoldByEmployeeId": "EmployeeId", "TenantId": "TenantId"},
                {p: p for p in percents},
            ),
        ],
    )
    return schemas.conform(unique_key(rows, "ServiceAgreementKey"), schemas.MART["fact_serviceagreement"])
