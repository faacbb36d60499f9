"""Commission report P22-P24 and the metric views P25-P28."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.money import or_zero, percent_of, tiered_commission
from martloom.functions.text import agreement_link, invoice_link
from martloom.operators.listagg import Listed, listagg_distinct
from martloom.operators.star import Lookup, star_lookup
from martloom.plans.facts import Mart
from martloom.plans.measures import POSTED
from martloom.settings import MartSettings

REPORT_COLUMNS = schemas.REPORT_COLUMNS
_AGREEMENT = ["ServiceAgreementId", "TenantId"]
_PERCENTS = ("JobCommissionPct", "SAYear1CommissionPct", "SAYear2CommissionPct", "SAYear3PlusCommissionPct")

_RATE_OUTPUTS = dict(zip(_PERCENTS, list(REPORT_COLUMNS)[-4:]))


def _shape(df: DataFrame) -> DataFrame:
    """Report columns plus the tenant; a column the side does not have is a typed NULL."""
    have = set(df.columns)
    return df.select(
        F.col("TenantId").alias("_TenantId"),
        *[
            (F.col(f"`{name}`") if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in REPORT_COLUMNS.items()
        ],
    )


def _active(mart: Mart, table: str) -> DataFrame:
    """F19."""
    return mart[table].filter("IsActive")


def _member(mart: Mart, table: str, key: str, take: dict[str, str], how: str = "inner") -> Lookup:
    """Join an active dimension member by surrogate key."""
    return Lookup(_active(mart, table), {key: key}, take, how)


def _seller(mart: Mart) -> Lookup:
    names = {c: c for c in ("EmployeeId", "EmployeeName", "EmployeeType")}
    return _member(mart, "dim_employee", "EmployeeKey", names, "left")


def _cost() -> Column:
    return (
        F.col("TotalItemCost") + F.col("TotalPOCost") + F.col("TotalLaborCost") + or_zero(F.col("TotalReturnCredit"))
    )


def _jobs_with_returns(mart: Mart, jobs: DataFrame) -> DataFrame:
    """Jobs with their return credit; joined before the facts so that the facts are shuffled by job key only once."""
    credits = mart["mat_job_returns"].select("JobId", "TenantId", "TotalReturnCredit")
    return jobs.select("JobKey", "JobId", "TenantId", "JobSummary", "ServiceAgreementId").join(
        credits, ["JobId", "TenantId"], "left"
    )


def job_invoices(mart: Mart) -> DataFrame:
    """Posted invoices of active jobs that are no agreement visits, with revenue, cost and margin.

    "No visit of that job exists" is a plain NULL test because the job dimension has one row per job and tenant.
    """
    jobs = _jobs_with_returns(mart, _active(mart, "dim_job").filter("ServiceAgreementId IS NULL"))
    return (
        mart["fact_invoice"].filter(F.col("InvoiceStatus") == POSTED)
        .drop("JobId", "LoadDateTime", "UpdatedDateTime")
        .join(jobs.drop("TenantId", "ServiceAgreementId"), "JobKey")
        .withColumns({"JobRevenue": F.col("IncomeRevenue"), "JobCost": _cost()})
        .withColumn("JobMargin", F.col("JobRevenue") - F.col("JobCost"))
    )


def _job_lookups(mart: Mart, invoices: DataFrame) -> DataFrame:
    rates = mart["mat_employee_commissionrates"]
    return star_lookup(
        invoices,
        [
            _member(mart, "dim_customer", "CustomerKey", {"CustomerName": "JobCustomer", "CustomerId": "JobCustomerId"}),
            _member(mart, "dim_location", "LocationKey", {"LocationName": "JobLocation", "LocationId": "JobLocationId"}),
            _member(mart, "dim_businessunit", "BusinessUnitKey", {"BusinessUnitName": "BusinessUnit"}),
            _member(mart, "dim_jobtype", "JobTypeKey", {"JobTypeName": "JobType"}),
            _seller(mart),
            Lookup(
                rates, {"EmployeeId": "EmployeeId", "TenantId": "TenantId"},
                {"CommissionType": "CommissionTypeEmployee", **{p: p for p in _PERCENTS}},
            ),
        ],
    ).withColumns(
        {
            "JobCommission": percent_of(F.col("JobMargin"), F.col("JobCommissionPct")),
            "InvoiceNumber": F.col("TransactionNumber"),
        }
    )


def _in_report(df: DataFrame, settings: MartSettings) -> DataFrame:
    return df.filter(
        F.col("PostedDate").between(settings.from_date, settings.to_date)
        & F.col("TenantId").isin(*settings.tenant_ids)
    )


def optional_in(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """no values, no filter."""
    return df.filter(F.col(column).isin(*values)) if values else df


def report_jobs_side(mart: Mart, settings: MartSettings) -> DataFrame:
    """One row per invoice."""
    invoices = optional_in(_in_report(job_invoices(mart), settings), "InvoiceStatus", settings.status_filter)
    rows = optional_in(_job_lookups(mart, invoices), "EmployeeId", settings.employee_ids)
    return _shape(rows.withColumnsRenamed(_RATE_OUTPUTS).withColumn("LinkPath", invoice_link(F.col("InvoiceId"))))


# ---- agreements ---------------------------------------------------------------------------------------------------
def visit_invoices(mart: Mart, invoices: DataFrame) -> DataFrame:
    """Invoices of agreement visit jobs, with the agreement and the cost."""
    jobs = _jobs_with_returns(mart, mart["dim_job"].filter("ServiceAgreementId IS NOT NULL"))
    return (
        invoices.select(
            "JobKey", "InvoiceId", "TransactionNumber", "InvoiceStatus", "TotalItemCost", "TotalPOCost",
            "TotalLaborCost",
        )
        .join(jobs.drop("JobSummary", "JobId"), "JobKey")
        .withColumn("Cost", _cost())
    )


def collapse_periods(periods: DataFrame) -> DataFrame:
    """One row per agreement: greatest attribute values, summed revenue."""
    attributes = (
        "SAName", "SATemplateType", "SAStartDate", "SARenewalYear", "SAStatus", "CustomerKey", "LocationKey",
        "BusinessUnitKey", "EmployeeKey", "SoldByEmployeeId", *_PERCENTS,
    )
    return periods.groupBy(*_AGREEMENT).agg(
        *[F.max(c).alias(c) for c in attributes], F.sum("RevenueRecognitionAmount").alias("TotalRevenue")
    )


def _agreement_rows(mart: Mart, periods: DataFrame, costs: DataFrame) -> DataFrame:
    """``costs`` has one row per agreement with ``CostFromJobs`` and whatever else is to be carried along."""
    names = {"CustomerName": "ServiceAgreementCustomer", "CustomerId": "ServiceAgreementCustomerId"}
    places = {"LocationName": "ServiceAgreementLocation", "LocationId": "ServiceAgreementLocationId"}
    rows = star_lookup(
        collapse_periods(periods).join(costs, _AGREEMENT, "left"),
        [
            _member(mart, "dim_customer", "CustomerKey", names),
            _member(mart, "dim_location", "LocationKey", places),
            _member(mart, "dim_businessunit", "BusinessUnitKey", {"BusinessUnitName": "BusinessUnit"}),
            _seller(mart),
        ],
    )
    margin = F.col("TotalRevenue") - or_zero(F.col("CostFromJobs"))
    return rows.withColumns(
        {
            "TransactionNumber": F.col("SAName"),
            "ServiceAgreementTemplateType": F.col("SATemplateType"),
            "ServiceAgreementStartDate": F.col("SAStartDate"),
            "ServiceAgreementRevenue": F.col("TotalRevenue"),
            "ServiceAgreementRenewalYear": F.col("SARenewalYear"),
            "ServiceAgreementMargin": margin,
            "ServiceAgreementCommission": tiered_commission(
                F.col("SARenewalYear"), margin, *[F.col(p) for p in _PERCENTS[1:]]
            ),
        }
    )


def report_sa_side(mart: Mart, settings: MartSettings) -> DataFrame:
    """One row per agreement; its cost counts invoices of any status, its invoice list only posted ones."""
    # whole periods inside the window; these are folder columns, so other periods are not read.
    periods = mart["fact_serviceagreement"].filter(
        (F.col("PeriodStartDate") >= F.lit(settings.from_date))
        & (F.col("PeriodEndDate") <= F.lit(settings.to_date))
        & F.col("TenantId").isin(*settings.tenant_ids)
    )
    visits = visit_invoices(mart, _in_report(mart["fact_invoice"], settings))
    of_visits = listagg_distinct(
        visits, _AGREEMENT,
        {
            "InvoiceId": Listed(F.col("InvoiceId"), numeric=True),
            "InvoiceNumber": Listed(F.col("TransactionNumber"), numeric=False),
        },
        where=F.col("InvoiceStatus") == POSTED,
        sums={"CostFromJobs": F.col("Cost")},
    )
    rows = _agreement_rows(mart, periods, of_visits)
    rows = optional_in(rows, "EmployeeId", settings.employee_ids)
    link = agreement_link(F.col("ServiceAgreementCustomerId"), F.col("ServiceAgreementId"))
    return _shape(rows.withColumnsRenamed(_RATE_OUTPUTS).withColumn("LinkPath", link))


def commission_report(mart: Mart, settings: MartSettings, ordered: bool = True) -> DataFrame:
    """Both sides with tenant names, 39 columns."""
    rows = report_jobs_side(mart, settings).unionByName(report_sa_side(mart, settings))
    rows = star_lookup(
        rows,
        [
            Lookup(
                mart["dim_tenant"], {"_TenantId": "TenantId"},
                {"TenantName": "_TenantName", "TenantOfficialName": "_TenantOfficialName"},
            )
        ],
    ).select("_TenantId", "_TenantName", "_TenantOfficialName", *[F.col(f"`{c}`") for c in REPORT_COLUMNS])
    if not ordered:
        return rows
    return rows.orderBy(
        F.coalesce("JobId", "ServiceAgreementId").asc_nulls_last(), F.col("InvoiceId").asc_nulls_last()
    )


# ---- metric views -------------------------------------------------------------------------------------------------
def job_metrics(mart: Mart) -> DataFrame:
    """P25: the report's job side without parameters."""
    return _job_lookups(mart, job_invoices(mart)).select(
        "JobId", "TransactionNumber", "BusinessUnit", "JobType", "JobSummary", "JobCustomer", "JobCustomerId",
        "JobLocation", "JobLocationId", "JobRevenue", "JobCost", "JobMargin", "JobCommission", "InvoiceId",
        "InvoiceNumber", F.col("IsAdjustment").alias("InvoiceIsAdjustment"), "EmployeeName", "EmployeeType",
        "EmployeeId", F.col("TenantId").alias("_TenantId"), "PostedDate",
    )


def sa_metrics(mart: Mart) -> DataFrame:
    """All periods; unlike the report, visit costs count posted invoices only."""
    posted = mart["fact_invoice"].filter(F.col("InvoiceStatus") == POSTED)
    costs = visit_invoices(mart, posted).groupBy(*_AGREEMENT).agg(F.sum("Cost").alias("CostFromJobs"))
    return _agreement_rows(mart, mart["fact_serviceagreement"], costs).select(
        "ServiceAgreementId", "ServiceAgreementTemplateType", "ServiceAgreementStartDate", "ServiceAgreementCustomer",
        "ServiceAgreementCustomerId", "ServiceAgreementLocation", "ServiceAgreementLocationId", "CostFromJobs",
        "ServiceAgreementRevenue", "ServiceAgreementRenewalYear", "ServiceAgreementCommission",
        "ServiceAgreementMargin", "EmployeeName", "EmployeeType", "EmployeeId", F.col("TenantId").alias("_TenantId"),
    )


def invoice_metrics(mart: Mart) -> DataFrame:
    """Posted invoices of active jobs; names are NULL where the member is inactive or unknown."""
    invoices = mart["fact_invoice"].filter(F.col("InvoiceStatus") == POSTED).drop("JobId")
    return star_lookup(
        invoices,
        [
            _member(mart, "dim_job", "JobKey", {"JobId": "JobId"}),
            _member(mart, "dim_customer", "CustomerKey", {c: c for c in ("CustomerId", "CustomerName")}, "left"),
            _member(mart, "dim_location", "LocationKey", {c: c for c in ("LocationId", "LocationName")}, "left"),
            _member(mart, "dim_businessunit", "BusinessUnitKey", {"BusinessUnitName": "BusinessUnitName"}, "left"),
        ],
    ).select(
        "InvoiceId", "InvoiceDate", "PostedDate", "TransactionNumber", "TotalRevenue", "IncomeRevenue",
        "LineItemCount", "IsAdjustment", "JobId", "CustomerId", "CustomerName", "LocationId", "LocationName",
        "BusinessUnitName", "TenantId",
    )


def employee_metrics(mart: Mart) -> DataFrame:
    """Job and agreement commission per employee.

    Both sides are first summed per employee key: margin times a fixed rate sums the same before and after the join,
    and the many rows without a salesperson become a single one before they meet a join.
    """
    person = ["EmployeeId", "EmployeeName", "EmployeeType"]
    rates = mart["mat_employee_commissionrates"]
    margins = job_invoices(mart).groupBy("EmployeeKey").agg(F.sum("JobMargin").alias("margin"))
    of_jobs = star_lookup(
        margins,
        [
            _member(
                mart, "dim_employee", "EmployeeKey", {c: c for c in (*person, "TenantId")}, "left",
            ),
            Lookup(
                rates, {"EmployeeId": "EmployeeId", "TenantId": "TenantId"}, {"JobCommissionPct": "JobCommissionPct"}
            ),
        ],
    ).groupBy(*person).agg(F.sum(percent_of(F.col("margin"), F.col("JobCommissionPct"))).alias("JobCommission"))

    posted = mart["fact_invoice"].filter(F.col("InvoiceStatus") == POSTED)
    mean_cost = visit_invoices(mart, posted).groupBy(*_AGREEMENT).agg(F.avg("Cost").alias("MeanCost"))
    margin = (F.col("RevenueRecognitionAmount") - or_zero(F.col("MeanCost"))).cast("decimal(24,6)")
    zero = F.lit(0)
    commission = F.coalesce(
        F.when(F.col("SARenewalYear") == 1, margin * or_zero(F.col(_PERCENTS[1])))
        .when(F.col("SARenewalYear") == 2, margin * or_zero(F.col(_PERCENTS[2])))
        .when(F.col("SARenewalYear") > 2, margin * or_zero(F.col(_PERCENTS[3]))),
        zero,
    )
    per_key = (
        mart["fact_serviceagreement"].join(mean_cost, _AGREEMENT, "left")
        .groupBy("EmployeeKey").agg(F.sum(commission).alias("commission"))
    )
    of_agreements = (
        star_lookup(per_key, [_seller(mart)]).groupBy(*person)
        .agg((F.sum("commission") / 100).alias("SACommission"))
    )
    left, right = of_jobs.alias("j"), of_agreements.alias("a")
    both = left.join(right, F.col("j.EmployeeId") == F.col("a.EmployeeId"), "full_outer")
    job, agreement = or_zero(F.col("JobCommission")), or_zero(F.col("SACommission"))
    return both.select(
        *[F.coalesce(f"j.{c}", f"a.{c}").alias(c) for c in person],
        job.alias("JobCommission"),
        agreement.alias("SACommission"),
        (job + agreement).alias("TotalCommission"),
    )
