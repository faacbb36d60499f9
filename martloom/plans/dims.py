"""Dimensions P1-P11.

``*_rows`` functions give the attributes and are lazy; ``keyed`` adds the dense surrogate key.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.functions.dates import date_key, weekday
from martloom.functions.text import status_name
from martloom.operators.keys import stable_key
from martloom.operators.latest import position_in_group
from martloom.operators.star import Lookup, star_lookup
from martloom.session import cut_lineage
from martloom.settings import MartSettings

Sources = Mapping[str, DataFrame]


class LoadSources(Mapping):
    """The sources of one load, and what several of its tables or periods need of them, computed once and stored."""

    def __init__(self, src: Sources) -> None:
        self._src = src
        self._kept: dict[Hashable, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self._src[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._src)

    def __len__(self) -> int:
        return len(self._src)

    def once(self, what: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
        if what not in self._kept:
            self._kept[what] = cut_lineage(make())
        return self._kept[what]


def once(src: Sources, what: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, stored for the rest of the load where ``src`` are the sources of one."""
    return src.once(what, make) if isinstance(src, LoadSources) else make()


def active(column: str = "active") -> Column:
    """source flags are 0/1 numbers."""
    return F.col(column) == 1


def of_tenants(df: DataFrame, settings: MartSettings) -> DataFrame:
    """F4."""
    return df.filter(F.col("_tenant_id").isin(*settings.tenant_ids))


# ---- calendar and tenants -----------------------------------------------------------------------------------------
def dim_date(
    spark: SparkSession,
    start: date | Column,
    end: date | Column,
    fiscal_start_month: int = 1,
    as_of: date | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end``. With ``bounds`` (one row) these may be columns of that frame."""
    base = spark.range(1) if bounds is None else bounds
    first, last = (value if isinstance(value, Column) else F.lit(value) for value in (start, end))
    day = F.col("Date")
    today = F.current_date() if as_of is None else F.lit(as_of)
    shifted = F.add_months(day, (13 - fiscal_start_month) % 12)
    quarter_start = F.trunc(day, "quarter")
    week_start = F.date_sub(day, weekday(day))
    days = base.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("Date"))
    return schemas.conform(
        days.withColumns(
            {
                "DateKey": date_key(day),
                "DayOfWeek": weekday(day),
                "DayName": F.dayname(day),
                "DayOfMonth": F.dayofmonth(day),
                "DayOfYear": F.dayofyear(day),
                "WeekOfYear": F.weekofyear(day),
                "WeekBeginDate": week_start,
                "WeekEndDate": F.date_add(week_start, 6),
                "MonthNumber": F.month(day),
                "MonthName": F.monthname(day),
                "MonthBeginDate": F.trunc(day, "month"),
                "MonthEndDate": F.last_day(day),
                "MonthYear": F.date_format(day, "yyyy-MM"),
                "Quarter": F.quarter(day),
                "QuarterName": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
                "QuarterBeginDate": quarter_start,
                "QuarterEndDate": F.last_day(F.add_months(quarter_start, 2)),
                "Year": F.year(day),
                "FiscalYear": F.year(shifted),
                "FiscalQuarter": F.quarter(shifted),
                "FiscalMonth": F.month(shifted),
                "IsWeekday": weekday(day).between(1, 5),
                "IsWeekend": weekday(day).isin(0, 6),
                "IsCurrentDay": day == today,
                "IsCurrentWeek": week_start == F.date_sub(today, weekday(today)),
                "IsCurrentMonth": F.trunc(day, "month") == F.trunc(today, "month"),
                "IsCurrentQuarter": quarter_start == F.trunc(today, "quarter"),
                "IsCurrentYear": F.year(day) == F.year(today),
            }
        ),
        schemas.MART["dim_date"],
    )


def dim_tenant(spark: SparkSession, tenants: tuple[tuple[int, str, str, bool], ...] | DataFrame) -> DataFrame:
    """Tenants from a literal list (S3) or from a frame with the same four columns."""
    if not isinstance(tenants, DataFrame):
        tenants = spark.createDataFrame(
            list(tenants), "TenantId bigint, TenantName string, TenantOfficialName string, IsActive boolean"
        )
    return schemas.conform(tenants, schemas.MART["dim_tenant"])


# ---- plain dimensions ---------------------------------------------------------------------------------------------
def _plain(df: DataFrame, id_name: str, name: str, is_active: Column, **more: Column) -> DataFrame:
    """the shape most dimensions share."""
    return df.select(
        F.col("id").alias(id_name),
        F.col("_tenant_id").alias("TenantId"),
        F.col("name").alias(name),
        *[value.alias(alias) for alias, value in more.items()],
        is_active.alias("IsActive"),
    )


def businessunit_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P3."""
    return _plain(of_tenants(src["businessunit"], settings), "BusinessUnitId", "BusinessUnitName", F.lit(True))


def customer_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P4."""
    return _plain(of_tenants(src["customer"], settings), "CustomerId", "CustomerName", active())


def employee_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P5."""
    return _plain(
        of_tenants(src["employee"], settings), "EmployeeId", "EmployeeName", active(), EmployeeType=F.lit("Employee")
    )


def jobtype_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P8."""
    return _plain(of_tenants(src["jobtype"], settings), "JobTypeId", "JobTypeName", F.lit(True))


def location_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P9."""
    return _plain(of_tenants(src["location"], settings), "LocationId", "LocationName", F.lit(True))


def job_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """Keeps the agreement of visit jobs, without which visits could not be told from other jobs."""
    return of_tenants(src["job"], settings).select(
        F.col("id").alias("JobId"),
        F.col("_tenant_id").alias("TenantId"),
        F.col("summary").alias("JobSummary"),
        F.col("service_agreement_id").alias("ServiceAgreementId"),
        active().alias("IsActive"),
    )


def account_lookups(src: Sources, account: str, tenant: str = "_tenant_id") -> list[Lookup]:
    """Account, then type name (NULL where unknown). Two plain lookups, because the size of a scanned table is known
    to the optimizer while the size of a join of two is only guessed. Also used by P13."""
    return [
        Lookup(src["generalledgeraccount"], {account: "id", tenant: "_tenant_id"}, {"type_id": "account_type_id"}),
        Lookup(
            src["generalledgeraccounttype"], {"account_type_id": "id", tenant: "_tenant_id"}, {"name": "type_name"}
        ),
    ]


def glaccount_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P6."""
    accounts = of_tenants(src["generalledgeraccount"], settings).select("id", "_tenant_id", "type_id")
    types = Lookup(
        src["generalledgeraccounttype"], {"type_id": "id", "_tenant_id": "_tenant_id"}, {"name": "type_name"}
    )
    return star_lookup(accounts, [types]).select(
        F.col("id").alias("GLAccountId"),
        F.col("_tenant_id").alias("TenantId"),
        F.col("type_name").alias("GLAccountType"),
        F.col("type_id").alias("GLAccountTypeId"),
        F.lit(True).alias("IsActive"),
    )


def sku_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """Materials are type 1, equipment is type 2; ids may repeat across the two (U4, K9)."""

    def part(name: str, kind: int) -> DataFrame:
        return of_tenants(src[name], settings).select(
            F.col("id").alias("SKUId"),
            F.lit(kind).alias("SKUType"),
            F.col("_tenant_id").alias("TenantId"),
            F.lit(True).alias("IsActive"),
        )

    return part("material", 1).unionByName(part("equipment", 2))


# ---- agreements ---------------------------------------------------------------------------------------------------
def with_renewal_year(agreements: DataFrame, name: str = "RenewalYear") -> DataFrame:
    """Position of an active agreement in its renewal chain by start date (ties: lower id first); 1 if inactive.

    Inactive agreements are numbered apart from active ones, so no second copy of the table has to be joined back.
    """
    is_active = F.coalesce(active(), F.lit(False))
    ranked = position_in_group(
        agreements.withColumn("_on", is_active),
        ["_tenant_id", "renewalgroupinitialagreement_id", "_on"], "startdate", "id", "_pos",
    )
    return ranked.withColumn(name, F.when(F.col("_on"), F.col("_pos")).otherwise(F.lit(1))).drop("_on", "_pos")


def primary_locations(src: Sources) -> DataFrame:
    """Lowest active location of each agreement."""
    return (
        src["serviceagreementlocation"].filter(active())
        .groupBy("serviceagreement_id", "_tenant_id")
        .agg(F.min("locationid").alias("locationid"))
    )


def agreement_attributes(src: Sources, agreements: DataFrame) -> DataFrame:
    """Agreements with renewal year, primary location and template; shared by P10 and P21."""
    return star_lookup(
        with_renewal_year(agreements),
        [
            Lookup(
                primary_locations(src), {"id": "serviceagreement_id", "_tenant_id": "_tenant_id"},
                {"locationid": "LocationId"},
            ),
            Lookup(
                src["serviceagreementtemplate"], {"templateinstance_id": "id", "_tenant_id": "_tenant_id"},
                {"id": "TemplateId", "name": "TemplateName"},
            ),
        ],
    )


def attributes_of_agreements(src: Sources, settings: MartSettings) -> DataFrame:
    """``agreement_attributes`` of the run's tenants, the same for the dimension and for every period of the fact."""
    return once(
        src, ("agreement attributes", settings.tenant_ids),
        lambda: agreement_attributes(src, of_tenants(src["serviceagreement"], settings)),
    )


def serviceagreement_rows(src: Sources, settings: MartSettings) -> DataFrame:
    """P10: one row per agreement (its primary location only)."""
    rows = attributes_of_agreements(src, settings)
    return rows.select(
        F.col("id").alias("ServiceAgreementId"),
        F.col("_tenant_id").alias("TenantId"),
        F.col("name").alias("ServiceAgreementName"),
        F.col("customerid").alias("CustomerId"),
        "LocationId",
        F.col("businessunitid").alias("BusinessUnitId"),
        F.col("soldbyid").alias("SoldById"),
        "TemplateId",
        "TemplateName",
        F.col("TemplateName").alias("TemplateType"),
        F.col("startdate").cast("date").alias("StartDate"),
        F.col("enddate").cast("date").alias("EndDate"),
        "RenewalYear",
        F.col("renewalgroupinitialagreement_id").alias("RenewalGroupInitialAgreementId"),
        F.col("renewedby_id").alias("RenewedById"),
        F.col("status").alias("Status"),
        status_name(F.col("status")).alias("StatusName"),
        active().alias("IsActive"),
    )


# table -> (rows, surrogate key, natural key)
_KEYED = {
    "dim_businessunit": (businessunit_rows, "BusinessUnitKey", ("BusinessUnitId", "TenantId")),
    "dim_customer": (customer_rows, "CustomerKey", ("CustomerId", "TenantId")),
    "dim_employee": (employee_rows, "EmployeeKey", ("EmployeeId", "TenantId")),
    "dim_glaccount": (glaccount_rows, "GLAccountKey", ("GLAccountId", "TenantId")),
    "dim_job": (job_rows, "JobKey", ("JobId", "TenantId")),
    "dim_jobtype": (jobtype_rows, "JobTypeKey", ("JobTypeId", "TenantId")),
    "dim_location": (location_rows, "LocationKey", ("LocationId", "TenantId")),
    "dim_serviceagreement": (serviceagreement_rows, "ServiceAgreementKey", ("ServiceAgreementId", "TenantId")),
    "dim_sku": (sku_rows, "SKUKey", ("SKUId", "SKUType", "TenantId")),
}
KEYED_DIMENSIONS = tuple(_KEYED)


def key_columns(table: str) -> tuple[str, tuple[str, ...]]:
    """Surrogate key and natural key of a keyed dimension."""
    return _KEYED[table][1:]


def keyed_with_new(
    table: str, src: Sources, settings: MartSettings, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """A keyed dimension in its declared shape, and the members (natural key, key) that ``known`` does not have."""
    rows, key, natural = _KEYED[table]
    numbered, fresh = stable_key(rows(src, settings), key, natural, known)
    return schemas.conform(numbered, schemas.MART[table]), fresh


def keyed(table: str, src: Sources, settings: MartSettings) -> DataFrame:
    """A keyed dimension of a first load."""
    return keyed_with_new(table, src, settings)[0]
