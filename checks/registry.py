"""Every registered query with its expected result."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import oracle
from checks.binding import base_table
from checks.marts import PERIODS, REPORT, SETTINGS, open_mart
from martloom import schemas
from martloom.functions.money import or_zero, tiered_commission
from martloom.functions.text import status_name, try_decimal
from martloom.operators import compare, quality
from martloom.operators.distinct import sums_with_distinct
from martloom.operators.eav import eav_pivot
from martloom.operators.keys import dense_key, stable_key
from martloom.operators.latest import latest_per_key
from martloom.operators.listagg import Listed, listagg_distinct
from martloom.plans import dims, facts, measures, metrics, pipeline, report
from martloom.session import scratch_path
from martloom.sinks import runlog, writers
from martloom.sinks.versions import VersionedTable
from martloom.streaming.refresh import BucketedTable, changed_since, refresh_from_stream, upsert

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}
_AUDIT = ("LoadDateTime", "UpdatedDateTime")


def present(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Results as they are compared: no load times, amounts as double."""
    df = df.drop(*_AUDIT, *drop)
    return df.select(
        *[
            (F.col(f"`{f.name}`").cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`"))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )


def check(name: str, sql: str | None, drop: tuple[str, ...] = ()):
    def register(run: Query) -> Query:
        CHECKS[name] = Check(lambda spark, sf_dir: present(run(spark, sf_dir), drop), sql)
        return run

    return register


def _src(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return open_mart(spark, sf_dir).src


def _money(column: str):
    return F.col(column).cast("decimal(20,2)")


# ---- dimensions ---------------------------------------------------------------------------------------------------
_CALENDAR = (
    "DateKey", "Date", "DayOfWeek", "DayName", "DayOfMonth", "DayOfYear", "WeekOfYear", "WeekBeginDate", "WeekEndDate",
    "MonthNumber", "MonthName", "MonthBeginDate", "MonthEndDate", "MonthYear", "Quarter", "QuarterName",
    "QuarterBeginDate", "QuarterEndDate", "Year", "FiscalYear", "FiscalQuarter", "FiscalMonth", "IsWeekday",
    "IsWeekend", "IsCurrentWeek",
)


@check(
    "dim_date_calendar",
    f"""
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS DateKey, day AS Date, dayofweek(day) AS DayOfWeek,
           left(dayname(day), 3) AS DayName, day(day) AS DayOfMonth, dayofyear(day) AS DayOfYear,
           weekofyear(day) AS WeekOfYear, CAST(day - dayofweek(day)::INTEGER AS DATE) AS WeekBeginDate,
           CAST(day - dayofweek(day)::INTEGER + 6 AS DATE) AS WeekEndDate, month(day) AS MonthNumber,
           left(monthname(day), 3) AS MonthName, CAST(date_trunc('month', day) AS DATE) AS MonthBeginDate,
           last_day(day) AS MonthEndDate, strftime(day, '%Y-%m') AS MonthYear, quarter(day) AS Quarter,
           'Q' || quarter(day) AS QuarterName, CAST(date_trunc('quarter', day) AS DATE) AS QuarterBeginDate,
           CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS QuarterEndDate,
           year(day) AS Year, year(day + INTERVAL 6 MONTH) AS FiscalYear, quarter(day + INTERVAL 6 MONTH) AS FiscalQuarter,
           month(day + INTERVAL 6 MONTH) AS FiscalMonth, dayofweek(day) BETWEEN 1 AND 5 AS IsWeekday,
           dayofweek(day) IN (0, 6) AS IsWeekend,
           day - dayofweek(day)::INTEGER = DATE '1998-06-28' AS IsCurrentWeek, coalesce(n, 0) AS orders
    FROM ({oracle.calendar("(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)")}) AS c
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) AS o ON d = day""",
)
def dim_date_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = base_table(spark, sf_dir, "orders")
    days = dims.dim_date(
        spark, F.col("first"), F.col("last"), fiscal_start_month=7, as_of=date(1998, 7, 1),
        bounds=orders.agg(F.min(day).alias("first"), F.max(day).alias("last")),
    ).select(*_CALENDAR)
    per_day = orders.groupBy(day.alias("Date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "Date", "left").withColumn("orders", or_zero(F.col("n"))).drop("n")


@check(
    "dim_tenant",
    "SELECT CAST(r_regionkey AS BIGINT) AS TenantId, r_name AS TenantName, r_name || ' Corp' AS TenantOfficialName, "
    "TRUE AS IsActive FROM region",
)
def dim_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenants = base_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("TenantId"), F.col("r_name").alias("TenantName"),
        F.concat("r_name", F.lit(" Corp")).alias("TenantOfficialName"), F.lit(True).alias("IsActive"),
    )
    return dims.dim_tenant(spark, tenants)


def _dimension(table: str) -> None:
    @check(table, oracle.table(table))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dims.keyed(table, _src(spark, sf_dir), SETTINGS)


for _table in dims.KEYED_DIMENSIONS:
    _dimension(_table)


# ---- measures -----------------------------------------------------------------------------------------------------
def _measure(name: str, table: str, job: Callable, source: str | None = None, **changes) -> None:
    @check(name, oracle.table(table, source=source))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(_src(spark, sf_dir), SETTINGS.with_(**changes))


_measure(
    "employee_commission_rates", "mat_employee_commissionrates", measures.employee_commission_rates
)
_measure("invoice_revenue", "mat_invoice_revenue", measures.invoice_revenue)
_measure("invoice_material_costs", "mat_invoice_materialcosts", measures.invoice_material_costs)
_measure("invoice_po_costs", "mat_invoice_pocosts", measures.invoice_po_costs)
_measure("invoice_labor_costs", "mat_invoice_laborcosts", measures.invoice_labor_costs)
_measure(
    "invoice_labor_costs_multiplied", "mat_invoice_laborcosts", measures.invoice_labor_costs, "m_labor_pairs",
    labor_fanout="reference",
)
_measure("job_returns", "mat_job_returns", measures.job_returns)
_measure(
    "sa_period_measures", "mat_sa_period_measures", measures.sa_period_measures,
    f"({oracle.period_measures(*PERIODS[1])})", period_start=PERIODS[1][0], period_end=PERIODS[1][1],
)


@check(
    "sa_bridge_costs",
    oracle.compose(
        oracle.typed(
            {"id": "bigint", "cost": "decimal", "jobs": "bigint"},
            """SELECT v.id, sum(p.amount) AS cost, count(DISTINCT v.job_id) AS jobs
               FROM m_visits v LEFT JOIN m_pay p ON p.job_id = v.job_id GROUP BY v.id""",
        )
    ),
)
def sa_bridge_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    pay = measures.pay_lines(src, SETTINGS).groupBy(*measures.JOB_KEY).agg(F.sum("amount").alias("pay"))
    return (
        measures.visit_jobs(src, SETTINGS).join(pay, measures.JOB_KEY, "left")
        .groupBy("id").agg(F.sum("pay").alias("cost"), F.countDistinct("job_id").alias("jobs"))
    )


# ---- facts --------------------------------------------------------------------------------------------------------
@check("fact_invoice_star", oracle.table("fact_invoice", ("InvoiceKey",)), ("InvoiceKey",))
def fact_invoice_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_mart(spark, sf_dir).build("fact_invoice")


@check(
    "fact_invoice_each_salesperson", oracle.table("fact_invoice", ("InvoiceKey",), "m_fact_invoice_each"),
    ("InvoiceKey",),
)
def fact_invoice_each_salesperson(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = open_mart(spark, sf_dir)
    return facts.fact_invoice(mart.src, mart, SETTINGS.with_(multi_salesperson="duplicate"))


@check("fact_invoiceitem", oracle.table("fact_invoiceitem", ("InvoiceItemKey",)), ("InvoiceItemKey",))
def fact_invoiceitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_mart(spark, sf_dir).build("fact_invoiceitem")


@check(
    "fact_sa_period",
    oracle.table(
        "fact_serviceagreement", ("ServiceAgreementKey",),
        f"(SELECT * FROM m_fact_serviceagreement WHERE PeriodStartDate = DATE '{SETTINGS.period_start}')",
    ),
    ("ServiceAgreementKey",),
)
def fact_sa_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_mart(spark, sf_dir).build("fact_serviceagreement")


# ---- report -------------------------------------------------------------------------------------------------------
_TENANT = {"_TenantId": "bigint"}


def _report_columns(skip: tuple[str, ...] = ()) -> dict[str, str]:
    return {c: k for c, k in {**_TENANT, **report.REPORT_COLUMNS}.items() if c not in skip}


def _padded(source: str, have: tuple[str, ...]) -> str:
    """One side of the report with the columns it lacks as NULL."""
    missing = [c for c in report.REPORT_COLUMNS if c not in have]
    nulls = "".join(f', NULL AS "{c}"' for c in missing)
    return f"SELECT *{nulls} FROM {source}"


_SA_ONLY = tuple(c for c in report.REPORT_COLUMNS if c.startswith("ServiceAgreement")) + ("CostFromJobs",)
_JOB_ONLY = tuple(
    c for c in report.REPORT_COLUMNS if c.startswith("Job") and "%" not in c
) + ("CommissionTypeEmployee",)


@check(
    "report_jobs_side",
    oracle.compose(
        oracle.typed(
            _report_columns(),
            _padded("m_report_jobs", tuple(c for c in report.REPORT_COLUMNS if c not in _SA_ONLY)),
        )
    ),
)
def report_jobs_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_jobs_side(open_mart(spark, sf_dir), REPORT)


@check(
    "report_sa_side",
    oracle.compose(
        oracle.typed(
            _report_columns(),
            _padded("m_report_agreements", tuple(c for c in report.REPORT_COLUMNS if c not in _JOB_ONLY)),
        )
    ),
)
def report_sa_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_sa_side(open_mart(spark, sf_dir), REPORT)


_FULL_REPORT = {"_TenantName": "string", "_TenantOfficialName": "string", **_TENANT, **report.REPORT_COLUMNS}


@check("commission_report_union", oracle.compose(oracle.typed(_FULL_REPORT, "SELECT * FROM m_report")))
def commission_report_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.commission_report(open_mart(spark, sf_dir), REPORT)


_RUN = {"RUN_VERSION": "string", "RUN_DATE": "date", "RUN_DESCRIPTION": "string"}


@check(
    "report_snapshot",
    oracle.compose(
        oracle.typed(
            {**_RUN, **_FULL_REPORT},
            "SELECT '1.0.0' AS RUN_VERSION, DATE '2024-11-18' AS RUN_DATE, 'baseline' AS RUN_DESCRIPTION, * FROM m_report",
        )
    ),
)
def report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored copy, read back."""
    rows = report.commission_report(open_mart(spark, sf_dir), REPORT, ordered=False)
    root = scratch_path(spark, "baseline")
    for _ in range(2):
        stamped = writers.stamp_run(rows, "1.0.0", date(2024, 11, 18), "baseline")
        writers.replace_run(stamped, f"{root}/{pipeline.BASELINE}", {"RUN_VERSION": "1.0.0"})
    return pipeline.read_baseline(spark, root, "1.0.0")


@check(
    "baseline_versions_diff",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'removed' WHEN o_orderkey % 5 = 0 THEN 'added' ELSE 'changed' END
              AS change, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN 'price' END AS changed_columns
       FROM orders
       WHERE CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 5 <> 0 ELSE o_orderkey % 5 = 0 OR o_orderstatus = 'P' END""",
)
def baseline_versions_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored versions whose names differ only as texts. The second lacks some rows, has others, and a changed price."""
    root = scratch_path(spark, "versions")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    orders = base_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), price.alias("later"))
    versions = {
        "1.1": orders.filter("o_orderkey % 5 <> 0").select("o_orderkey", "price"),
        "1.10": orders.filter("o_orderkey % 7 <> 0").select("o_orderkey", F.col("later").alias("price")),
    }
    for version, rows in versions.items():
        stamped = writers.stamp_run(rows, version, date(2024, 11, 18), "compared")
        writers.replace_run(stamped, f"{root}/{pipeline.BASELINE}", {"RUN_VERSION": version})
    columns = {**_RUN, "o_orderkey": "bigint", "price": "double"}
    return pipeline.compare_baselines(spark, root, "1.1", "1.10", ["o_orderkey"], columns)


# ---- metric views and metrics -------------------------------------------------------------------------------------
_JOB_VIEW = {
    "JobId": "bigint", "TransactionNumber": "string", "BusinessUnit": "string", "JobType": "string",
    "JobSummary": "string", "JobCustomer": "string", "JobCustomerId": "bigint", "JobLocation": "string",
    "JobLocationId": "bigint", "JobRevenue": "decimal", "JobCost": "decimal", "JobMargin": "decimal",
    "JobCommission": "decimal", "InvoiceId": "bigint", "InvoiceNumber": "string", "InvoiceIsAdjustment": "boolean",
    "EmployeeName": "string", "EmployeeType": "string", "EmployeeId": "bigint", "_TenantId": "bigint",
    "PostedDate": "date",
}
_SA_VIEW = {
    "ServiceAgreementId": "bigint", "ServiceAgreementTemplateType": "string", "ServiceAgreementStartDate": "date",
    "ServiceAgreementCustomer": "string", "ServiceAgreementCustomerId": "bigint", "ServiceAgreementLocation": "string",
    "ServiceAgreementLocationId": "bigint", "CostFromJobs": "decimal", "ServiceAgreementRevenue": "decimal",
    "ServiceAgreementRenewalYear": "int", "ServiceAgreementCommission": "decimal", "ServiceAgreementMargin": "decimal",
    "EmployeeName": "string", "EmployeeType": "string", "EmployeeId": "bigint", "_TenantId": "bigint",
}
_EMPLOYEE_VIEW = {
    "EmployeeId": "bigint", "EmployeeName": "string", "EmployeeType": "string", "JobCommission": "decimal",
    "SACommission": "decimal", "TotalCommission": "decimal",
}
_INVOICE_VIEW = {
    "InvoiceId": "bigint", "InvoiceDate": "date", "PostedDate": "date", "TransactionNumber": "string",
    "TotalRevenue": "decimal", "IncomeRevenue": "decimal", "LineItemCount": "bigint", "IsAdjustment": "boolean",
    "JobId": "bigint", "CustomerId": "bigint", "CustomerName": "string", "LocationId": "bigint",
    "LocationName": "string", "BusinessUnitName": "string", "TenantId": "bigint",
}
_CENTS = "CAST({0} AS DECIMAL(20,2)) AS {0}"
_JOB_VIEW_SQL = (
    'SELECT * REPLACE (CAST(JobCommission AS DECIMAL(20,2)) AS JobCommission), TransactionNumber AS InvoiceNumber, '
    'IsAdjustment AS InvoiceIsAdjustment, TenantId AS "_TenantId" FROM m_job_side'
)
_SA_VIEW_SQL = (
    f'SELECT * REPLACE ({_CENTS.format("ServiceAgreementCommission")}), TenantId AS "_TenantId" FROM m_sa_metrics'
)
_EMPLOYEE_VIEW_SQL = (
    "SELECT * REPLACE (" + ", ".join(_CENTS.format(c) for c in ("JobCommission", "SACommission", "TotalCommission"))
    + ") FROM m_employee_metrics"
)
_INVOICE_VIEW_SQL = """
    SELECT f.* EXCLUDE (JobId), j.JobId, cu.CustomerId, cu.CustomerName, lo.LocationId, lo.LocationName, bu.BusinessUnitName
    FROM m_fact_invoice f JOIN m_dim_job j ON j.JobKey = f.JobKey AND j.IsActive
    LEFT JOIN m_dim_customer cu ON cu.CustomerKey = f.CustomerKey AND cu.IsActive
    LEFT JOIN m_dim_location lo ON lo.LocationKey = f.LocationKey
    LEFT JOIN m_dim_businessunit bu ON bu.BusinessUnitKey = f.BusinessUnitKey WHERE f.InvoiceStatus = 2"""


def _cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: _money(c) for c in columns})


@check("job_metrics", oracle.compose(oracle.typed(_JOB_VIEW, _JOB_VIEW_SQL)))
def job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cents(report.job_metrics(open_mart(spark, sf_dir)), "JobCommission")


@check("sa_metrics", oracle.compose(oracle.typed(_SA_VIEW, _SA_VIEW_SQL)))
def sa_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cents(report.sa_metrics(open_mart(spark, sf_dir)), "ServiceAgreementCommission")


@check("invoice_metrics", oracle.compose(oracle.typed(_INVOICE_VIEW, _INVOICE_VIEW_SQL)))
def invoice_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.invoice_metrics(open_mart(spark, sf_dir))


@check("employee_metrics", oracle.compose(oracle.typed(_EMPLOYEE_VIEW, _EMPLOYEE_VIEW_SQL)))
def employee_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cents(
        report.employee_metrics(open_mart(spark, sf_dir)), "JobCommission", "SACommission", "TotalCommission"
    )


def _metric_sql(name: str, category: str, value: str, count: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS name, '{category}' AS category, "
        f"CAST(CAST(coalesce({value}, 0) AS DECIMAL(20,2)) AS DOUBLE) AS value, {count} AS count FROM {source}"
    )


_METRICS_SQL = " UNION ALL ".join(
    [
        _metric_sql(f"job_{m.lower()}_total", "job", f"sum(Job{m})", f"count(Job{m})", "m_job_side")
        for m in ("Revenue", "Cost", "Margin", "Commission")
    ]
    + [
        _metric_sql(
            f"sa_{m.lower()}_total", "service_agreement", f"sum(ServiceAgreement{m})", f"count(ServiceAgreement{m})",
            "m_sa_metrics",
        )
        for m in ("Revenue", "Commission", "Margin")
    ]
    + [
        _metric_sql(
            "invoice_count", "invoice", "count(DISTINCT InvoiceId)", "count(DISTINCT InvoiceId)",
            f"({_INVOICE_VIEW_SQL})",
        ),
        _metric_sql(
            "employee_commission_total", "employee", "sum(TotalCommission)", "count(DISTINCT EmployeeId)",
            "m_employee_metrics",
        ),
    ]
)


@check("metrics_long", oracle.compose(_METRICS_SQL))
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_long(metrics.metric_views(open_mart(spark, sf_dir)))


@check("metrics_from_sql", oracle.compose(_METRICS_SQL))
def metrics_from_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures from metric definitions whose SQL reads the temporary views."""
    metrics.metric_views(open_mart(spark, sf_dir), register=True)
    frames = [
        metrics.sql_metric(
            spark,
            {
                "name": m.name, "category": m.category,
                "query": f"SELECT {m.value} AS metric_value, {m.count} AS metric_count FROM {m.view}",
            },
        )
        for m in metrics.DEFAULT_METRICS
    ]
    return reduce(DataFrame.unionByName, frames)


# Metric versions: one per order year; the metric is an order priority's posted amount. 5-LOW counts from 2001 on, so its
# previous value is 0; 4-NOT SPECIFIED had another name before, so it has no history under its own.
_HISTORY_SQL = """
    SELECT o_orderpriority || CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND year(o_orderdate) < 2001 THEN ' (old)' ELSE '' END AS name,
           CAST(year(o_orderdate) AS VARCHAR(4)) AS version,
           sum(CASE WHEN o_orderpriority = '5-LOW' AND year(o_orderdate) < 2001 THEN 0
                    ELSE CAST(o_totalprice AS DECIMAL(20,2)) END) AS value, count(*) AS n
    FROM orders GROUP BY 1, 2"""
_COMPARED_SQL = f"""
    WITH versions AS ({_HISTORY_SQL})
    SELECT c.name, 'orders' AS category, CAST(c.value AS DOUBLE) AS value, c.n AS count,
           p.version AS previous_version, CAST(p.value AS DOUBLE) AS previous_value,
           CAST(c.value - p.value AS DOUBLE) AS difference,
           round(CASE WHEN p.value <> 0 THEN CAST(c.value - p.value AS DOUBLE) / CAST(p.value AS DOUBLE) * 100 END, 4)
             AS difference_pct,
           coalesce(p.value <> 0 AND abs(CAST(c.value - p.value AS DOUBLE) / CAST(p.value AS DOUBLE)) > 0.01, FALSE)
             AS out_of_tolerance
    FROM versions c LEFT JOIN (SELECT * FROM versions WHERE version < '2001'
                               QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1) p
      ON p.name = c.name
    WHERE c.version = '2001'"""


def _metric_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    year, name = F.year("o_orderdate"), F.col("o_orderpriority")
    amount = F.when((name == "5-LOW") & (year < 2001), F.lit(0)).otherwise(_money("o_totalprice"))
    renamed = F.when((name == "4-NOT SPECIFIED") & (year < 2001), F.concat(name, F.lit(" (old)"))).otherwise(name)
    versions = (
        base_table(spark, sf_dir, "orders")
        .groupBy(renamed.alias("METRIC_NAME"), year.alias("year"))
        .agg(F.sum(amount).cast("decimal(20,2)").alias("METRIC_VALUE"), F.count(F.lit(1)).alias("METRIC_COUNT"))
        .withColumns(
            {
                "RUN_VERSION": F.col("year").cast("string"),
                "RUN_DATE": F.make_date("year", F.lit(12), F.lit(31)),
                "LOADDATETIME": F.make_date("year", F.lit(12), F.lit(31)).cast("timestamp"),
            }
        )
    )
    current = versions.filter("year = 2001").select(
        F.col("METRIC_NAME").alias("name"), F.lit("orders").alias("category"),
        F.col("METRIC_VALUE").alias("value"), F.col("METRIC_COUNT").alias("count"),
    )
    return current, versions.filter("year < 2001")


@check("metric_compare", _COMPARED_SQL)
def metric_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare.compare_metrics(*_metric_versions(spark, sf_dir))
    return compared.withColumn("difference_pct", F.round(F.col("difference_pct").cast("double"), 4))


@check(
    "metric_categories",
    f"SELECT category, count(*) AS metrics, count_if(out_of_tolerance) AS out_of_tolerance FROM ({_COMPARED_SQL}) "
    "GROUP BY 1",
)
def metric_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.category_summary(compare.compare_metrics(*_metric_versions(spark, sf_dir)))


@check(
    "metric_history_latest",
    f"""SELECT name AS METRIC_NAME, version AS RUN_VERSION, CAST(value AS DOUBLE) AS METRIC_VALUE, n AS METRIC_COUNT
        FROM ({_HISTORY_SQL}) WHERE version < '2001'
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
)
def metric_history_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.latest_metrics(_metric_versions(spark, sf_dir)[1]).drop("RUN_DATE", "LOADDATETIME")


@check(
    "metric_history_append",
    f"""SELECT name AS METRIC_NAME, version AS RUN_VERSION, CAST(value AS DOUBLE) AS METRIC_VALUE, n AS METRIC_COUNT,
               NULL AS PREVIOUS_RUN_VERSION, CAST(NULL AS DOUBLE) AS VALUE_DIFFERENCE
        FROM ({_HISTORY_SQL}) WHERE version < '2001'
        UNION ALL SELECT name, '2001', value, count, previous_version, difference FROM ({_COMPARED_SQL})""",
)
def metric_history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier versions are stored, the new one is compared with them and appended."""
    current, earlier = _metric_versions(spark, sf_dir)
    path = scratch_path(spark, "metric-history")
    shape = schemas.MART["mat_metric_summary"]
    writers.append(schemas.conform(earlier, shape), path)
    stored = VersionedTable(spark, path)
    compared = compare.compare_metrics(current, stored.read(schemas.ddl(shape)))
    writers.append(metrics.summary_rows(compared, "2001", date(2001, 12, 31), "orders"), path)
    return stored.read(schemas.ddl(shape)).select(
        "METRIC_NAME", "RUN_VERSION", "METRIC_VALUE", "METRIC_COUNT", "PREVIOUS_RUN_VERSION", "VALUE_DIFFERENCE"
    )


# Before: finished orders. After: finished and open ones; those of priority 1-URGENT cost one more, those of 2-HIGH
# changed customer and cost one more.
@check(
    "baseline_diff",
    """
    WITH old AS (SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'),
    new AS (SELECT * FROM orders WHERE o_orderstatus <> 'O')
    SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey,
           CASE WHEN old.o_orderkey IS NULL THEN 'added' WHEN new.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END
             AS change,
           CASE WHEN old.o_orderkey IS NOT NULL AND new.o_orderkey IS NOT NULL THEN
             CASE new.o_orderpriority WHEN '1-URGENT' THEN 'amount' ELSE 'o_custkey,amount' END END AS changed_columns
    FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey
    WHERE old.o_orderkey IS NULL OR new.o_orderkey IS NULL OR new.o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def baseline_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_table(spark, sf_dir, "orders").withColumn("amount", _money("o_totalprice"))
    columns = ["o_orderkey", "o_custkey", "amount", "o_orderdate"]
    before = rows.filter("o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'").select(*columns)
    priority = F.col("o_orderpriority")
    after = rows.filter("o_orderstatus <> 'O'").withColumns(
        {
            "amount": F.when(priority.isin("1-URGENT", "2-HIGH"), F.col("amount") + 1).otherwise(F.col("amount")),
            "o_custkey": F.when(priority == "2-HIGH", F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
        }
    ).select(*columns)
    return compare.diff_rows(before, after, ["o_orderkey"])


# ---- run log ------------------------------------------------------------------------------------------------------
# Every event is a run of the process named by its type. It lasts as many seconds as its value says; errors fail.
_RUNS_SQL = """
    SELECT event_type AS process, ts AS started, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS ended,
           user_id AS n, value >= 200 AS failed
    FROM events"""


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = base_table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.round(F.col("value") * 1000).cast("bigint") * 1000)
    failed = F.col("value") >= 200
    runs = events.select(
        F.col("event_type").alias("ProcessName"),
        F.col("event_id").cast("string").alias("RunId"),
        F.explode(
            F.array(
                F.struct(
                    start.alias("EventTime"), F.lit("RUNNING").alias("Status"),
                    F.lit(None).cast("bigint").alias("RowsProcessed"), F.lit(None).cast("string").alias("ErrorMessage"),
                ),
                F.struct(
                    end.alias("EventTime"), F.when(failed, "FAILED").otherwise("SUCCESS").alias("Status"),
                    F.when(~failed, F.col("user_id")).alias("RowsProcessed"),
                    F.when(failed, F.lit("too slow")).alias("ErrorMessage"),
                ),
            )
        ).alias("e"),
    )
    return runs.select("ProcessName", "RunId", "e.*")


@check(
    "etl_run_state",
    f"""
    SELECT process AS ProcessName, max(started) AS LastRunStart, max(ended) AS LastRunEnd,
           max(ended) FILTER (WHERE NOT failed) AS LastSuccessfulRunEnd,
           arg_max(n, ended) FILTER (WHERE NOT failed) AS RowsProcessed, min(started) AS CreatedDateTime
    FROM ({_RUNS_SQL}) GROUP BY 1""",
)
def etl_run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = runlog.run_state(_event_log(spark, sf_dir))
    times = ("LastRunStart", "LastRunEnd", "LastSuccessfulRunEnd", "CreatedDateTime")
    return state.select(
        "ProcessName", "RowsProcessed", *[F.col(c).cast("timestamp_ntz").alias(c) for c in times]
    )


@check(
    "etl_status",
    f"""
    SELECT process AS ProcessName,
           CASE WHEN arg_max(failed, ended) THEN 'FAILED' ELSE 'SUCCESS' END AS LastRunStatus,
           date_diff('minute', max(started), max(ended)) AS LastRunDurationMinutes,
           arg_max(n, ended) FILTER (WHERE NOT failed) AS RowsProcessed,
           date_diff('hour', max(ended) FILTER (WHERE NOT failed), TIMESTAMP '2024-02-01 00:30:00')
             AS HoursSinceLastSuccess
    FROM ({_RUNS_SQL}) GROUP BY 1""",
)
def etl_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:30:00").cast("timestamp")
    return runlog.etl_status(runlog.run_state(_event_log(spark, sf_dir)), as_of).drop("LastSuccessfulRunEnd")


# ---- operators ----------------------------------------------------------------------------------------------------
@check(
    "surrogate_key_dense",
    "SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS OrderKey, o_orderkey, o_custkey FROM orders",
)
def surrogate_key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = base_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_key(orders, "OrderKey", ["o_custkey", "o_orderkey"])


@check(
    "surrogate_key_stable",
    """WITH early AS (
           SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS OrderKey
           FROM orders WHERE o_orderdate >= DATE '1997-01-01'
       )
       SELECT o_custkey, o_orderkey, OrderKey FROM early
       UNION ALL
       SELECT o_custkey, o_orderkey,
              (SELECT max(OrderKey) FROM early) + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS OrderKey
       FROM orders WHERE o_orderdate < DATE '1997-01-01'""",
)
def surrogate_key_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the second load adds older orders, many with lower ids; keys of the first load stay."""
    orders = base_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    natural = ["o_custkey", "o_orderkey"]
    first, _ = stable_key(orders.filter("o_orderdate >= DATE '1997-01-01'"), "OrderKey", natural)
    return stable_key(orders, "OrderKey", natural, first)[0].select(*natural, "OrderKey")


@check(
    "sa_renewal_year",
    oracle.compose("SELECT a.id, a.renewalgroupinitialagreement_id, a.startdate, a.RenewalYear FROM m_agreement a"),
)
def sa_renewal_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.with_renewal_year(_src(spark, sf_dir)["serviceagreement"]).select(
        "id", "renewalgroupinitialagreement_id", "startdate", "RenewalYear"
    )


@check(
    "status_name_map",
    oracle.compose(
        """SELECT coalesce(['Draft', 'Pending', 'Active', 'Complete', 'Cancelled'][status], 'Unknown') AS StatusName,
                  count(*) AS agreements
           FROM r_serviceagreement GROUP BY 1"""
    ),
)
def status_name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _src(spark, sf_dir)["serviceagreement"].groupBy(status_name(F.col("status")).alias("StatusName")).agg(
        F.count(F.lit(1)).alias("agreements")
    )


_EAV_LATEST = """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""


def _latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = base_table(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@check("eav_latest", _EAV_LATEST)
def eav_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_events(spark, sf_dir)


_EVENT_COLUMNS = {"purchase": "CommissionType", "click": "Job", "view": "Year1", "signup": "Year2", "error": "Year3Plus"}


@check(
    "eav_pivot_rates",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(max(CAST(value AS DECIMAL(20,2))) FILTER (WHERE event_type = '{e}') AS DOUBLE) AS {c}"
        for e, c in _EVENT_COLUMNS.items()
    )
    + f" FROM ({_EAV_LATEST}) GROUP BY user_id",
)
def eav_pivot_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eav_pivot(_latest_events(spark, sf_dir), ["user_id"], "event_type", _money("value"), _EVENT_COLUMNS)


@check(
    "try_decimal_parse",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS texts, count(parsed) AS numbers, CAST(sum(parsed) AS DOUBLE) AS total
    FROM (SELECT l_returnflag, l_linestatus,
                 TRY_CAST(concat(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'x' ELSE ' ' END,
                                 CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR),
                                 CASE WHEN l_linestatus = 'O' THEN '5' ELSE '' END) AS DECIMAL(10,2)) AS parsed
          FROM lineitem) GROUP BY ALL""",
)
def try_decimal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    text = F.concat(
        F.when((flag == "R") & (status == "F"), "x").otherwise(" "),
        _money("l_extendedprice").cast("string"),
        F.when(status == "O", "5").otherwise(""),
    )
    parsed = try_decimal(text)
    return base_table(spark, sf_dir, "lineitem").groupBy(flag, status).agg(
        F.count(F.lit(1)).alias("texts"), F.count(parsed).alias("numbers"), F.sum(parsed).alias("total")
    )


@check(
    "bitmask_filter",
    "SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS size FROM part WHERE (p_size & 8) = 8 GROUP BY 1",
)
def bitmask_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        base_table(spark, sf_dir, "part").filter(F.col("p_size").bitwiseAND(8) == 8)
        .groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("size"))
    )


@check("salesperson_by_name", oracle.compose(oracle.FIRST_SELLER))
def salesperson_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = open_mart(spark, sf_dir)
    return facts.job_salespeople(mart.src, mart, SETTINGS).drop("TenantId")


@check(
    "primary_location_min",
    oracle.compose(
        "SELECT serviceagreement_id, min(locationid) AS locationid FROM r_serviceagreementlocation WHERE active = 1 GROUP BY 1"
    ),
)
def primary_location_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.primary_locations(_src(spark, sf_dir)).drop("_tenant_id")


@check(
    "semi_join_exists",
    """SELECT c_custkey, c_name FROM customer c
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
                       AND o.o_orderpriority = '1-URGENT')""",
)
def semi_join_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = base_table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return (
        base_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        .join(urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    )


@check(
    "anti_join_not_exists",
    oracle.compose(
        """SELECT id, invoice_id, CAST(amount AS DOUBLE) AS amount FROM r_purchaseorder p
           WHERE NOT EXISTS (SELECT 1 FROM r_inventoryshipment s WHERE s.purchaseorder_id = p.id AND s.bill_id IS NOT NULL)"""
    ),
)
def anti_join_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.unbilled_orders(_src(spark, sf_dir), SETTINGS).select("id", "invoice_id", "amount")


@check(
    "full_outer_commission",
    """
    WITH early AS (SELECT CASE WHEN l_tax > 0 THEN l_suppkey END AS k, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS v
                   FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    late AS (SELECT CASE WHEN l_tax > 0 THEN l_suppkey + 7 END AS k, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS v
             FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
    SELECT coalesce(e.k, l.k) AS l_suppkey, CAST(coalesce(e.v, 0) AS DOUBLE) AS early,
           CAST(coalesce(l.v, 0) AS DOUBLE) AS late
    FROM early e FULL JOIN late l ON e.k = l.k""",
)
def full_outer_commission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys do not match each other, so both sides keep their own NULL row."""
    lines = base_table(spark, sf_dir, "lineitem")

    def side(condition: str, shift: int, name: str) -> DataFrame:
        key = F.when(F.col("l_tax") > 0, F.col("l_suppkey") + shift)
        return lines.filter(condition).groupBy(key.alias("l_suppkey")).agg(
            F.sum(_money("l_extendedprice")).alias(name)
        )

    early = side("l_returnflag = 'R'", 0, "early")
    late = side("l_returnflag = 'A'", 7, "late")
    return early.join(late, "l_suppkey", "full_outer").select(
        "l_suppkey", or_zero(F.col("early")).alias("early"), or_zero(F.col("late")).alias("late")
    )


@check(
    "tiered_commission",
    oracle.compose(
        """SELECT o_orderkey, CAST(CASE RenewalYear WHEN 1 THEN CAST(o_totalprice AS DECIMAL(20,2)) * 10.0
                                    WHEN 2 THEN CAST(o_totalprice AS DECIMAL(20,2)) * 7.5
                                    ELSE CAST(o_totalprice AS DECIMAL(20,2)) * 5.0 END AS DOUBLE) / 100 AS commission
           FROM orders JOIN m_agreement a ON a.id = o_orderkey"""
    ),
)
def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = dims.with_renewal_year(_src(spark, sf_dir)["serviceagreement"]).select(
        F.col("id").alias("o_orderkey"), "RenewalYear"
    )
    first, second, later = F.lit(10.0), F.lit(7.5), F.lit(5.0)
    commission = tiered_commission(F.col("RenewalYear"), _money("o_totalprice"), first, second, later)
    return base_table(spark, sf_dir, "orders").join(years, "o_orderkey").select(
        "o_orderkey", ((commission * 100).cast("double") / 100).alias("commission")
    )


@check(
    "listagg_distinct_numeric",
    "SELECT l_orderkey, listagg(DISTINCT l_partkey, ', ' ORDER BY l_partkey) AS items FROM lineitem GROUP BY 1",
)
def listagg_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = base_table(spark, sf_dir, "lineitem")
    return listagg_distinct(lines, ["l_orderkey"], {"items": Listed(F.col("l_partkey"), numeric=True, chunk=64)})


@check(
    "listagg_distinct_string",
    """SELECT l_orderkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) FILTER (WHERE l_returnflag = 'R') AS sellers,
              listagg(DISTINCT l_partkey, ', ' ORDER BY l_partkey) FILTER (WHERE l_returnflag = 'R') AS parts,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE) AS total
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""",
)
def listagg_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    sellers = base_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return listagg_distinct(
        base_table(spark, sf_dir, "lineitem").join(sellers, "l_suppkey"), ["l_orderkey"],
        {
            "sellers": Listed(F.col("s_name"), numeric=False, chunk=17),
            "parts": Listed(F.col("l_partkey"), numeric=True),
        },
        where=F.col("l_returnflag") == "R",
        sums={"total": _money("l_extendedprice")},
    )


@check(
    "optional_param_filter",
    """SELECT 'all' AS filter, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL
       UNION ALL SELECT 'F and P', o_orderstatus, count(*) FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY ALL""",
)
def optional_param_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = base_table(spark, sf_dir, "orders")

    def counted(name: str, statuses: tuple) -> DataFrame:
        return report.optional_in(orders, "o_orderstatus", statuses).groupBy(
            F.lit(name).alias("filter"), "o_orderstatus"
        ).agg(F.count(F.lit(1)).alias("orders"))

    return counted("all", ()).unionByName(counted("F and P", ("F", "P")))


@check(
    "period_containment",
    oracle.compose(
        oracle.typed(
            {"ServiceAgreementId": "bigint", "SAName": "string", "SARenewalYear": "int", "TotalRevenue": "decimal"},
            """SELECT ServiceAgreementId, max(SAName) AS SAName, max(SARenewalYear) AS SARenewalYear,
                      sum(RevenueRecognitionAmount) AS TotalRevenue
               FROM m_fact_serviceagreement
               WHERE PeriodStartDate >= DATE '2024-01-10' AND PeriodEndDate <= DATE '2024-01-31' GROUP BY 1""",
        )
    ),
)
def period_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = open_mart(spark, sf_dir)["fact_serviceagreement"].filter(
        (F.col("PeriodStartDate") >= F.lit(date(2024, 1, 10))) & (F.col("PeriodEndDate") <= F.lit(date(2024, 1, 31)))
    )
    return report.collapse_periods(periods).select("ServiceAgreementId", "SAName", "SARenewalYear", "TotalRevenue")


@check(
    "halfopen_vs_closed_range",
    """SELECT l_returnflag, count_if(d BETWEEN DATE '1996-03-01' AND DATE '1996-03-31') AS closed,
              count_if(d >= DATE '1996-03-01' AND d < DATE '1996-03-31') AS halfopen
       FROM (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY 1""",
)
def halfopen_vs_closed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, first, last = F.col("l_shipdate").cast("date"), F.lit(date(1996, 3, 1)), F.lit(date(1996, 3, 31))
    return base_table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(day.between(first, last)).alias("closed"),
        F.count_if((day >= first) & (day < last)).alias("halfopen"),
    )


# ---- write modes --------------------------------------------------------------------------------------------------
@check(
    "insert_missing",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE 'new' END AS origin FROM orders""",
)
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = base_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "insert-missing")
    writers.write_full(
        orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("old").alias("origin")), path
    )
    rows = orders.select("o_orderkey", F.lit("new").alias("origin"))
    shape, stored = "o_orderkey bigint, origin string", VersionedTable(spark, path)
    writers.insert_missing(rows, stored.read(shape), path, ["o_orderkey"])
    return stored.read(shape)


@check(
    "period_replace",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS amount, make_date(year(o_orderdate), 1, 1) AS PeriodStartDate
       FROM orders WHERE year(o_orderdate) <> 1997 AND (year(o_orderdate) <> 1996 OR o_orderstatus = 'F')""",
)
def period_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: all years are written, then 1996 is replaced by fewer rows and 1997 by none; other years stay."""
    tenant = SETTINGS.tenant_ids[0]
    year = F.year("o_orderdate")
    rows = base_table(spark, sf_dir, "orders").select(
        "o_orderkey", _money("o_totalprice").alias("amount"), "o_orderstatus", year.alias("year"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("PeriodStartDate"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("PeriodEndDate"), F.lit(tenant).alias("TenantId"),
    )
    path = scratch_path(spark, "period-replace")
    stored = VersionedTable(spark, path)
    years = [r["PeriodStartDate"].year for r in rows.select("PeriodStartDate").distinct().collect()]
    periods = [(date(y, 1, 1), date(y, 12, 31), tenant) for y in years]
    stored.replace_parts(rows.drop("year", "o_orderstatus"), schemas.PERIOD_COLUMNS, periods)
    for replaced, condition in ((1996, "year = 1996 AND o_orderstatus = 'F'"), (1997, "year = 1997 AND false")):
        writers.write_period(
            rows.filter(condition).drop("year", "o_orderstatus"), path, date(replaced, 1, 1), date(replaced, 12, 31),
            [tenant],
        )
    shape = (
        "o_orderkey bigint, amount decimal(20,2), PeriodStartDate date, PeriodEndDate date, TenantId bigint"
    )
    return stored.read(shape).drop("PeriodEndDate", "TenantId")


@check(
    "upsert_incremental",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) * CASE WHEN o_orderdate >= DATE '1999-12-31' THEN 2 ELSE 1 END
              AS amount
       FROM orders WHERE o_orderdate >= DATE '1999-12-31' OR o_orderstatus <> 'P'""",
)
def upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders changed from the last day of 1999 on arrive doubled; those not yet in the target (status P) are new."""
    orders = base_table(spark, sf_dir, "orders").withColumn("amount", _money("o_totalprice"))
    target = orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "amount")
    changes = changed_since(orders, "o_orderdate", F.lit(date(1999, 12, 31)).cast("timestamp_ntz")).select(
        "o_orderkey", (F.col("amount") * 2).cast("decimal(20,2)").alias("amount")
    )
    return upsert(target, changes, ["o_orderkey"])


# ---- quality gates ------------------------------------------------------------------------------------------------
_GATES = {"orders": 1000, "lineitem": 4000, "region": 5, "nation": 26, "events": 1000}


@check(
    "dq_min_rows",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", CAST({n} AS BIGINT) AS expected, count(*) AS actual, count(*) >= {n} AS ok FROM {t}"
        for t, n in _GATES.items()
    ),
)
def dq_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.min_rows({t: base_table(spark, sf_dir, t) for t in _GATES}, _GATES)


@check(
    "dq_load_status",
    """SELECT p.p_partkey, count(l_orderkey) AS RowsProcessed,
              CASE WHEN count(l_orderkey) = 0 THEN 'SUCCESS_NO_DATA' ELSE 'SUCCESS' END AS Status
       FROM (SELECT p_partkey FROM part UNION ALL SELECT p_partkey + 1000000000 FROM part) p
       LEFT JOIN lineitem l ON l_partkey = p.p_partkey GROUP BY 1""",
)
def dq_load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per part number; half of the numbers are of parts that no line has."""
    parts = base_table(spark, sf_dir, "part").select("p_partkey")
    parts = parts.unionByName(parts.select((F.col("p_partkey") + 1000000000).alias("p_partkey")))
    loaded = base_table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    counts = parts.join(loaded, "p_partkey", "left").select("p_partkey", or_zero(F.col("n")).alias("RowsProcessed"))
    return quality.load_status(counts)


@check(
    "dq_unique_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS \"rows\" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(base_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _nulls_sql(source: str, columns: tuple[str, ...]) -> str:
    return oracle.compose(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS \"rows\" FROM {source}"
            for c in columns
        )
    )


_ITEM_COLUMNS = ("id", "invoice_id", "skureference_skuid", "skureference_skutype", "procurementsource_purchaseorderitemid")


@check("dq_nulls", _nulls_sql("r_invoiceitem", _ITEM_COLUMNS))
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_src(spark, sf_dir)["invoiceitem"], _ITEM_COLUMNS)


@check("dq_unresolved_keys", _nulls_sql("m_fact_invoiceitem", schemas.DIMENSION_KEYS["fact_invoiceitem"]))
def dq_unresolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(
        open_mart(spark, sf_dir)["fact_invoiceitem"], schemas.DIMENSION_KEYS["fact_invoiceitem"]
    )


# ---- distinct counts, incremental loads, streams, gates inside a load -------------------------------------------------
@check(
    "distinct_count_marks",
    """SELECT l_orderkey, count(DISTINCT l_linenumber) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
              count(DISTINCT CASE WHEN l_tax > 0 THEN l_partkey * 256 END) AS parts
       FROM lineitem GROUP BY 1""",
)
def distinct_count_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers often repeat within an order; part numbers that all fall on one place are all counted again."""
    lines = base_table(spark, sf_dir, "lineitem")
    numbers = sums_with_distinct(lines, ["l_orderkey"], "l_linenumber", "lines", F.sum("l_quantity").cast("double").alias("quantity"))
    places = lines.select("l_orderkey", F.when(F.col("l_tax") > 0, F.col("l_partkey") * 256).alias("part"))
    return numbers.join(sums_with_distinct(places, ["l_orderkey"], "part", "parts"), "l_orderkey")


class _Earlier(Mapping):
    """The sources as they were before: every 50th invoice or job differs in one of nine ways."""

    def __init__(self, src) -> None:
        self._src = src

    def __iter__(self):
        return iter(self._src)

    def __len__(self) -> int:
        return len(self._src)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._src[name]
        if name == "invoiceitem":
            nth = F.col("invoice_id") % 50
            gone = df.filter(nth == 3).withColumn("id", F.col("id") + 10**12)
            return df.filter((nth != 0) | (F.col("id") % 8 != 1)).withColumns(
                {
                    "invoice_id": F.when(nth == 1, F.col("invoice_id") + 1).otherwise(F.col("invoice_id")),
                    "total": F.when(nth == 2, F.col("total") * 2).otherwise(F.col("total")).cast(df.schema["total"].dataType),
                }
            ).unionByName(gone)
        if name in ("grosspayitem", "purchaseorder"):
            nth = F.col("invoice_id") % 50
            return df.withColumns(
                {
                    "amount": F.when(nth == 4, F.col("amount") * 2).otherwise(F.col("amount")).cast("decimal(10,2)"),
                    "invoice_id": F.when(nth == 5, F.col("invoice_id") - 1).otherwise(F.col("invoice_id")),
                }
            )
        if name == "invoice":
            nth = F.col("id") % 50
            return df.withColumns(
                {
                    "invoicedon": F.when(nth == 6, F.date_sub("invoicedon", 40)).otherwise(F.col("invoicedon")),
                    "status": F.when(nth == 7, F.lit(1)).otherwise(F.col("status")),
                }
            )
        if name == "job":
            moved = F.when(F.col("id") % 50 == 8, F.col("customer_id") + 1).otherwise(F.col("customer_id"))
            return df.withColumn("customer_id", moved)
        return df


_LOADED = (
    "dim_date", "dim_businessunit", "dim_customer", "dim_employee", "dim_glaccount", "dim_job", "dim_jobtype", "dim_location", "dim_sku",
    "mat_employee_commissionrates", "mat_invoice_revenue", "mat_invoice_materialcosts", "mat_invoice_pocosts", "mat_invoice_laborcosts",
    "mat_job_returns", "fact_invoice", "fact_invoiceitem",
)
# The bound lines repeat ids, which the unique-key gate reports.
_RECORD = SETTINGS.with_(gates="record")


def _loaded(spark: SparkSession, sources, root: str, incremental: bool = False):
    log = runlog.RunLog(spark, f"{root}/etl_run_log")
    log.seed()
    pipeline.load_tables(spark, _RECORD, sources, pipeline.open_mart(spark, root), root, log, _LOADED, incremental)
    return pipeline.open_mart(spark, root)


@check("incremental_equals_full", oracle.table("fact_invoice", ("InvoiceKey",)), ("InvoiceKey",))
def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart is loaded from earlier sources, then refreshed for the invoices that the changes since then affect."""
    src, root = open_mart(spark, sf_dir).src, scratch_path(spark, "incremental")
    _loaded(spark, _Earlier(src), root)
    return _loaded(spark, src, root, incremental=True)["fact_invoice"]


def _gate_sql() -> str:
    nulls = "\n UNION ALL ".join(
        f"""SELECT '{'not null' if c in required else 'resolved'}' AS Gate, '{c}' AS ColumnName, count(*) AS RowsSeen, count(*) - count({c}) AS Findings,
               {f'count(*) = count({c})' if c in required else 'TRUE'} AS Passed FROM m_fact_invoiceitem"""
        for required in [("InvoiceItemId", "InvoiceId", "TenantId")]
        for c in (*required, *schemas.DIMENSION_KEYS["fact_invoiceitem"])
    )
    return f"""SELECT 'rows' AS Gate, NULL AS ColumnName, count(*) AS RowsSeen, count(*) AS Findings, TRUE AS Passed FROM m_fact_invoiceitem
        UNION ALL {nulls}
        UNION ALL SELECT 'unique', 'InvoiceItemId, TenantId', (SELECT count(*) FROM m_fact_invoiceitem), count(*), count(*) = 0
        FROM (SELECT InvoiceItemId FROM m_fact_invoiceitem GROUP BY InvoiceItemId, TenantId HAVING count(*) > 1)"""


@check("gate_results", oracle.compose(_gate_sql()))
def gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 as a load of the line fact has kept them: counted while it was written, and repeated keys."""
    root = scratch_path(spark, "gates")
    bound = open_mart(spark, sf_dir)
    log = runlog.RunLog(spark, f"{root}/etl_run_log")
    log.seed()
    pipeline.load_tables(spark, _RECORD, bound.src, bound, root, log, ("fact_invoiceitem",))
    kept = pipeline.open_mart(spark, root)["etl_gate_results"].filter("ProcessName = 'Fact_InvoiceItem'")
    return kept.select("Gate", "ColumnName", "RowsSeen", "Findings", "Passed")


@check("stream_bucket_upsert", _EAV_LATEST)
def stream_bucket_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of three batches; the second is delivered once more, and changes nothing."""
    events = base_table(spark, sf_dir, "events")
    keys, newest = ["user_id", "event_type"], ["ts", "event_id"]
    folder = scratch_path(spark, "stream")
    for batch in range(3):
        events.filter(F.col("event_id") % 3 == batch).coalesce(1).write.mode("append").parquet(f"{folder}/events")
    target = BucketedTable(spark, f"{folder}/target", events.schema, keys, buckets=8)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    refresh_from_stream(stream, target, newest, f"{folder}/checkpoint").awaitTermination()
    target.apply(events.filter("event_id % 3 = 1").withColumn("value", F.lit(-1.0)), newest, "stream", batch=1)
    return target.read()


_FILE = Path(__file__).with_name("metrics.yaml")
_FILE_WINDOW = "BETWEEN DATE '1997-03-01' AND DATE '1998-06-30'"
_FILE_SELLERS = "(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)"


@check(
    "metrics_from_file",
    oracle.compose(
        " UNION ALL ".join(
            [
                _metric_sql(
                    "margin_of_sellers", "job", "sum(JobMargin)", "count(JobMargin)",
                    f"m_job_side WHERE PostedDate {_FILE_WINDOW} AND EmployeeId IN {_FILE_SELLERS}",
                ),
                _metric_sql(
                    "invoices_of_window", "invoice", "count(DISTINCT InvoiceId)", "count(*)",
                    f"({_INVOICE_VIEW_SQL}) WHERE InvoiceDate {_FILE_WINDOW}",
                ),
                _metric_sql(
                    "commission_of_sellers", "employee", "sum(TotalCommission)", "count(DISTINCT EmployeeId)",
                    f"m_employee_metrics WHERE EmployeeId IN {_FILE_SELLERS}",
                ),
            ]
        )
    ),
)
def metrics_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric file's queries with its parameters bound; the one that returns several rows is left out."""
    given = metrics.load_metric_file(str(_FILE), SETTINGS)
    metrics.metric_views(open_mart(spark, sf_dir), register=True)
    frames = {m["name"]: metrics.sql_metric(spark, m, given.args) for m in given.metrics}
    found, errors = metrics.run_metrics(frames, spark, single=True)
    if list(errors) != ["one_row_per_type"]:
        raise ValueError(errors)
    return found
