"""Named metrics over the report views, run by run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.plans import report
from martloom.plans.facts import Mart
from martloom.settings import MartSettings

RESULT = "name string, category string, value decimal(20,2), count bigint"


@dataclass(frozen=True)
class Metric:
    """``value`` and ``count`` are aggregate expressions over ``view``."""

    name: str
    category: str
    view: str
    value: str
    count: str


# The metrics tracked by default.
DEFAULT_METRICS = (
    Metric("job_revenue_total", "job", "job_metrics", "sum(JobRevenue)", "count(JobRevenue)"),
    Metric("job_cost_total", "job", "job_metrics", "sum(JobCost)", "count(JobCost)"),
    Metric("job_margin_total", "job", "job_metrics", "sum(JobMargin)", "count(JobMargin)"),
    Metric("job_commission_total", "job", "job_metrics", "sum(JobCommission)", "count(JobCommission)"),
    Metric(
        "sa_revenue_total", "service_agreement", "sa_metrics", "sum(ServiceAgreementRevenue)",
        "count(ServiceAgreementRevenue)",
    ),
    Metric(
        "sa_commission_total", "service_agreement", "sa_metrics", "sum(ServiceAgreementCommission)",
        "count(ServiceAgreementCommission)",
    ),
    Metric(
        "sa_margin_total", "service_agreement", "sa_metrics", "sum(ServiceAgreementMargin)",
        "count(ServiceAgreementMargin)",
    ),
    Metric(
        "invoice_count", "invoice", "invoice_metrics", "count(DISTINCT InvoiceId)", "count(DISTINCT InvoiceId)",
    ),
    Metric(
        "employee_commission_total", "employee", "employee_metrics", "sum(TotalCommission)",
        "count(DISTINCT CASE WHEN TotalCommission IS NOT NULL THEN EmployeeId END)",
    ),
)

VIEWS = {
    "job_metrics": report.job_metrics,
    "sa_metrics": report.sa_metrics,
    "invoice_metrics": report.invoice_metrics,
    "employee_metrics": report.employee_metrics,
}


def metric_views(mart: Mart, register: bool = False) -> dict[str, DataFrame]:
    """The four views by name; optionally also as temporary views for metrics written in SQL."""
    views = {name: build(mart) for name, build in VIEWS.items()}
    if register:
        for name, view in views.items():
            view.createOrReplaceTempView(name)
    return views


def view_metrics(view: DataFrame, metrics: Iterable[Metric]) -> DataFrame:
    """All metrics of one view from a single aggregate, as rows (name, category, value, count)."""
    metrics = list(metrics)
    sums = []
    for number, metric in enumerate(metrics):
        sums.append(F.expr(metric.value).cast("decimal(20,2)").alias(f"v{number}"))
        sums.append(F.expr(metric.count).cast("bigint").alias(f"c{number}"))
    zero = F.lit(0)
    rows = F.array(
        *[
            F.struct(
                F.lit(metric.name).alias("name"),
                F.lit(metric.category).alias("category"),
                F.coalesce(f"v{number}", zero).cast("decimal(20,2)").alias("value"),
                F.coalesce(f"c{number}", zero).cast("bigint").alias("count"),
            )
            for number, metric in enumerate(metrics)
        ]
    )
    return view.agg(*sums).select(F.inline(rows))


def metrics_long(views: Mapping[str, DataFrame], metrics: Iterable[Metric] = DEFAULT_METRICS) -> DataFrame:
    """Every metric as a row; one pass per view."""
    by_view: dict[str, list[Metric]] = {}
    for metric in metrics:
        by_view.setdefault(metric.view, []).append(metric)
    return reduce(DataFrame.unionByName, [view_metrics(views[name], group) for name, group in by_view.items()])


def sql_metric(spark: SparkSession, definition: Mapping[str, str], args: Mapping[str, object] | None = None) -> DataFrame:
    """A metric given as SQL over the registered views; its query returns metric_value and metric_count.

    ``args`` are bound to the query's named parameters as values, never as text.
    """
    zero = F.lit(0)
    return spark.sql(definition["query"], args=dict(args or {})).select(
        F.lit(definition["name"]).alias("name"),
        F.lit(definition.get("category", "general")).alias("category"),
        F.coalesce("metric_value", zero).cast("decimal(20,2)").alias("value"),
        F.coalesce("metric_count", zero).cast("bigint").alias("count"),
    )


@dataclass(frozen=True)
class MetricFile:
    """One run as a file describes it."""

    version: str
    run_date: date
    description: str
    settings: MartSettings
    args: Mapping[str, object]
    metrics: tuple[Mapping[str, str], ...]
    tolerance: float


def load_metric_file(path: str, settings: MartSettings) -> MetricFile:
    """Read a YAML file with ``version``, ``run_date``, ``description``, ``parameters``, ``metrics`` and ``comparison``.

    The window, tenants and optional filters replace those of ``settings`` (F4, F10: a filter whose flag is 0 is none), and are
    what queries can name. A version is a text, whatever it looks like.
    """
    import yaml

    with open(path) as handle:
        found = yaml.safe_load(handle)
    given = found.get("parameters") or {}

    def day(name: str, otherwise: date) -> date:
        return date.fromisoformat(str(given[name])) if name in given else otherwise

    def filtered(flag: str, values: str) -> tuple[int, ...]:
        return tuple(given.get(values) or ()) if given.get(flag) else ()

    settings = settings.with_(
        from_date=day("from_date", settings.from_date), to_date=day("to_date", settings.to_date),
        tenant_ids=tuple(given.get("tenant_ids", settings.tenant_ids)),
        employee_ids=filtered("employee_id_specified", "employee_ids"), status_filter=filtered("filter_status_specified", "filter_status"),
    )

    def numbers(values: Sequence[int]):
        return F.array(*[F.expr(f"{int(v)}L") for v in values])

    args = {
        "from_date": settings.from_date, "to_date": settings.to_date, "tenant_ids": numbers(settings.tenant_ids),
        "employee_id_specified": int(bool(settings.employee_ids)), "employee_ids": numbers(settings.employee_ids),
        "filter_status_specified": int(bool(settings.status_filter)), "filter_status": numbers(settings.status_filter),
    }
    tolerance = (found.get("comparison") or {}).get("tolerance_pct", 0.01)
    return MetricFile(
        str(found["version"]), date.fromisoformat(str(found.get("run_date") or date.today())), found.get("description", ""), settings, args,
        tuple(found.get("metrics") or ()), float(tolerance),
    )


def run_metrics(frames: Mapping[str, DataFrame], spark: SparkSession, single: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Run each frame of metrics on its own, so that one failing query leaves the others' results.

    Only the metric rows themselves (a handful per frame) come to the driver; with ``single``, for queries that users write,
    at most two of a frame, and two are an error. Returns results and errors by frame name.
    """
    rows, errors = [], {}
    for name, frame in frames.items():
        try:
            found = frame.limit(2).collect() if single else frame.collect()
            if single and len(found) != 1:
                raise ValueError(f"{'no row' if not found else 'more than one row'}; a metric is one row")
            rows.extend(found)
        except Exception as error:  # noqa: BLE001 - reported to the caller
            errors[name] = str(error)
    return spark.createDataFrame(rows, RESULT), errors


def summary_rows(compared: DataFrame, version: str, run_date, description: str) -> DataFrame:
    """Compared metrics in the shape of the metric history."""
    return schemas.conform(
        compared.select(
            F.lit(version).alias("RUN_VERSION"),
            F.lit(run_date).cast("date").alias("RUN_DATE"),
            F.lit(description).alias("RUN_DESCRIPTION"),
            F.col("name").alias("METRIC_NAME"),
            F.col("category").alias("METRIC_CATEGORY"),
            F.col("value").alias("METRIC_VALUE"),
            F.col("count").alias("METRIC_COUNT"),
            F.col("previous_version").alias("PREVIOUS_RUN_VERSION"),
            F.col("previous_value").alias("PREVIOUS_METRIC_VALUE"),
            F.col("difference").alias("VALUE_DIFFERENCE"),
            F.col("difference_pct").alias("VALUE_DIFFERENCE_PCT"),
            F.current_timestamp().alias("LOADDATETIME"),
        ),
        schemas.MART["mat_metric_summary"],
    )


def category_summary(results: DataFrame) -> DataFrame:
    """Number of metrics per category and how many moved beyond the tolerance."""
    return results.groupBy("category").agg(
        F.count(F.lit(1)).alias("metrics"), F.count_if("out_of_tolerance").alias("out_of_tolerance")
    )
