"""Whole runs: sources -> dimensions -> measures -> facts, then metrics and the report snapshot.

Each table is written and read back before the next layer uses it, which also bounds every plan and its lineage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.operators.compare import compare_metrics, diff_rows
from martloom.operators.keys import clustered
from martloom.operators.quality import Contract, GateFailure, check_contract, contract_of, min_rows
from martloom.plans import changes, dims, facts, measures, metrics, report
from martloom.session import cut_lineage
from martloom.settings import MartSettings
from martloom.sinks.runlog import RunLog
from martloom.sinks.versions import Accept, Part, VersionedTable
from martloom.sinks.writers import append, empty, replace_run, stamp_run, with_audit, write_full, write_months, write_period
from martloom.sources.readers import mart_tables, read_keys, read_mart, read_sources

# table -> (run-log name, job). Order is a valid dependency order; agreement measures come before the agreement fact.
_MEASURES = {
    "mat_employee_commissionrates": ("Mat_Employee_CommissionRates", measures.employee_commission_rates),
    "mat_invoice_revenue": ("Mat_Invoice_Revenue", measures.invoice_revenue),
    "mat_invoice_materialcosts": ("Mat_Invoice_MaterialCosts", measures.invoice_material_costs),
    "mat_invoice_pocosts": ("Mat_Invoice_POCosts", measures.invoice_po_costs),
    "mat_invoice_laborcosts": ("Mat_Invoice_LaborCosts", measures.invoice_labor_costs),
    "mat_job_returns": ("Mat_Job_Returns", measures.job_returns),
    "mat_sa_period_measures": ("Mat_SA_Period_Measures", measures.sa_period_measures),
}
_FACTS = {
    "fact_invoice": ("Fact_Invoice", facts.fact_invoice),
    "fact_invoiceitem": ("Fact_InvoiceItem", facts.fact_invoiceitem),
    "fact_serviceagreement": ("Fact_ServiceAgreement", facts.fact_serviceagreement),
}
_LOG_NAMES = {
    "dim_date": "Dim_Date", "dim_tenant": "Dim_Tenant", "dim_businessunit": "Dim_BusinessUnit",
    "dim_customer": "Dim_Customer", "dim_employee": "Dim_Employee", "dim_glaccount": "Dim_GLAccount",
    "dim_job": "Dim_Job", "dim_jobtype": "Dim_JobType", "dim_location": "Dim_Location",
    "dim_serviceagreement": "Dim_ServiceAgreement", "dim_sku": "Dim_SKU",
}


def dimension(spark: SparkSession, table: str, src: dims.Sources, settings: MartSettings) -> DataFrame:
    """Any dimension by table name."""
    if table == "dim_date":
        return dims.dim_date(
            spark, settings.calendar_start, settings.calendar_end, settings.fiscal_start_month, settings.as_of
        )
    if table == "dim_tenant":
        return dims.dim_tenant(spark, settings.tenants)
    return dims.keyed(table, src, settings)


def build(table: str, spark: SparkSession, src: dims.Sources, mart: facts.Mart, settings: MartSettings) -> DataFrame:
    """Any mart table by name from its inputs."""
    if table in _MEASURES:
        return _MEASURES[table][1](src, settings)
    if table in _FACTS:
        return _FACTS[table][1](src, mart, settings)
    return dimension(spark, table, src, settings)


# The stored reports, and what names a row of a report.
BASELINE = "mat_report_baseline"
REPORT_KEYS = ("_TenantId", "JobId", "InvoiceId", "ServiceAgreementId")
TABLES = (*_LOG_NAMES, *_MEASURES, *_FACTS)


def log_name(table: str) -> str:
    return _LOG_NAMES.get(table) or {**_MEASURES, **_FACTS}[table][0]


def _load_dimension(spark: SparkSession, table: str, src: dims.Sources, mart: facts.Mart, settings: MartSettings, root: str) -> DataFrame:
    """A keyed dimension. Numbers once handed out are kept in ``_keys``, those of deleted members too.

    New numbers are stored there before the dimension is written, so a load that fails in between repeats with the same.
    """
    key, natural = dims.key_columns(table)
    known = read_keys(spark, root, table, [*natural, key])
    stored = known is not None
    if known is None and table in mart and mart.get(table) is not None:
        known = mart[table].select(*natural, key)
    rows, fresh = dims.keyed_with_new(table, src, settings, known)
    append(fresh if stored or known is None else known.unionByName(fresh), f"{root}/_keys/{table}")
    return rows


# What an incremental load refreshes by invoice, with the table's own key and layout where it has them.
_BY_INVOICE = {
    "mat_invoice_revenue": (None, ()), "mat_invoice_materialcosts": (None, ()), "mat_invoice_pocosts": (None, ()),
    "mat_invoice_laborcosts": (None, ()), "fact_invoice": ("InvoiceKey", ("PostedDate", "InvoiceId")),
    "fact_invoiceitem": ("InvoiceItemKey", ("PostedDate", "InvoiceId", "InvoiceItemId")),
}
STATE, GATES = "_digests", "etl_gate_results"


def _scope(settings: MartSettings) -> str:
    """What else the invoice tables depend on: with other parameters, all of them are another result."""
    s = settings
    # The kinds: a state with digests of other kinds cannot be compared.
    return repr((tuple(changes.WATCHED), sorted(s.tenant_ids), s.from_date, s.to_date, s.labor_fanout, s.multi_salesperson, s.calendar_start, s.calendar_end))


class _Load:
    """One run of ``build_warehouse``: writes tables behind their gates."""

    def __init__(self, spark: SparkSession, settings: MartSettings, src: dims.Sources, mart: Mapping[str, DataFrame], root: str, log: RunLog) -> None:
        self.spark, self.settings, self.src, self.mart, self.root, self.log = spark, settings, src, mart, root, log

    def _gates(self, table: str) -> tuple[list, Accept | None]:
        if self.settings.gates == "off":
            return [], None
        contract: Contract = contract_of(table, self.settings.unresolved_share)

        def accept(seen: Mapping[str, int], stored: DataFrame) -> None:
            findings = check_contract(contract, seen, stored)
            self.log.gates(f"{self.root}/{GATES}", log_name(table), findings)
            if self.settings.gates == "enforce" and not all(f.passed for f in findings):
                raise GateFailure(table, findings)

        return contract.observed(), accept

    def whole(self, table: str) -> int:
        """Compute and store a table, or its period, from all rows."""
        if table in dims.KEYED_DIMENSIONS:
            df = _load_dimension(self.spark, table, self.src, self.mart, self.settings, self.root)
        else:
            df = build(table, self.spark, self.src, self.mart, self.settings)
        df, path, s = with_audit(df), f"{self.root}/{table}", self.settings
        observed, accept = self._gates(table)
        if table in schemas.PERIOD_TABLES:
            return write_period(df, path, s.period_start, s.period_end, s.tenant_ids, *observed, accept=accept)
        if table in _BY_INVOICE:
            return write_months(df, path, "PostedDate", s.from_date, s.to_date, *observed, accept=accept, spread="InvoiceId", laid_out=bool(_BY_INVOICE[table][1]) and s.cluster_facts)
        return write_full(df, path, *observed, accept=accept)

    def changed(self, compared: Sequence[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame, int]:
        """The invoices and the jobs with returns that changed sources lead to, and how many of both. ``compared`` are digests
        of the load before and of now, group by group."""
        owners = reduce(DataFrame.unionByName, [cut_lineage(changes.changed_owners(before, now)) for before, now in compared])
        invoices = cut_lineage(changes.affected_invoices(self.src, self.settings, owners))
        jobs = cut_lineage(changes.affected_jobs(owners))
        return invoices, jobs, invoices.count() + jobs.count()

    def refreshed(self, table: str, invoices: DataFrame, jobs: DataFrame) -> int:
        """Recompute the rows of affected invoices (or jobs) and rewrite the months they leave or enter; returns rows recomputed."""
        src = changes.sources_of(self.src, invoices, jobs)
        before = self.mart[table]
        observed, accept = self._gates(table)
        path = f"{self.root}/{table}"
        if table == "mat_job_returns":
            new = cut_lineage(with_audit(build(table, self.spark, src, self.mart, self.settings)))
            keys = jobs.select(F.col("job_id").alias("JobId"), F.col("_tenant_id").alias("TenantId"))
            kept = before.join(keys, ["JobId", "TenantId"], "left_anti").select(*new.columns)
            write_full(kept.unionByName(new), path, *observed, accept=accept)
            return new.count()
        key, layout = _BY_INVOICE[table]
        new = with_audit(build(table, self.spark, src, changes.mart_of(self.mart, invoices), self.settings.with_(cluster_facts=False)))
        if key:
            # Keys of a fact's rows are never used twice.
            highest = before.agg(F.max(key)).first()[0] or 0
            new = new.withColumn(key, F.col(key) + highest)
        new = cut_lineage(new)
        keys = invoices.select(F.col("invoice_id").alias("InvoiceId"), F.col("_tenant_id").alias("TenantId"))
        old = before.join(keys, ["InvoiceId", "TenantId"], "left_semi")
        month = F.trunc("PostedDate", "month").alias("m")
        # At most as many as the window has months.
        months = [r["m"] for r in old.select(month).unionByName(new.select(month)).distinct().collect()]
        if not months:
            return 0
        kept = read_mart(self.spark, self.root, table, {"PostedMonth": months}).filter(F.trunc("PostedDate", "month").isin(months))
        rows = kept.join(keys, ["InvoiceId", "TenantId"], "left_anti").select(*new.columns).unionByName(new)
        if layout and self.settings.cluster_facts:
            rows = clustered(rows, list(layout))
        write_months(rows, path, "PostedDate", None, None, *observed, accept=accept, spread="InvoiceId", months=months, laid_out=bool(layout))
        return new.count()


def build_warehouse(
    spark: SparkSession, settings: MartSettings, raw_root: str, external_root: str, mart_root: str,
    tables: Sequence[str] = TABLES, incremental: bool = False,
) -> dict[str, int]:
    """Load the given tables (all by default) in dependency order; returns rows written per table.

    What a load needs from tables not in the list is read as it is in the mart. A table whose rows break its contract is not
    replaced (``settings.gates``). A failed load is logged and stops the run.

    With ``incremental``, the invoice measures, the returns and the invoice facts are recomputed only for what the sources'
    changes since the last such load affect, and only the months of those rows are written again; the numbers returned are
    the rows recomputed. Dimensions, rates and the agreement period are loaded whole, as they are small or replaced by
    period anyway. The state for this is kept beside the mart once all tables have been loaded; without it, or with
    another window, the load is a full one. A load that fails half-way is repeated from the state before it.
    """
    src = read_sources(spark, raw_root, external_root)
    mart = mart_tables(spark, mart_root)
    log = RunLog(spark, f"{mart_root}/etl_run_log")
    log.seed()
    return load_tables(spark, settings, src, mart, mart_root, log, tables, incremental)


def load_tables(
    spark: SparkSession, settings: MartSettings, src: dims.Sources, mart, mart_root: str, log: RunLog,
    tables: Sequence[str] = TABLES, incremental: bool = False,
) -> dict[str, int]:
    """``build_warehouse`` over sources that are open already."""
    src = dims.LoadSources(src)
    load = _Load(spark, settings, src, mart, mart_root, log)
    tracked = [*_BY_INVOICE, "mat_job_returns"]
    state = VersionedTable(spark, f"{mart_root}/{STATE}")
    now = affected = None
    if set(tracked) <= set(tables):
        # Taken before the tables are loaded: a change during the load is seen by the next one. Stored beside the state of the load
        # before, and published when all tables are.
        state.sweep()
        now, compared = [], []
        known = state.current()
        for kinds in changes.GROUPS:
            rows = changes.digests(src, settings, kinds)
            staged = state.stage(rows)[0]
            now += [Part(p.folder, (("group", kinds[0]),)) for p in staged]
            if known is not None:
                compared.append((state.read(changes.DIGEST, {"group": kinds[0]}), state.rows_of(staged, rows)))
        if incremental and known is not None and known.note.get("scope") == _scope(settings):
            affected = load.changed(compared)
    written: dict[str, int] = {}
    for table in (t for t in TABLES if t in tables):

        def run(name: str = table) -> int:
            if affected is None or name not in tracked:
                return load.whole(name)
            invoices, jobs, many = affected
            return load.refreshed(name, invoices, jobs) if many else 0

        written[table] = log.run(log_name(table), run)
        mart.written(table)
    if now is not None:
        state.publish(now, {"scope": _scope(settings)})
    return written


def open_mart(spark: SparkSession, mart_root: str) -> facts.Mart:
    return mart_tables(spark, mart_root)


def check_sources(src: dims.Sources, thresholds: dict[str, int] = schemas.MIN_SOURCE_ROWS) -> DataFrame:
    """Q1 over all source tables; a table that does not exist has 0 rows."""
    return min_rows(src, thresholds)


def track_metrics(
    spark: SparkSession, mart_root: str, version: str, run_date: date, description: str, settings: MartSettings,
    tolerance: float = 0.01, sql_metrics: Sequence[Mapping[str, str]] | None = None, args: Mapping[str, object] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Compute the metrics, compare with the last run before this one, and store them and the report snapshot.

    A run is named by its version and date, a snapshot by its version; repeating one replaces what it stored. Metrics given as
    SQL read the views and may name the parameters ``args``.
    """
    mart = open_mart(spark, mart_root)
    history = mart.get("mat_metric_summary")
    if history is None:
        history = empty(spark, "mat_metric_summary")
    own = (F.col("RUN_VERSION") == version) & (F.col("RUN_DATE") == F.lit(run_date))
    history = history.where((F.col("RUN_DATE") <= F.lit(run_date)) & ~own)
    views = metrics.metric_views(mart, register=bool(sql_metrics))
    if sql_metrics:
        frames, errors = {}, {}
        for definition in sql_metrics:
            try:
                frames[definition["name"]] = metrics.sql_metric(spark, definition, args)
            except Exception as error:  # noqa: BLE001 - a wrong query must not stop the other metrics
                errors[definition["name"]] = str(error)
    else:
        errors = {}
        frames = {
            name: metrics.view_metrics(views[name], [m for m in metrics.DEFAULT_METRICS if m.view == name])
            for name in views
        }
    current, failed = metrics.run_metrics(frames, spark, single=bool(sql_metrics))
    errors.update(failed)
    # The comparison is fixed before the history grows; it has one row per metric.
    compared_rows = compare_metrics(current, history, tolerance)
    compared = spark.createDataFrame(compared_rows.collect(), compared_rows.schema)
    summary = metrics.summary_rows(compared, version, run_date, description)
    replace_run(summary, f"{mart_root}/mat_metric_summary", {"RUN_VERSION": version, "RUN_DATE": run_date})
    snapshot = stamp_run(report.commission_report(mart, settings, ordered=False), version, run_date, description)
    replace_run(snapshot, f"{mart_root}/{BASELINE}", {"RUN_VERSION": version})
    return compared, errors


def track_metric_file(spark: SparkSession, mart_root: str, path: str, settings: MartSettings) -> tuple[DataFrame, dict[str, str]]:
    """The run that a metric file describes: its version, date, parameters, queries and tolerance."""
    given = metrics.load_metric_file(path, settings)
    return track_metrics(
        spark, mart_root, given.version, given.run_date, given.description, given.settings, given.tolerance, given.metrics, given.args
    )


def read_baseline(spark: SparkSession, mart_root: str, version: str, columns: Mapping[str, str] = schemas.MART[BASELINE]) -> DataFrame:
    """The report as stored for one version. The version is a text: 1.10 is not 1.1."""
    stored = VersionedTable(spark, f"{mart_root}/{BASELINE}").read(schemas.ddl(dict(columns)), {"RUN_VERSION": version})
    return stored.where(F.col("RUN_VERSION") == version)


def compare_baselines(
    spark: SparkSession, mart_root: str, before: str, after: str, keys: Sequence[str] = REPORT_KEYS,
    columns: Mapping[str, str] = schemas.MART[BASELINE],
) -> DataFrame:
    """Rows of the report that were added, removed or changed between two stored versions."""
    old, new = (read_baseline(spark, mart_root, v, columns).drop("RUN_VERSION", "RUN_DATE", "RUN_DESCRIPTION") for v in (before, after))
    return diff_rows(old, new, list(keys))
