"""Measure tables P12-P18.

Every one-to-many side is summed per invoice or job before it is joined. The sums combine on the map side, so an invoice
or job that holds a large share of all lines reaches the shuffle as one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.money import is_income, or_zero, sum_where
from martloom.functions.text import field_label, try_decimal
from martloom.operators.distinct import sums_with_distinct
from martloom.operators.eav import eav_pivot
from martloom.operators.latest import latest_per_key
from martloom.operators.reduce import only_with
from martloom.operators.star import Lookup, star_lookup
from martloom.plans.dims import Sources, account_lookups, active, of_tenants, once
from martloom.session import cut_lineage
from martloom.settings import MartSettings

POSTED = 2
MATERIAL, EQUIPMENT = 1, 2
EMPLOYEE_OWNER_BIT = 32
# Custom field label -> rate column.
RATE_FIELDS = {
    "CommissionTypeEmployee": "CommissionType",
    "JobCommission%Employee": "JobCommissionPct",
    "SAYear1Commission%Employee": "SAYear1CommissionPct",
    "SAYear2Commission%Employee": "SAYear2CommissionPct",
    "SAYear3+Commission%Employee": "SAYear3PlusCommissionPct",
}
INVOICE_KEY = ["invoice_id", "_tenant_id"]
JOB_KEY = ["job_id", "_tenant_id"]


def _conform(df: DataFrame, table: str) -> DataFrame:
    return schemas.conform(df, schemas.MART[table])


def posted_invoices(src: Sources, settings: MartSettings) -> DataFrame:
    """Active posted invoices of the tenants whose date lies in the window, with the columns measures carry."""
    day = F.col("invoicedon").cast("date")
    return (
        of_tenants(src["invoice"], settings)
        .filter(active() & (F.col("status") == POSTED) & day.between(settings.from_date, settings.to_date))
        .select(
            F.col("id").alias("InvoiceId"),
            F.col("_tenant_id").alias("TenantId"),
            F.col("job_id").alias("JobId"),
            day.alias("PostedDate"),
            F.col("modifiedon").alias("InvoiceModifiedOn"),
            F.col("trans_number").alias("TransactionNumber"),
            F.col("status").alias("InvoiceStatus"),
        )
    )


def _named(grouped: DataFrame) -> DataFrame:
    return grouped.withColumnsRenamed({"invoice_id": "InvoiceId", "_tenant_id": "TenantId"})


def _per_invoice(df: DataFrame, *sums: Column) -> DataFrame:
    return _named(df.groupBy(*INVOICE_KEY).agg(*sums))


def _per_invoice_counted(df: DataFrame, ids: DataFrame, settings: MartSettings, name: str, *sums: Column) -> DataFrame:
    """Sums and the number of distinct ids; a plain count where the ids are known to be unique."""
    if settings.line_ids_unique:
        return _per_invoice(df, *sums, F.count("id").alias(name))
    return _named(sums_with_distinct(df, INVOICE_KEY, "id", name, *sums, ids=ids))


# ---- P12 ----------------------------------------------------------------------------------------------------------
def latest_employee_fields(src: Sources, settings: MartSettings) -> DataFrame:
    """The newest value of each (employee, field type): active employee fields of active employees."""
    types = (
        src["customfieldtype"]
        .filter(active() & (F.col("ownertype").bitwiseAND(EMPLOYEE_OWNER_BIT) == EMPLOYEE_OWNER_BIT))
        .select(F.col("id").alias("type_id"), "_tenant_id", field_label(F.col("name")).alias("label"))
    )
    people = of_tenants(src["employee"], settings).filter(active()).select(F.col("id").alias("owner_id"), "_tenant_id")
    fields = (
        of_tenants(src["customfield"], settings).filter(active())
        .select("owner_id", "_tenant_id", "type_id", "value", "createdon", "id")
        .join(types, ["type_id", "_tenant_id"])
        .join(people, ["owner_id", "_tenant_id"], "left_semi")
    )
    return latest_per_key(fields, ["owner_id", "_tenant_id", "type_id"], ["createdon", "id"])


def employee_commission_rates(src: Sources, settings: MartSettings) -> DataFrame:
    """One row per active employee that has at least one rate field; missing or unreadable rates are 0."""
    rates = eav_pivot(
        latest_employee_fields(src, settings), ["owner_id", "_tenant_id"], "label",
        try_decimal(F.col("value")), RATE_FIELDS,
    )
    people = of_tenants(src["employee"], settings).filter(active()).select(
        F.col("id").alias("owner_id"), "_tenant_id", F.col("name").alias("EmployeeName")
    )
    joined = people.join(rates, ["owner_id", "_tenant_id"])
    return _conform(
        joined.select(
            F.col("owner_id").alias("EmployeeId"),
            F.col("_tenant_id").alias("TenantId"),
            "EmployeeName",
            F.lit("Employee").alias("EmployeeType"),
            F.round(or_zero(F.col("CommissionType"))).alias("CommissionType"),
            *[or_zero(F.col(c)).alias(c) for c in RATE_FIELDS.values() if c != "CommissionType"],
        ),
        "mat_employee_commissionrates",
    )


# ---- P13 ----------------------------------------------------------------------------------------------------------
def invoice_revenue(src: Sources, settings: MartSettings) -> DataFrame:
    """Total and income revenue and line count; an invoice without lines gets zeros."""
    items = of_tenants(src["invoiceitem"], settings).filter(active())
    lines = star_lookup(
        items.select("id", *INVOICE_KEY, "total", "generalledgeraccount_id"), account_lookups(src, "generalledgeraccount_id")
    )
    sums = _per_invoice_counted(
        lines, items, settings, "LineItemCount",
        F.sum("total").alias("TotalRevenue"),
        sum_where(is_income(F.col("type_name")), F.col("total")).alias("IncomeRevenue"),
    )
    rows = posted_invoices(src, settings).join(sums, ["InvoiceId", "TenantId"], "left")
    return _conform(
        rows.withColumns(
            {
                "InvoicedOn": F.col("PostedDate"),
                "InvoiceDate": F.col("PostedDate"),
                **{c: or_zero(F.col(c)) for c in ("TotalRevenue", "IncomeRevenue", "LineItemCount")},
            }
        ),
        "mat_invoice_revenue",
    )


# ---- P14 ----------------------------------------------------------------------------------------------------------
def invoice_material_costs(src: Sources, settings: MartSettings) -> DataFrame:
    """Cost of lines that did not come from a purchase order and whose SKU exists as material or equipment."""

    def stock(name: str, kind: int) -> DataFrame:
        return of_tenants(src[name], settings).select(
            F.col("id").alias("skureference_skuid"), "_tenant_id", F.lit(kind).alias("kind")
        )

    skus = stock("material", MATERIAL).unionByName(stock("equipment", EQUIPMENT))
    lines = (
        of_tenants(src["invoiceitem"], settings)
        .filter(active() & F.col("procurementsource_purchaseorderitemid").isNull())
        .select(*INVOICE_KEY, "totalcost", "skureference_skuid", F.col("skureference_skutype").alias("kind"))
        .join(skus, ["skureference_skuid", "kind", "_tenant_id"], "left_semi")
    )
    cost, kind = F.col("totalcost"), F.col("kind")
    sums = _per_invoice(
        lines,
        or_zero(sum_where(kind == EQUIPMENT, cost)).alias("EquipmentCost"),
        or_zero(sum_where(kind == MATERIAL, cost)).alias("MaterialCost"),
        or_zero(F.sum(cost)).alias("TotalItemCost"),
    )
    return _conform(
        posted_invoices(src, settings).join(sums, ["InvoiceId", "TenantId"]), "mat_invoice_materialcosts"
    )


# ---- P15 ----------------------------------------------------------------------------------------------------------
def unbilled_orders(src: Sources, settings: MartSettings) -> DataFrame:
    """Active purchase orders without an active shipment that names a bill."""
    shipped = (
        src["inventoryshipment"].filter(active() & F.col("bill_id").isNotNull())
        .select(F.col("purchaseorder_id").alias("id"), "_tenant_id")
    )
    return of_tenants(src["purchaseorder"], settings).filter(active()).join(shipped, ["id", "_tenant_id"], "left_anti")


def invoice_po_costs(src: Sources, settings: MartSettings) -> DataFrame:
    """Amounts of unbilled orders and totals of bills; an order can count in both (bill without billed shipment).

    Shipments and bills are reduced to one row per order, so one pass over the orders gives all four measures.
    """
    key = ["id", "_tenant_id"]

    def per_order(name: str, column: Column, *keep: Column) -> DataFrame:
        rows = of_tenants(src[name], settings).filter(active())
        for condition in keep:
            rows = rows.filter(condition)
        return rows.groupBy(F.col("purchaseorder_id").alias("id"), "_tenant_id").agg(column)

    bills = per_order("inventorybill", F.sum("total").alias("billed"))
    shipped = per_order("inventoryshipment", F.lit(True).alias("shipped"), F.col("bill_id").isNotNull())
    placed = of_tenants(src["purchaseorder"], settings).filter(active())
    orders = (
        placed.select(*key, "invoice_id", "amount", "modifiedon")
        .join(shipped, key, "left")
        .join(bills, key, "left")
    )
    sums = _per_invoice_counted(
        orders, placed, settings, "POCount",
        F.max("modifiedon").alias("LastPOModifiedOn"),
        or_zero(F.sum(F.when(F.col("shipped").isNull(), F.col("amount")))).alias("POUnbilledCost"),
        or_zero(F.sum("billed")).alias("POBilledCost"),
    ).withColumn("TotalPOCost", F.col("POUnbilledCost") + F.col("POBilledCost"))
    return _conform(posted_invoices(src, settings).join(sums, ["InvoiceId", "TenantId"]), "mat_invoice_pocosts")


# ---- P16 ----------------------------------------------------------------------------------------------------------
def pay_lines(src: Sources, settings: MartSettings) -> DataFrame:
    """Pay of technicians and of employees; the latter carries no burden of its own."""
    employees = (
        src["employeegrosspayitem"].withColumnRenamed("employee_id", "technician_id")
        .withColumn("burdencostamount", F.lit(0).cast("decimal(10,2)"))
    )
    return of_tenants(src["grosspayitem"].unionByName(employees, allowMissingColumns=True), settings).filter(active())


def pay_adjustments(src: Sources, settings: MartSettings) -> DataFrame:
    """U2."""
    columns = [*INVOICE_KEY, "amount", "_record_updated_ts_utc", "active"]
    both = src["payrolladjustment"].select(*columns).unionByName(src["employeepayrolladjustment"].select(*columns))
    return of_tenants(both, settings).filter(active())


def invoice_labor_costs(src: Sources, settings: MartSettings) -> DataFrame:
    """Regular pay, piecework, burden, adjustments and hours of invoices that have any of them.

    Pay and adjustments are summed per invoice on their own. With ``labor_fanout='reference'`` the sums are what joining
    every pay line with every adjustment would give; that equals each sum times the row count of the other side, so the
    pairs are never produced.
    """
    kind, hours, amount = F.col("grosspayitemtype"), F.col("paiddurationhours"), F.col("amount")
    regular, piecework = kind.isin(2, 4), kind.isin(1, 3)
    burden = (
        F.when(F.col("burdencostamount") > 0, F.col("burdencostamount"))
        .when(F.col("burdenrate").isNotNull(), F.col("burdenrate") * hours)
        .otherwise(F.lit(0))
    )
    changed = F.col("_record_updated_ts_utc")
    pay = _per_invoice(
        star_lookup(
            pay_lines(src, settings).filter("invoice_id IS NOT NULL"),
            [
                Lookup(
                    src["technician"], {"technician_id": "id", "_tenant_id": "_tenant_id"}, {"burdenrate": "burdenrate"}
                )
            ],
        ),
        sum_where(regular, amount).alias("RegularLaborCost"),
        sum_where(piecework, amount).alias("PieceworkCost"),
        F.sum(burden).alias("LaborBurdenCost"),
        F.sum(amount).alias("_pay"),
        sum_where(regular, hours).alias("RegularLaborHours"),
        sum_where(piecework, hours).alias("PieceworkHours"),
        F.max(changed).alias("_pay_changed"),
        F.count(F.lit(1)).alias("_pay_rows"),
        (F.count(changed) < F.count(F.lit(1))).alias("_pay_undated"),
    )
    adjustments = _per_invoice(
        pay_adjustments(src, settings).filter("invoice_id IS NOT NULL"),
        F.sum("amount").alias("PayrollAdjustmentCost"),
        F.max(changed).alias("_adj_changed"),
        F.count(F.lit(1)).alias("_adj_rows"),
    )
    rows = (
        posted_invoices(src, settings)
        .join(pay, ["InvoiceId", "TenantId"], "left")
        .join(adjustments, ["InvoiceId", "TenantId"], "left")
        .filter(F.col("_pay_rows").isNotNull() | F.col("_adj_rows").isNotNull())
    )
    of_pay = ["RegularLaborCost", "PieceworkCost", "LaborBurdenCost", "_pay", "RegularLaborHours", "PieceworkHours"]
    repeat_pay = repeat_adj = F.lit(1)
    if settings.labor_fanout == "reference":
        repeat_pay, repeat_adj = F.coalesce("_adj_rows", F.lit(1)), F.coalesce("_pay_rows", F.lit(1))
    rows = rows.withColumns(
        {
            **{c: or_zero(F.col(c)) * repeat_pay for c in of_pay},
            "PayrollAdjustmentCost": or_zero(F.col("PayrollAdjustmentCost")) * repeat_adj,
            # A pay line's own time counts; only a line without one falls back to the adjustments' time.
            "LastLaborModifiedOn": F.greatest(
                "_pay_changed",
                F.when(F.coalesce("_pay_undated", F.lit(True)), F.col("_adj_changed")),
            ),
        }
    )
    total = F.col("_pay") + F.col("PayrollAdjustmentCost") + F.col("LaborBurdenCost")
    return _conform(rows.withColumn("TotalLaborCost", total), "mat_invoice_laborcosts")


# ---- P17 ----------------------------------------------------------------------------------------------------------
def job_returns(src: Sources, settings: MartSettings) -> DataFrame:
    """Credit (negative) and number of returns per job; an inverted window gives no rows."""
    day = F.col("datereturned").cast("date")
    returns = of_tenants(src["inventoryreturn"], settings).filter(
        active() & F.col("job_id").isNotNull() & day.between(settings.from_date, settings.to_date)
    )
    sums = returns.groupBy(F.col("job_id").alias("JobId"), F.col("_tenant_id").alias("TenantId")).agg(
        F.max(F.col("createdon").cast("date")).alias("LastReturnDate"),
        (-F.sum("amount")).alias("TotalReturnCredit"),
        F.count(F.lit(1)).alias("ReturnCount"),
    )
    return _conform(sums, "mat_job_returns")


# ---- P18 ----------------------------------------------------------------------------------------------------------
def agreement_revenue(src: Sources, settings: MartSettings) -> DataFrame:
    """Recognised revenue per agreement: journal items of type 11 / entry 1 posted in [start, end)."""
    items = of_tenants(src["generalledger.journalentryitem"], settings).filter(
        (F.col("transactiontype") == 11) & (F.col("entrytype") == 1)
    ).select("journalentryid", "serviceagreementid", "_tenant_id", "amount")
    posted = F.col("postdate").cast("date")
    entries = (
        src["generalledger.journalentry"]
        .filter((posted >= F.lit(settings.period_start)) & (posted < F.lit(settings.period_end)))
        .select(F.col("id").alias("journalentryid"), "_tenant_id")
    )
    return (
        items.join(entries, ["journalentryid", "_tenant_id"])
        .groupBy(F.col("serviceagreementid").alias("id"), "_tenant_id")
        .agg(F.sum("amount").alias("RevenueRecognitionAmount"))
    )


def visit_jobs(src: Sources, settings: MartSettings) -> DataFrame:
    """(agreement, job) for every active visit; a job visited twice for an agreement is listed twice."""
    place = ["serviceagreementlocation_id", "_tenant_id"]
    places = src["serviceagreementlocation"].filter(active()).select(
        F.col("id").alias("serviceagreementlocation_id"), "_tenant_id", F.col("serviceagreement_id").alias("id")
    )
    visits = cut_lineage(
        of_tenants(src["serviceagreementvisit"], settings).filter(active()).select(*place, F.col("jobid").alias("job_id"))
    )
    jobs = src["job"].filter(active()).select(F.col("id").alias("job_id"), "_tenant_id")
    return visits.join(only_with(places, visits, place), place).join(jobs, JOB_KEY)


def agreement_costs(src: Sources, settings: MartSettings) -> DataFrame:
    """Labor, burden, material and equipment cost of an agreement's visit jobs; the same for every period unless filtered by it."""
    if settings.filter_costs_by_period:
        return _agreement_costs(src, settings)
    return once(src, ("agreement costs", settings.tenant_ids), lambda: _agreement_costs(src, settings))


def _agreement_costs(src: Sources, settings: MartSettings) -> DataFrame:
    """``agreement_costs`` from the sources.

    Pay and lines are summed per job first and then attached to the visits: one row per job and side, so neither
    multiplies the other, and a job with very many lines stays one row. Where visit jobs are few, only their pay and lines are
    summed.
    """
    visits = cut_lineage(visit_jobs(src, settings))
    in_period = F.col("invoicedon").cast("date").between(settings.period_start, settings.period_end)
    invoices = of_tenants(src["invoice"], settings).filter(active())
    pay = pay_lines(src, settings).filter("job_id IS NOT NULL")
    if settings.filter_costs_by_period:
        invoices = invoices.filter(in_period)
        pay = pay.join(invoices.select(F.col("id").alias("invoice_id"), "_tenant_id"), INVOICE_KEY, "left_semi")
    invoices = only_with(invoices, visits, JOB_KEY)
    pay_of_job = only_with(pay, visits, JOB_KEY).groupBy(*JOB_KEY).agg(
        F.sum("amount").alias("LaborCost"), F.sum(or_zero(F.col("burdencostamount"))).alias("BurdenCost")
    )
    kind, cost = F.col("skureference_skutype"), F.col("totalcost")
    lines = only_with(of_tenants(src["invoiceitem"], settings).filter(active()), invoices.withColumnRenamed("id", "invoice_id"), INVOICE_KEY)
    cost_of_invoice = (
        lines.groupBy(*INVOICE_KEY)
        .agg(sum_where(kind == MATERIAL, cost).alias("m"), sum_where(kind == EQUIPMENT, cost).alias("e"))
    )
    cost_of_job = (
        invoices.select(F.col("id").alias("invoice_id"), *JOB_KEY)
        .join(cost_of_invoice, INVOICE_KEY)
        .groupBy(*JOB_KEY)
        .agg(F.sum("m").alias("MaterialCost"), F.sum("e").alias("EquipmentCost"))
    )
    return (
        visits
        .join(pay_of_job, JOB_KEY, "left")
        .join(cost_of_job, JOB_KEY, "left")
        .groupBy("id", "_tenant_id")
        .agg(*[F.sum(c).alias(c) for c in ("LaborCost", "BurdenCost", "MaterialCost", "EquipmentCost")])
    )


def sa_period_measures(src: Sources, settings: MartSettings) -> DataFrame:
    """Active agreements that have revenue in the period or any visit cost."""
    key = ["id", "_tenant_id"]
    rows = (
        of_tenants(src["serviceagreement"], settings).filter(active()).select(*key)
        .join(agreement_revenue(src, settings), key, "left")
        .join(agreement_costs(src, settings), key, "left")
        .filter(
            F.col("RevenueRecognitionAmount").isNotNull()
            | F.col("LaborCost").isNotNull()
            | F.col("MaterialCost").isNotNull()
        )
    )
    measures = ("RevenueRecognitionAmount", "LaborCost", "BurdenCost", "MaterialCost", "EquipmentCost")
    return _conform(
        rows.withColumnsRenamed({"id": "ServiceAgreementId", "_tenant_id": "TenantId"}).withColumns(
            {
                **{c: or_zero(F.col(c)) for c in measures},
                "PeriodStartDate": F.lit(settings.period_start),
                "PeriodEndDate": F.lit(settings.period_end),
            }
        ),
        "mat_sa_period_measures",
    )
