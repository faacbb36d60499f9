"""Column names and types of every source and mart table. These are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MONEY = "decimal(20,2)"
MONEY4 = "decimal(20,4)"
RATE = "decimal(10,4)"

_BASE = {"id": "bigint", "_tenant_id": "bigint"}
_ACTIVE = {"active": "int"}


def _raw(**columns: str) -> dict[str, str]:
    return {**_BASE, **columns, **_ACTIVE}


# ---- operational source tables (S1) -------------------------------------------------------------------------------
RAW: dict[str, dict[str, str]] = {
    "businessunit": _raw(name="string"),
    "jobtype": _raw(name="string"),
    "customer": _raw(name="string"),
    "employee": _raw(name="string"),
    "location": {**_BASE, "name": "string"},
    "generalledgeraccounttype": _raw(name="string"),
    "generalledgeraccount": _raw(type_id="bigint", name="string"),
    "material": _raw(name="string"),
    "equipment": _raw(name="string"),
    "customfieldtype": _raw(name="string", ownertype="int"),
    "customfield": _raw(owner_id="bigint", type_id="bigint", value="string", createdon="timestamp_ntz"),
    "serviceagreementtemplate": _raw(name="string"),
    "serviceagreement": _raw(
        customerid="bigint", businessunitid="bigint", soldbyid="bigint", name="string", templateinstance_id="bigint",
        startdate="date", enddate="date", renewalgroupinitialagreement_id="bigint", renewedby_id="bigint", status="int",
    ),
    "serviceagreementlocation": _raw(serviceagreement_id="bigint", locationid="bigint"),
    "serviceagreementvisit": _raw(serviceagreementlocation_id="bigint", jobid="bigint"),
    "job": _raw(
        customer_id="bigint", location_id="bigint", businessunit_id="bigint", type_id="bigint", summary="string",
        service_agreement_id="bigint",
    ),
    "invoice": _raw(
        job_id="bigint", invoicedon="date", modifiedon="date", trans_number="string", status="int",
        adjustmentto_id="bigint",
    ),
    "invoiceitem": _raw(
        invoice_id="bigint", generalledgeraccount_id="bigint", description="string", quantity="int", total=MONEY4,
        totalcost=MONEY4, skureference_skutype="int", skureference_skuid="bigint",
        procurementsource_purchaseorderitemid="bigint",
    ),
    "purchaseorder": _raw(invoice_id="bigint", amount="decimal(10,2)", modifiedon="date"),
    "inventorybill": _raw(purchaseorder_id="bigint", total="decimal(10,2)"),
    "inventoryshipment": _raw(purchaseorder_id="bigint", bill_id="bigint"),
    "inventoryreturn": _raw(
        invoice_id="bigint", job_id="bigint", material_id="bigint", amount="decimal(10,2)", credit="decimal(10,2)",
        createdon="timestamp_ntz", datereturned="date",
    ),
    "technician": _raw(burdenrate="decimal(10,2)"),
    "grosspayitem": _raw(
        job_id="bigint", invoice_id="bigint", technician_id="bigint", amount="decimal(10,2)",
        paiddurationhours="decimal(10,2)", grosspayitemtype="int", burdencostamount="decimal(10,2)",
        _record_updated_ts_utc="timestamp_ntz",
    ),
    "employeegrosspayitem": _raw(
        job_id="bigint", invoice_id="bigint", employee_id="bigint", amount="decimal(10,2)",
        paiddurationhours="decimal(10,2)", grosspayitemtype="int", _record_updated_ts_utc="timestamp_ntz",
    ),
    "payrolladjustment": _raw(invoice_id="bigint", amount="decimal(10,2)", _record_updated_ts_utc="timestamp_ntz"),
    "employeepayrolladjustment": _raw(
        invoice_id="bigint", employee_id="bigint", amount="decimal(10,2)", _record_updated_ts_utc="timestamp_ntz",
    ),
}

# ---- external source tables (S2) ----------------------------------------------------------------------------------
EXTERNAL: dict[str, dict[str, str]] = {
    "report.dim_employee": {
        "employee_id": "bigint", "employee_sk": "bigint", "user_id": "bigint", "_tenant_id": "bigint",
        "employee_name": "string",
    },
    "generalledger.journalentry": _raw(postdate="date"),
    "generalledger.journalentryitem": _raw(
        journalentryid="bigint", serviceagreementid="bigint", amount="decimal(10,2)", transactiontype="int",
        entrytype="int",
    ),
}

_AUDIT = {"LoadDateTime": "timestamp", "UpdatedDateTime": "timestamp"}


def _dim(key: str, **columns: str) -> dict[str, str]:
    return {key: "bigint", **columns, "IsActive": "boolean", **_AUDIT}


_FACT_DATES = {"InvoicedOn": "date", "PostedDate": "date", "InvoiceDate": "date"}

# Report columns in order, with their types. The union's two sides must agree on them.
REPORT_COLUMNS: dict[str, str] = {
    "JobId": "bigint", "TransactionNumber": "string", "BusinessUnit": "string", "JobType": "string",
    "JobSummary": "string", "JobCustomer": "string", "JobCustomerId": "bigint", "JobLocation": "string",
    "JobLocationId": "bigint", "JobRevenue": "decimal(20,2)", "JobCost": "decimal(20,2)", "JobMargin": "decimal(20,2)",
    "JobCommission": "decimal(10,2)", "InvoiceId": "string", "InvoiceNumber": "string", "ServiceAgreementId": "bigint",
    "ServiceAgreementTemplateType": "string", "ServiceAgreementStartDate": "date",
    "ServiceAgreementCustomer": "string", "ServiceAgreementCustomerId": "bigint", "ServiceAgreementLocation": "string",
    "ServiceAgreementLocationId": "bigint", "CostFromJobs": "decimal(20,2)",
    "ServiceAgreementRevenue": "decimal(20,2)", "ServiceAgreementRenewalYear": "int",
    "ServiceAgreementCommission": "decimal(10,2)", "ServiceAgreementMargin": "decimal(20,2)", "LinkPath": "string",
    "EmployeeName": "string", "EmployeeType": "string", "EmployeeId": "bigint",
    "CommissionTypeEmployee": "decimal(10,2)", "JobCommission%Employee": "decimal(10,4)",
    "SAYear1Commission%Employee": "decimal(10,4)", "SAYear2Commission%Employee": "decimal(10,4)",
    "SAYear3+Commission%Employee": "decimal(10,4)",
}

# ---- mart tables --------------------------------------------------------------------------------------------------
MART: dict[str, dict[str, str]] = {
    "dim_date": {
        "DateKey": "int", "Date": "date", "DayOfWeek": "int", "DayName": "string", "DayOfMonth": "int",
        "DayOfYear": "int", "WeekOfYear": "int", "WeekBeginDate": "date", "WeekEndDate": "date", "MonthNumber": "int",
        "MonthName": "string", "MonthBeginDate": "date", "MonthEndDate": "date", "MonthYear": "string",
        "Quarter": "int", "QuarterName": "string", "QuarterBeginDate": "date", "QuarterEndDate": "date", "Year": "int",
        "FiscalYear": "int", "FiscalQuarter": "int", "FiscalMonth": "int", "IsWeekday": "boolean",
        "IsWeekend": "boolean", "IsHoliday": "boolean", "HolidayName": "string", "IsCurrentDay": "boolean",
        "IsCurrentWeek": "boolean", "IsCurrentMonth": "boolean", "IsCurrentQuarter": "boolean",
        "IsCurrentYear": "boolean", **_AUDIT,
    },
    "dim_tenant": {
        "TenantId": "bigint", "TenantName": "string", "TenantOfficialName": "string", "IsActive": "boolean", **_AUDIT,
    },
    "dim_businessunit": _dim("BusinessUnitKey", BusinessUnitId="bigint", TenantId="bigint", BusinessUnitName="string"),
    "dim_customer": _dim("CustomerKey", CustomerId="bigint", TenantId="bigint", CustomerName="string"),
    "dim_employee": _dim(
        "EmployeeKey", EmployeeId="bigint", TenantId="bigint", EmployeeName="string", EmployeeType="string"
    ),
    "dim_glaccount": _dim(
        "GLAccountKey", GLAccountId="bigint", TenantId="bigint", GLAccountType="string", GLAccountTypeId="bigint"
    ),
    "dim_job": _dim("JobKey", JobId="bigint", TenantId="bigint", JobSummary="string", ServiceAgreementId="bigint"),
    "dim_jobtype": _dim("JobTypeKey", JobTypeId="bigint", TenantId="bigint", JobTypeName="string"),
    "dim_location": _dim("LocationKey", LocationId="bigint", TenantId="bigint", LocationName="string"),
    "dim_serviceagreement": _dim(
        "ServiceAgreementKey", ServiceAgreementId="bigint", TenantId="bigint", ServiceAgreementName="string",
        CustomerId="bigint", LocationId="bigint", BusinessUnitId="bigint", SoldById="bigint", TemplateId="bigint",
        TemplateName="string", TemplateType="string", StartDate="date", EndDate="date", RenewalYear="int",
        RenewalGroupInitialAgreementId="bigint", RenewedById="bigint", Status="int", StatusName="string",
    ),
    "dim_sku": _dim("SKUKey", SKUId="bigint", SKUType="int", TenantId="bigint"),
    "mat_employee_commissionrates": {
        "EmployeeId": "bigint", "TenantId": "bigint", "EmployeeName": "string", "EmployeeType": "string",
        "CommissionType": "int", "JobCommissionPct": RATE, "SAYear1CommissionPct": RATE, "SAYear2CommissionPct": RATE,
        "SAYear3PlusCommissionPct": RATE, **_AUDIT,
    },
    "mat_invoice_revenue": {
        "InvoiceId": "bigint", "TenantId": "bigint", "JobId": "bigint", "InvoicedOn": "date", "InvoiceDate": "date",
        "PostedDate": "date", "InvoiceModifiedOn": "timestamp_ntz", "TransactionNumber": "string",
        "InvoiceStatus": "int", "TotalRevenue": MONEY, "IncomeRevenue": MONEY, "LineItemCount": "bigint", **_AUDIT,
    },
    "mat_invoice_materialcosts": {
        "InvoiceId": "bigint", "TenantId": "bigint", "JobId": "bigint", "PostedDate": "date",
        "InvoiceModifiedOn": "timestamp_ntz", "EquipmentCost": MONEY, "MaterialCost": MONEY, "TotalItemCost": MONEY,
        **_AUDIT,
    },
    "mat_invoice_pocosts": {
        "InvoiceId": "bigint", "TenantId": "bigint", "JobId": "bigint", "PostedDate": "date",
        "InvoiceModifiedOn": "timestamp_ntz", "LastPOModifiedOn": "timestamp_ntz", "POUnbilledCost": MONEY,
        "POBilledCost": MONEY, "TotalPOCost": MONEY, "POCount": "bigint", **_AUDIT,
    },
    "mat_invoice_laborcosts": {
        "InvoiceId": "bigint", "TenantId": "bigint", "JobId": "bigint", "PostedDate": "date",
        "InvoiceModifiedOn": "timestamp_ntz", "LastLaborModifiedOn": "timestamp_ntz", "RegularLaborCost": MONEY,
        "PieceworkCost": MONEY, "LaborBurdenCost": MONEY, "PayrollAdjustmentCost": MONEY, "TotalLaborCost": MONEY,
        "RegularLaborHours": MONEY, "PieceworkHours": MONEY, **_AUDIT,
    },
    "mat_job_returns": {
        "JobId": "bigint", "TenantId": "bigint", "LastReturnDate": "date", "TotalReturnCredit": MONEY,
        "ReturnCount": "bigint", **_AUDIT,
    },
    "mat_sa_period_measures": {
        "ServiceAgreementId": "bigint", "RevenueRecognitionAmount": MONEY, "LaborCost": MONEY, "BurdenCost": MONEY,
        "MaterialCost": MONEY, "EquipmentCost": MONEY, **_AUDIT, "PeriodStartDate": "date", "PeriodEndDate": "date",
        "TenantId": "bigint",
    },
    "fact_invoice": {
        "InvoiceKey": "bigint", "InvoiceId": "bigint", "JobId": "bigint", "TenantId": "bigint", "DateKey": "int",
        "CustomerKey": "bigint", "LocationKey": "bigint", "BusinessUnitKey": "bigint", "JobTypeKey": "bigint",
        "EmployeeKey": "bigint", "JobKey": "bigint", **_FACT_DATES, "TransactionNumber": "string",
        "InvoiceStatus": "int", "IsAdjustment": "boolean", "AdjustmentToInvoiceId": "bigint", "TotalRevenue": MONEY,
        "IncomeRevenue": MONEY, "LineItemCount": "bigint", "EquipmentCost": MONEY, "MaterialCost": MONEY,
        "TotalItemCost": MONEY, "POUnbilledCost": MONEY, "POBilledCost": MONEY, "TotalPOCost": MONEY,
        "POCount": "bigint", "RegularLaborCost": MONEY, "PieceworkCost": MONEY, "LaborBurdenCost": MONEY,
        "PayrollAdjustmentCost": MONEY, "TotalLaborCost": MONEY, "RegularLaborHours": MONEY, "PieceworkHours": MONEY,
        **_AUDIT,
    },
    "fact_invoiceitem": {
        "InvoiceItemKey": "bigint", "InvoiceItemId": "bigint", "InvoiceId": "bigint", "JobId": "bigint",
        "TenantId": "bigint", "DateKey": "int", "CustomerKey": "bigint", "LocationKey": "bigint",
        "BusinessUnitKey": "bigint", "JobTypeKey": "bigint", "JobKey": "bigint", "SKUKey": "bigint",
        "GLAccountKey": "bigint", **_FACT_DATES, "ItemDescription": "string", "ItemSequence": "int", "SKUType": "int",
        "ItemRevenue": MONEY, "ItemQuantity": MONEY4, "ItemUnitPrice": MONEY4, "ItemCost": MONEY, "IsIncome": "boolean",
        "IsPOItem": "boolean", "POItemId": "bigint", **_AUDIT,
    },
    "fact_serviceagreement": {
        "ServiceAgreementKey": "bigint", "ServiceAgreementId": "bigint", "DateKey": "int", "CustomerKey": "bigint",
        "LocationKey": "bigint", "BusinessUnitKey": "bigint", "EmployeeKey": "bigint",
        "ServiceAgreementDimKey": "bigint", "SAName": "string", "SATemplateType": "string", "SAStartDate": "date",
        "SAEndDate": "date", "SARenewalYear": "int", "SAStatus": "int", "RevenueRecognitionAmount": MONEY,
        "LaborCost": MONEY, "BurdenCost": MONEY, "MaterialCost": MONEY, "EquipmentCost": MONEY,
        "SoldByEmployeeId": "bigint", "JobCommissionPct": "decimal(10,2)", "SAYear1CommissionPct": "decimal(10,2)",
        "SAYear2CommissionPct": "decimal(10,2)", "SAYear3PlusCommissionPct": "decimal(10,2)", **_AUDIT,
        "PeriodStartDate": "date", "PeriodEndDate": "date", "TenantId": "bigint",
    },
    "etl_run_log": {
        "ProcessName": "string", "RunId": "string", "EventTime": "timestamp", "Status": "string",
        "RowsProcessed": "bigint", "ErrorMessage": "string",
    },
    "mat_metric_summary": {
        "RUN_VERSION": "string", "RUN_DATE": "date", "RUN_DESCRIPTION": "string", "METRIC_NAME": "string",
        "METRIC_CATEGORY": "string", "METRIC_VALUE": MONEY, "METRIC_COUNT": "bigint", "PREVIOUS_RUN_VERSION": "string",
        "PREVIOUS_METRIC_VALUE": MONEY, "VALUE_DIFFERENCE": MONEY, "VALUE_DIFFERENCE_PCT": RATE,
        "LOADDATETIME": "timestamp",
    },
    "mat_report_baseline": {
        "RUN_VERSION": "string", "RUN_DATE": "date", "RUN_DESCRIPTION": "string", "_TenantId": "bigint",
        "_TenantName": "string", "_TenantOfficialName": "string", **REPORT_COLUMNS,
    },
    "etl_gate_results": {
        "ProcessName": "string", "CheckedAt": "timestamp", "Gate": "string", "ColumnName": "string", "RowsSeen": "bigint",
        "Findings": "bigint", "Limit": "bigint", "Passed": "boolean",
    },
}

# Folder columns of the tables that are replaced period by period.
PERIOD_COLUMNS = ("PeriodStartDate", "PeriodEndDate", "TenantId")
PERIOD_TABLES = ("mat_sa_period_measures", "fact_serviceagreement")

# Keys the model declares unique; checked by the unique-key gate.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("Date",),
    "dim_tenant": ("TenantId",),
    "dim_businessunit": ("BusinessUnitId", "TenantId"),
    "dim_customer": ("CustomerId", "TenantId"),
    "dim_employee": ("EmployeeId", "TenantId"),
    "dim_glaccount": ("GLAccountId", "TenantId"),
    "dim_job": ("JobId", "TenantId"),
    "dim_jobtype": ("JobTypeId", "TenantId"),
    "dim_location": ("LocationId", "TenantId"),
    "dim_serviceagreement": ("ServiceAgreementId", "TenantId"),
    "dim_sku": ("SKUId", "SKUType", "TenantId"),
    "mat_employee_commissionrates": ("EmployeeId", "TenantId"),
    "mat_invoice_revenue": ("InvoiceId", "TenantId"),
    "mat_invoice_materialcosts": ("InvoiceId", "TenantId"),
    "mat_invoice_pocosts": ("InvoiceId", "TenantId"),
    "mat_invoice_laborcosts": ("InvoiceId", "TenantId"),
    "mat_job_returns": ("JobId", "TenantId"),
    "mat_sa_period_measures": ("ServiceAgreementId", *PERIOD_COLUMNS),
    "fact_invoice": ("InvoiceId", "TenantId"),
    "fact_invoiceitem": ("InvoiceItemId", "TenantId"),
    "fact_serviceagreement": ("ServiceAgreementId", *PERIOD_COLUMNS),
}

# Columns the model declares NOT NULL besides the keys above.
REQUIRED: dict[str, tuple[str, ...]] = {
    "fact_invoice": ("InvoiceId", "JobId", "TenantId"),
    "fact_invoiceitem": ("InvoiceItemId", "InvoiceId", "TenantId"),
    "fact_serviceagreement": ("ServiceAgreementId", *PERIOD_COLUMNS),
}

# Dimension keys of each fact: NULL where the lookup found no member.
DIMENSION_KEYS: dict[str, tuple[str, ...]] = {
    "fact_invoice": (
        "DateKey", "CustomerKey", "LocationKey", "BusinessUnitKey", "JobTypeKey", "EmployeeKey", "JobKey",
    ),
    "fact_invoiceitem": (
        "DateKey", "CustomerKey", "LocationKey", "BusinessUnitKey", "JobTypeKey", "JobKey", "SKUKey", "GLAccountKey",
    ),
    "fact_serviceagreement": (
        "DateKey", "CustomerKey", "LocationKey", "BusinessUnitKey", "EmployeeKey", "ServiceAgreementDimKey",
    ),
}

# Least row counts expected of a full source load.
MIN_SOURCE_ROWS: dict[str, int] = {
    "businessunit": 10, "jobtype": 20, "customer": 500, "employee": 50, "location": 300,
    "generalledgeraccounttype": 5, "generalledgeraccount": 100, "material": 500, "equipment": 500,
    "customfieldtype": 6, "serviceagreementtemplate": 5, "serviceagreement": 200, "serviceagreementlocation": 300,
    "job": 5000, "customfield": 4000, "invoice": 8000, "invoiceitem": 25000, "purchaseorder": 4000,
    "inventorybill": 2000, "inventoryshipment": 1500, "inventoryreturn": 800, "technician": 50, "grosspayitem": 9000,
    "employeegrosspayitem": 2000, "payrolladjustment": 800, "employeepayrolladjustment": 400,
    "serviceagreementvisit": 750, "report.dim_employee": 50, "generalledger.journalentry": 1000,
    "generalledger.journalentryitem": 1000,
}


def ddl(columns: dict[str, str]) -> str:
    """Schema text for ``spark.read.schema`` / ``createDataFrame``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """K8: order and cast to the declared columns; a declared column the frame lacks becomes a typed NULL."""
    have = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{name}`") if name.lower() in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )
