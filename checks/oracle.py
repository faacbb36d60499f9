"""Expected results as DuckDB SQL over the shared test tables.

``RAW`` are the bound source tables (``r_*``), ``MART`` the mart tables (``m_*``); ``compose`` puts the ones a query
mentions in front of it as common table expressions.
"""

from __future__ import annotations

import re

from checks import binding
from checks.marts import PERIODS, REPORT, SETTINGS
from martloom import schemas


def _cte_name(source: str) -> str:
    return "r_" + source.split(".")[-1].replace("dim_employee", "ext_employee")


RAW = {_cte_name(name): text for name, text in binding.SOURCES.items()}

_WINDOW = f"BETWEEN DATE '{SETTINGS.from_date}' AND DATE '{SETTINGS.to_date}'"
_RWINDOW = f"BETWEEN DATE '{REPORT.from_date}' AND DATE '{REPORT.to_date}'"


def dim(key: str, natural: str, columns: str, source: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {natural}) AS {key}, {columns} FROM {source}"


def calendar(first: str, last: str) -> str:
    return f"SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"


def period_measures(start, end) -> str:
    return f"""
    SELECT sa.id AS ServiceAgreementId, sa._tenant_id AS TenantId, DATE '{start}' AS PeriodStartDate,
           DATE '{end}' AS PeriodEndDate,
           CAST(coalesce(g.revenue, 0) AS DECIMAL(20,2)) AS RevenueRecognitionAmount,
           CAST(coalesce(l.pay, 0) AS DECIMAL(20,2)) AS LaborCost,
           CAST(coalesce(l.burden, 0) AS DECIMAL(20,2)) AS BurdenCost,
           CAST(coalesce(c.material, 0) AS DECIMAL(20,2)) AS MaterialCost,
           CAST(coalesce(c.equipment, 0) AS DECIMAL(20,2)) AS EquipmentCost
    FROM r_serviceagreement sa
    LEFT JOIN (SELECT x.serviceagreementid AS id, sum(x.amount) AS revenue
               FROM r_journalentryitem x JOIN r_journalentry y ON y.id = x.journalentryid
               WHERE x.transactiontype = 11 AND x.entrytype = 1
                 AND y.postdate >= DATE '{start}' AND y.postdate < DATE '{end}' GROUP BY 1) g ON g.id = sa.id
    LEFT JOIN (SELECT v.id, sum(p.amount) AS pay, sum(coalesce(p.burden, 0)) AS burden
               FROM m_visits v JOIN m_pay p ON p.job_id = v.job_id GROUP BY 1) l ON l.id = sa.id
    LEFT JOIN (SELECT v.id, sum(CASE WHEN ii.skureference_skutype = 1 THEN ii.totalcost ELSE 0 END) AS material,
                      sum(CASE WHEN ii.skureference_skutype = 2 THEN ii.totalcost ELSE 0 END) AS equipment
               FROM m_visits v JOIN r_invoice i ON i.job_id = v.job_id AND i.active = 1
               JOIN r_invoiceitem ii ON ii.invoice_id = i.id AND ii.active = 1 GROUP BY 1) c ON c.id = sa.id
    WHERE sa.active = 1 AND (g.revenue IS NOT NULL OR l.pay IS NOT NULL OR c.material IS NOT NULL)"""


def labor(multiplied: bool) -> str:
    """Pay and adjustments side by side, or the sums over all their pairs."""
    if multiplied:
        return """
    SELECT i.*, max(coalesce(p.changed, a._record_updated_ts_utc)) AS LastLaborModifiedOn,
           sum(CASE WHEN p.kind IN (2, 4) THEN p.amount ELSE 0 END) AS RegularLaborCost,
           sum(CASE WHEN p.kind IN (1, 3) THEN p.amount ELSE 0 END) AS PieceworkCost,
           coalesce(sum(p.load), 0) AS LaborBurdenCost, coalesce(sum(a.amount), 0) AS PayrollAdjustmentCost,
           coalesce(sum(p.amount), 0) + coalesce(sum(a.amount), 0) + coalesce(sum(p.load), 0) AS TotalLaborCost,
           sum(CASE WHEN p.kind IN (2, 4) THEN p.hours ELSE 0 END) AS RegularLaborHours,
           sum(CASE WHEN p.kind IN (1, 3) THEN p.hours ELSE 0 END) AS PieceworkHours
    FROM m_posted i LEFT JOIN m_pay p ON p.invoice_id = i.InvoiceId LEFT JOIN m_adjust a ON a.invoice_id = i.InvoiceId
    WHERE p.invoice_id IS NOT NULL OR a.invoice_id IS NOT NULL GROUP BY ALL"""
    return """
    SELECT i.*, greatest(p.changed, CASE WHEN p.n IS NULL OR p.dated < p.n THEN a.changed END) AS LastLaborModifiedOn,
           coalesce(p.regular, 0) AS RegularLaborCost, coalesce(p.piece, 0) AS PieceworkCost,
           coalesce(p.load, 0) AS LaborBurdenCost, coalesce(a.amount, 0) AS PayrollAdjustmentCost,
           coalesce(p.amount, 0) + coalesce(a.amount, 0) + coalesce(p.load, 0) AS TotalLaborCost,
           coalesce(p.regular_hours, 0) AS RegularLaborHours, coalesce(p.piece_hours, 0) AS PieceworkHours
    FROM m_posted i
    LEFT JOIN (SELECT invoice_id, sum(amount) AS amount, sum(load) AS load, max(changed) AS changed, count(*) AS n,
                      count(changed) AS dated, sum(amount) FILTER (WHERE kind IN (2, 4)) AS regular,
                      sum(amount) FILTER (WHERE kind IN (1, 3)) AS piece,
                      sum(hours) FILTER (WHERE kind IN (2, 4)) AS regular_hours,
                      sum(hours) FILTER (WHERE kind IN (1, 3)) AS piece_hours
               FROM m_pay GROUP BY 1) p ON p.invoice_id = i.InvoiceId
    LEFT JOIN (SELECT invoice_id, sum(amount) AS amount, max(_record_updated_ts_utc) AS changed
               FROM m_adjust GROUP BY 1) a ON a.invoice_id = i.InvoiceId
    WHERE p.invoice_id IS NOT NULL OR a.invoice_id IS NOT NULL"""


def invoice_fact(people: str) -> str:
    return f"""
    SELECT v.InvoiceId, v.JobId, v.TenantId, cal.DateKey, CustomerKey, LocationKey, BusinessUnitKey, JobTypeKey,
           EmployeeKey, JobKey, v.InvoicedOn, v.PostedDate, v.InvoiceDate, v.TransactionNumber, v.InvoiceStatus,
           i.adjustmentto_id IS NOT NULL AS IsAdjustment, i.adjustmentto_id AS AdjustmentToInvoiceId, TotalRevenue,
           IncomeRevenue, LineItemCount, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _COSTS)}
    FROM m_mat_invoice_revenue v JOIN r_invoice i ON i.id = v.InvoiceId JOIN m_jobkeys k ON k.JobId = v.JobId
    LEFT JOIN m_mat_invoice_materialcosts mc ON mc.InvoiceId = v.InvoiceId
    LEFT JOIN m_mat_invoice_pocosts pc ON pc.InvoiceId = v.InvoiceId
    LEFT JOIN m_mat_invoice_laborcosts lc ON lc.InvoiceId = v.InvoiceId
    LEFT JOIN m_dim_date cal ON cal.Date = v.InvoiceDate
    LEFT JOIN ({people}) s ON s.JobId = v.JobId LEFT JOIN m_dim_employee e ON e.EmployeeId = s.EmployeeId"""


_COSTS = (
    "EquipmentCost", "MaterialCost", "TotalItemCost", "POUnbilledCost", "POBilledCost", "TotalPOCost", "POCount",
    "RegularLaborCost", "PieceworkCost", "LaborBurdenCost", "PayrollAdjustmentCost", "TotalLaborCost",
    "RegularLaborHours", "PieceworkHours",
)
FIRST_SELLER = "SELECT JobId, min(EmployeeId) AS EmployeeId FROM m_sellers GROUP BY 1"
ALL_SELLERS = "SELECT DISTINCT JobId, EmployeeId FROM m_sellers"
_RATES = ("JobCommissionPct", "SAYear1CommissionPct", "SAYear2CommissionPct", "SAYear3PlusCommissionPct")
_FIELDS = ("JobCommission%", "SAYear1Commission%", "SAYear2Commission%", "SAYear3+Commission%")
_TIER = """CASE WHEN {year} = 1 THEN {margin} * coalesce(SAYear1CommissionPct, 0)
                WHEN {year} = 2 THEN {margin} * coalesce(SAYear2CommissionPct, 0)
                WHEN {year} > 2 THEN {margin} * coalesce(SAYear3PlusCommissionPct, 0) END"""
_CENT = "CAST(0.01 AS DECIMAL(3,2))"


def agreement_side(fact: str, costs: str) -> str:
    tier = _TIER.format(year="a.SARenewalYear", margin="(a.revenue - coalesce(c.cost, 0))::DECIMAL(20,2)")
    return f"""
    SELECT a.ServiceAgreementId, a.TenantId, a.SAName, bu.BusinessUnitName AS BusinessUnit,
           a.SATemplateType AS ServiceAgreementTemplateType, a.SAStartDate AS ServiceAgreementStartDate,
           cu.CustomerName AS ServiceAgreementCustomer, cu.CustomerId AS ServiceAgreementCustomerId,
           lo.LocationName AS ServiceAgreementLocation, lo.LocationId AS ServiceAgreementLocationId,
           c.cost AS CostFromJobs, a.revenue AS ServiceAgreementRevenue,
           a.SARenewalYear AS ServiceAgreementRenewalYear,
           CAST({tier} AS DECIMAL(30,6)) * {_CENT} AS ServiceAgreementCommission,
           a.revenue - coalesce(c.cost, 0) AS ServiceAgreementMargin, e.EmployeeName, e.EmployeeType, e.EmployeeId,
           {", ".join("a." + r for r in _RATES)}
    FROM (SELECT ServiceAgreementId, TenantId, max(SAName) AS SAName, max(SATemplateType) AS SATemplateType,
                 max(SAStartDate) AS SAStartDate, max(SARenewalYear) AS SARenewalYear, max(CustomerKey) AS CustomerKey,
                 max(LocationKey) AS LocationKey, max(BusinessUnitKey) AS BusinessUnitKey,
                 max(EmployeeKey) AS EmployeeKey, {", ".join(f"max({r}) AS {r}" for r in _RATES)},
                 sum(RevenueRecognitionAmount) AS revenue
          FROM {fact} GROUP BY 1, 2) a
    JOIN m_dim_customer cu ON cu.CustomerKey = a.CustomerKey AND cu.IsActive
    JOIN m_dim_location lo ON lo.LocationKey = a.LocationKey
    JOIN m_dim_businessunit bu ON bu.BusinessUnitKey = a.BusinessUnitKey
    LEFT JOIN m_dim_employee e ON e.EmployeeKey = a.EmployeeKey AND e.IsActive
    LEFT JOIN (SELECT agreement, sum(cost) AS cost FROM m_visit_invoices WHERE {costs} GROUP BY 1) c
      ON c.agreement = a.ServiceAgreementId"""


MART: dict[str, str] = {
    "m_dim_date": f"""
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS DateKey, day AS Date
    FROM ({calendar(f"DATE '{SETTINGS.calendar_start}'", f"DATE '{SETTINGS.calendar_end}'")})""",
    "m_dim_tenant": " UNION ALL ".join(
        f"SELECT CAST({t} AS BIGINT) AS TenantId, '{n}' AS TenantName, '{o}' AS TenantOfficialName, {a} AS IsActive"
        for t, n, o, a in SETTINGS.tenants
    ),
    "m_dim_businessunit": dim(
        "BusinessUnitKey", "id", "id AS BusinessUnitId, _tenant_id AS TenantId, name AS BusinessUnitName, TRUE AS IsActive",
        "r_businessunit",
    ),
    "m_dim_customer": dim(
        "CustomerKey", "id", "id AS CustomerId, _tenant_id AS TenantId, name AS CustomerName, active = 1 AS IsActive",
        "r_customer",
    ),
    "m_dim_employee": dim(
        "EmployeeKey", "id",
        "id AS EmployeeId, _tenant_id AS TenantId, name AS EmployeeName, 'Employee' AS EmployeeType, active = 1 AS IsActive",
        "r_employee",
    ),
    "m_dim_glaccount": dim(
        "GLAccountKey", "ga.id",
        "ga.id AS GLAccountId, ga._tenant_id AS TenantId, gt.name AS GLAccountType, ga.type_id AS GLAccountTypeId, "
        "TRUE AS IsActive",
        "r_generalledgeraccount ga LEFT JOIN r_generalledgeraccounttype gt ON gt.id = ga.type_id",
    ),
    "m_dim_job": dim(
        "JobKey", "id",
        "id AS JobId, _tenant_id AS TenantId, summary AS JobSummary, service_agreement_id AS ServiceAgreementId, "
        "active = 1 AS IsActive",
        "r_job",
    ),
    "m_dim_jobtype": dim(
        "JobTypeKey", "id", "id AS JobTypeId, _tenant_id AS TenantId, name AS JobTypeName, TRUE AS IsActive",
        "r_jobtype",
    ),
    "m_dim_location": dim(
        "LocationKey", "id", "id AS LocationId, _tenant_id AS TenantId, name AS LocationName, TRUE AS IsActive",
        "r_location",
    ),
    "m_dim_sku": dim(
        "SKUKey", "SKUId, SKUType", "SKUId, SKUType, TenantId, TRUE AS IsActive",
        "(SELECT id AS SKUId, 1 AS SKUType, _tenant_id AS TenantId FROM r_material "
        "UNION ALL SELECT id, 2, _tenant_id FROM r_equipment)",
    ),
    "m_renewal": """
    SELECT id, row_number() OVER (PARTITION BY renewalgroupinitialagreement_id ORDER BY startdate, id) AS renewal
    FROM r_serviceagreement WHERE active = 1""",
    "m_agreement": """
    SELECT sa.*, coalesce(n.renewal, 1) AS RenewalYear, p.place, t.id AS TemplateId, t.name AS TemplateName
    FROM r_serviceagreement sa LEFT JOIN m_renewal n ON n.id = sa.id
    LEFT JOIN (SELECT serviceagreement_id, min(locationid) AS place FROM r_serviceagreementlocation
               WHERE active = 1 GROUP BY 1) p ON p.serviceagreement_id = sa.id
    LEFT JOIN r_serviceagreementtemplate t ON t.id = sa.templateinstance_id""",
    "m_dim_serviceagreement": dim(
        "ServiceAgreementKey", "id",
        """id AS ServiceAgreementId, _tenant_id AS TenantId, name AS ServiceAgreementName, customerid AS CustomerId,
        place AS LocationId, businessunitid AS BusinessUnitId, soldbyid AS SoldById, TemplateId, TemplateName,
        TemplateName AS TemplateType, startdate AS StartDate, enddate AS EndDate, RenewalYear,
        renewalgroupinitialagreement_id AS RenewalGroupInitialAgreementId, renewedby_id AS RenewedById,
        status AS Status,
        coalesce(['Draft', 'Pending', 'Active', 'Complete', 'Cancelled'][status], 'Unknown') AS StatusName,
        active = 1 AS IsActive""",
        "m_agreement",
    ),
    "m_latest_fields": """
    SELECT f.owner_id, f._tenant_id, f.type_id, replace(t.name, ' ', '') || 'Employee' AS label, f.value
    FROM r_customfield f JOIN r_customfieldtype t ON t.id = f.type_id AND t.active = 1 AND (t.ownertype & 32) <> 0
    JOIN r_employee e ON e.id = f.owner_id AND e.active = 1
    WHERE f.active = 1
    QUALIFY row_number() OVER (PARTITION BY f.owner_id, f.type_id ORDER BY f.createdon DESC NULLS LAST, f.id DESC) = 1
    """,
    "m_mat_employee_commissionrates": f"""
    SELECT e.id AS EmployeeId, e._tenant_id AS TenantId, e.name AS EmployeeName, 'Employee' AS EmployeeType,
           CAST(round(coalesce(max(rate) FILTER (WHERE label = 'CommissionTypeEmployee'), 0)) AS INTEGER)
             AS CommissionType,
           {", ".join(f"coalesce(max(rate) FILTER (WHERE label = '{f}Employee'), 0) AS {r}"
                      for f, r in zip(_FIELDS, _RATES))}
    FROM r_employee e
    JOIN (SELECT *, TRY_CAST(value AS DECIMAL(10,2)) AS rate FROM m_latest_fields) f ON f.owner_id = e.id
    GROUP BY ALL""",
    "m_posted": f"""
    SELECT id AS InvoiceId, _tenant_id AS TenantId, job_id AS JobId, CAST(invoicedon AS DATE) AS PostedDate,
           modifiedon AS InvoiceModifiedOn, trans_number AS TransactionNumber, status AS InvoiceStatus
    FROM r_invoice WHERE active = 1 AND status = 2 AND CAST(invoicedon AS DATE) {_WINDOW}""",
    "m_mat_invoice_revenue": """
    SELECT p.*, p.PostedDate AS InvoicedOn, p.PostedDate AS InvoiceDate,
           CAST(coalesce(sum(ii.total), 0) AS DECIMAL(20,2)) AS TotalRevenue,
           CAST(coalesce(sum(ii.total) FILTER (WHERE gt.name IS NULL OR gt.name ILIKE '%income%'), 0) AS DECIMAL(20,2))
             AS IncomeRevenue,
           count(DISTINCT ii.id) AS LineItemCount
    FROM m_posted p LEFT JOIN r_invoiceitem ii ON ii.invoice_id = p.InvoiceId AND ii.active = 1
    LEFT JOIN r_generalledgeraccount ga ON ga.id = ii.generalledgeraccount_id
    LEFT JOIN r_generalledgeraccounttype gt ON gt.id = ga.type_id GROUP BY ALL""",
    "m_mat_invoice_materialcosts": """
    SELECT p.*, CAST(coalesce(sum(totalcost) FILTER (WHERE skureference_skutype = 2), 0) AS DECIMAL(20,2))
             AS EquipmentCost,
           CAST(coalesce(sum(totalcost) FILTER (WHERE skureference_skutype = 1), 0) AS DECIMAL(20,2)) AS MaterialCost,
           CAST(sum(totalcost) AS DECIMAL(20,2)) AS TotalItemCost
    FROM m_posted p JOIN r_invoiceitem ii ON ii.invoice_id = p.InvoiceId
    WHERE ii.active = 1 AND procurementsource_purchaseorderitemid IS NULL
      AND ((skureference_skutype = 2 AND skureference_skuid IN (SELECT id FROM r_equipment))
        OR (skureference_skutype = 1 AND skureference_skuid IN (SELECT id FROM r_material)))
    GROUP BY ALL""",
    "m_mat_invoice_pocosts": """
    SELECT p.*, max(po.modifiedon) AS LastPOModifiedOn, coalesce(any_value(u.cost), 0) AS POUnbilledCost,
           coalesce(any_value(b.cost), 0) AS POBilledCost,
           coalesce(any_value(u.cost), 0) + coalesce(any_value(b.cost), 0) AS TotalPOCost, count(DISTINCT po.id) AS POCount
    FROM m_posted p JOIN r_purchaseorder po ON po.invoice_id = p.InvoiceId AND po.active = 1
    LEFT JOIN (SELECT invoice_id, sum(amount) AS cost FROM r_purchaseorder o
               WHERE o.id NOT IN (SELECT purchaseorder_id FROM r_inventoryshipment WHERE bill_id IS NOT NULL)
               GROUP BY 1) u ON u.invoice_id = p.InvoiceId
    LEFT JOIN (SELECT o.invoice_id, sum(b.total) AS cost FROM r_purchaseorder o
               JOIN r_inventorybill b ON b.purchaseorder_id = o.id GROUP BY 1) b ON b.invoice_id = p.InvoiceId
    GROUP BY ALL""",
    "m_pay": """
    SELECT g.job_id, g.invoice_id, g.amount, g.hours, g.kind, g.burden, g.changed,
           CASE WHEN g.burden > 0 THEN g.burden WHEN t.burdenrate IS NOT NULL THEN t.burdenrate * g.hours ELSE 0 END
             AS load
    FROM (SELECT job_id, invoice_id, amount, paiddurationhours AS hours, grosspayitemtype AS kind,
                 burdencostamount AS burden, technician_id AS person, _record_updated_ts_utc AS changed
          FROM r_grosspayitem
          UNION ALL
          SELECT job_id, invoice_id, amount, paiddurationhours, grosspayitemtype, 0, employee_id, _record_updated_ts_utc
          FROM r_employeegrosspayitem) g LEFT JOIN r_technician t ON t.id = g.person""",
    "m_adjust": """
    SELECT invoice_id, amount, _record_updated_ts_utc FROM r_payrolladjustment
    UNION ALL SELECT invoice_id, amount, _record_updated_ts_utc FROM r_employeepayrolladjustment""",
    "m_mat_invoice_laborcosts": f"""
    SELECT * REPLACE (CAST(LaborBurdenCost AS DECIMAL(20,2)) AS LaborBurdenCost,
                      CAST(TotalLaborCost AS DECIMAL(20,2)) AS TotalLaborCost) FROM ({labor(False)})""",
    "m_labor_pairs": f"""
    SELECT * REPLACE (CAST(LaborBurdenCost AS DECIMAL(20,2)) AS LaborBurdenCost,
                      CAST(TotalLaborCost AS DECIMAL(20,2)) AS TotalLaborCost) FROM ({labor(True)})""",
    "m_mat_job_returns": f"""
    SELECT job_id AS JobId, _tenant_id AS TenantId, max(CAST(createdon AS DATE)) AS LastReturnDate,
           -sum(amount) AS TotalReturnCredit, count(*) AS ReturnCount
    FROM r_inventoryreturn WHERE datereturned {_WINDOW} GROUP BY 1, 2""",
    "m_visits": """
    SELECT sal.serviceagreement_id AS id, v.jobid AS job_id
    FROM r_serviceagreementvisit v
    JOIN r_serviceagreementlocation sal ON sal.id = v.serviceagreementlocation_id AND sal.active = 1
    JOIN r_job j ON j.id = v.jobid AND j.active = 1""",
    "m_mat_sa_period_measures": " UNION ALL ".join(period_measures(start, end) for start, end in PERIODS),
    "m_sellers": """
    SELECT f.owner_id AS JobId, s.EmployeeId
    FROM r_customfield f JOIN r_customfieldtype t ON t.id = f.type_id AND t.name ILIKE '%salesperson%'
    JOIN m_mat_employee_commissionrates s ON trim(s.EmployeeName) = trim(f.value) WHERE f.active = 1""",
    "m_jobkeys": """
    SELECT j.id AS JobId, j.active, JobKey, CustomerKey, LocationKey, BusinessUnitKey, JobTypeKey
    FROM r_job j LEFT JOIN m_dim_job dj ON dj.JobId = j.id LEFT JOIN m_dim_customer dc ON dc.CustomerId = j.customer_id
    LEFT JOIN m_dim_location dl ON dl.LocationId = j.location_id
    LEFT JOIN m_dim_businessunit db ON db.BusinessUnitId = j.businessunit_id
    LEFT JOIN m_dim_jobtype dt ON dt.JobTypeId = j.type_id""",
    "m_fact_invoice": invoice_fact(FIRST_SELLER),
    "m_fact_invoice_each": invoice_fact(ALL_SELLERS),
    "m_fact_invoiceitem": """
    SELECT ii.id AS InvoiceItemId, p.InvoiceId, p.JobId, p.TenantId, cal.DateKey, CustomerKey, LocationKey,
           BusinessUnitKey, JobTypeKey, JobKey, SKUKey, GLAccountKey, p.PostedDate AS InvoicedOn, p.PostedDate,
           p.PostedDate AS InvoiceDate, ii.description AS ItemDescription, NULL AS ItemSequence,
           ii.skureference_skutype AS SKUType, CAST(ii.total AS DECIMAL(20,2)) AS ItemRevenue,
           ii.quantity AS ItemQuantity, NULL AS ItemUnitPrice, CAST(ii.totalcost AS DECIMAL(20,2)) AS ItemCost,
           g.GLAccountType IS NULL OR g.GLAccountType ILIKE '%income%' AS IsIncome,
           ii.procurementsource_purchaseorderitemid IS NOT NULL AS IsPOItem,
           ii.procurementsource_purchaseorderitemid AS POItemId
    FROM r_invoiceitem ii JOIN m_posted p ON p.InvoiceId = ii.invoice_id
    JOIN m_jobkeys k ON k.JobId = p.JobId AND k.active = 1
    LEFT JOIN m_dim_date cal ON cal.Date = p.PostedDate
    LEFT JOIN m_dim_sku s ON s.SKUId = ii.skureference_skuid AND s.SKUType = ii.skureference_skutype
    LEFT JOIN m_dim_glaccount g ON g.GLAccountId = ii.generalledgeraccount_id
    WHERE ii.active = 1""",
    "m_fact_serviceagreement": f"""
    SELECT m.ServiceAgreementId, cal.DateKey, CustomerKey, LocationKey, BusinessUnitKey, EmployeeKey,
           d.ServiceAgreementKey AS ServiceAgreementDimKey, a.name AS SAName, a.TemplateName AS SATemplateType,
           a.startdate AS SAStartDate, a.enddate AS SAEndDate, a.RenewalYear AS SARenewalYear, a.status AS SAStatus,
           RevenueRecognitionAmount, LaborCost, BurdenCost, MaterialCost, EquipmentCost,
           x.employee_id AS SoldByEmployeeId, {", ".join(f"CAST(r.{c} AS DECIMAL(10,2)) AS {c}" for c in _RATES)},
           m.PeriodStartDate, m.PeriodEndDate, m.TenantId
    FROM m_mat_sa_period_measures m JOIN m_agreement a ON a.id = m.ServiceAgreementId AND a.active = 1
    LEFT JOIN m_dim_serviceagreement d ON d.ServiceAgreementId = a.id
    LEFT JOIN r_ext_employee x ON x.user_id = a.soldbyid
    LEFT JOIN m_dim_date cal ON cal.Date = m.PeriodStartDate
    LEFT JOIN m_dim_customer cu ON cu.CustomerId = a.customerid LEFT JOIN m_dim_location lo ON lo.LocationId = a.place
    LEFT JOIN m_dim_businessunit bu ON bu.BusinessUnitId = a.businessunitid
    LEFT JOIN m_dim_employee e ON e.EmployeeId = x.employee_id
    LEFT JOIN m_mat_employee_commissionrates r ON r.EmployeeId = x.employee_id""",
    # ---- report ---------------------------------------------------------------------------------------------------
    "m_job_invoices": """
    SELECT f.* EXCLUDE (JobId), j.JobId, j.JobSummary, f.IncomeRevenue AS JobRevenue,
           f.TotalItemCost + f.TotalPOCost + f.TotalLaborCost + coalesce(r.TotalReturnCredit, 0) AS JobCost,
           f.IncomeRevenue - f.TotalItemCost - f.TotalPOCost - f.TotalLaborCost - coalesce(r.TotalReturnCredit, 0)
             AS JobMargin
    FROM m_fact_invoice f JOIN m_dim_job j ON j.JobKey = f.JobKey AND j.IsActive
    LEFT JOIN m_mat_job_returns r ON r.JobId = j.JobId
    WHERE f.InvoiceStatus = 2 AND j.ServiceAgreementId IS NULL""",
    "m_job_side": f"""
    SELECT f.*, cu.CustomerName AS JobCustomer, cu.CustomerId AS JobCustomerId, lo.LocationName AS JobLocation,
           lo.LocationId AS JobLocationId, bu.BusinessUnitName AS BusinessUnit, jt.JobTypeName AS JobType,
           e.EmployeeName, e.EmployeeType, e.EmployeeId, r.CommissionType, {", ".join("r." + c for c in _RATES)},
           f.JobMargin::DECIMAL(20,2) * coalesce(r.JobCommissionPct, 0)::DECIMAL(10,4) * {_CENT} AS JobCommission
    FROM m_job_invoices f JOIN m_dim_customer cu ON cu.CustomerKey = f.CustomerKey AND cu.IsActive
    JOIN m_dim_location lo ON lo.LocationKey = f.LocationKey
    JOIN m_dim_businessunit bu ON bu.BusinessUnitKey = f.BusinessUnitKey
    JOIN m_dim_jobtype jt ON jt.JobTypeKey = f.JobTypeKey
    LEFT JOIN m_dim_employee e ON e.EmployeeKey = f.EmployeeKey AND e.IsActive
    LEFT JOIN m_mat_employee_commissionrates r ON r.EmployeeId = e.EmployeeId""",
    "m_visit_invoices": """
    SELECT j.ServiceAgreementId AS agreement, f.InvoiceId, f.TransactionNumber, f.InvoiceStatus, f.PostedDate,
           f.TotalItemCost + f.TotalPOCost + f.TotalLaborCost + coalesce(r.TotalReturnCredit, 0) AS cost
    FROM m_fact_invoice f JOIN m_dim_job j ON j.JobKey = f.JobKey AND j.ServiceAgreementId IS NOT NULL
    LEFT JOIN m_mat_job_returns r ON r.JobId = j.JobId""",
    "m_report_jobs": f"""
    SELECT TenantId AS "_TenantId", JobId, TransactionNumber, BusinessUnit, JobType, JobSummary, JobCustomer,
           JobCustomerId, JobLocation, JobLocationId, JobRevenue, JobCost, JobMargin,
           CAST(JobCommission AS DECIMAL(10,2)) AS JobCommission, CAST(InvoiceId AS VARCHAR) AS InvoiceId,
           TransactionNumber AS InvoiceNumber, 'EditInvoice/' || InvoiceId AS LinkPath, EmployeeName, EmployeeType,
           EmployeeId, CommissionType AS CommissionTypeEmployee,
           {", ".join(f'{r} AS "{f}Employee"' for f, r in zip(_FIELDS, _RATES))}
    FROM m_job_side WHERE PostedDate {_RWINDOW}""",
    "m_report_agreements": f"""
    SELECT s.TenantId AS "_TenantId", s.SAName AS TransactionNumber, s.* EXCLUDE (TenantId, SAName,
             ServiceAgreementCommission, {", ".join(_RATES)}), l.ids AS InvoiceId, l.numbers AS InvoiceNumber,
           CAST(s.ServiceAgreementCommission AS DECIMAL(10,2)) AS ServiceAgreementCommission,
           'customer/' || s.ServiceAgreementCustomerId || '/service-agreement/' || s.ServiceAgreementId AS LinkPath,
           {", ".join(f'{r} AS "{f}Employee"' for f, r in zip(_FIELDS, _RATES))}
    FROM ({agreement_side("m_fact_serviceagreement", f"PostedDate {_RWINDOW}")}) s
    LEFT JOIN (SELECT agreement, string_agg(DISTINCT TransactionNumber, ', ' ORDER BY TransactionNumber) AS numbers,
                      listagg(DISTINCT InvoiceId, ', ' ORDER BY InvoiceId) AS ids
               FROM m_visit_invoices WHERE InvoiceStatus = 2 AND PostedDate {_RWINDOW} GROUP BY 1) l
      ON l.agreement = s.ServiceAgreementId""",
    "m_report": """
    SELECT t.TenantName AS "_TenantName", t.TenantOfficialName AS "_TenantOfficialName", u.*
    FROM (SELECT * FROM m_report_jobs UNION ALL BY NAME SELECT * FROM m_report_agreements) u
    LEFT JOIN m_dim_tenant t ON t.TenantId = u."_TenantId\"""",
    "m_sa_metrics": agreement_side("m_fact_serviceagreement", "InvoiceStatus = 2"),
    "m_employee_metrics": f"""
    WITH by_job AS (
      SELECT e.EmployeeId, e.EmployeeName, e.EmployeeType,
             sum(f.JobMargin::DECIMAL(20,2) * coalesce(r.JobCommissionPct, 0)::DECIMAL(10,4) * {_CENT}) AS amount
      FROM m_job_invoices f LEFT JOIN m_dim_employee e ON e.EmployeeKey = f.EmployeeKey AND e.IsActive
      LEFT JOIN m_mat_employee_commissionrates r ON r.EmployeeId = e.EmployeeId GROUP BY ALL),
    by_agreement AS (
      SELECT e.EmployeeId, e.EmployeeName, e.EmployeeType,
             sum(coalesce({_TIER.format(year="f.SARenewalYear",
                                        margin="(f.RevenueRecognitionAmount - coalesce(c.mean, 0))")}, 0)) * {_CENT}
               AS amount
      FROM m_fact_serviceagreement f LEFT JOIN m_dim_employee e ON e.EmployeeKey = f.EmployeeKey AND e.IsActive
      LEFT JOIN (SELECT agreement, CAST(CAST(sum(cost) AS DOUBLE) / count(*) AS DECIMAL(20,6)) AS mean
                 FROM m_visit_invoices WHERE InvoiceStatus = 2 GROUP BY 1) c ON c.agreement = f.ServiceAgreementId
      GROUP BY ALL)
    SELECT coalesce(j.EmployeeId, a.EmployeeId) AS EmployeeId, coalesce(j.EmployeeName, a.EmployeeName) AS EmployeeName,
           coalesce(j.EmployeeType, a.EmployeeType) AS EmployeeType, coalesce(j.amount, 0) AS JobCommission,
           coalesce(a.amount, 0) AS SACommission, coalesce(j.amount, 0) + coalesce(a.amount, 0) AS TotalCommission
    FROM by_job j FULL JOIN by_agreement a ON a.EmployeeId = j.EmployeeId""",
}

_KNOWN = {**RAW, **MART}
_MENTION = re.compile(r"\b(?:r|m)_[a-z_]+\b")


def compose(query: str) -> str:
    """``query`` with every table it needs in front of it, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _MENTION.findall(text):
            if name in _KNOWN and name not in order:
                need(_KNOWN[name])
                order.append(name)

    need(query)
    parts = [f"{name} AS ({_KNOWN[name].strip()})" for name in order]
    return (f"WITH {', '.join(parts)} " if parts else "") + f"SELECT * FROM ({query.strip()}) AS answer"


_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP"}


def typed(columns: dict[str, str], query: str) -> str:
    """Give the columns the types the Spark side delivers; amounts become DOUBLE on both sides."""
    items = [
        f'CAST("{name}" AS {"DOUBLE" if kind.startswith("decimal") else _SQL_TYPES[kind]}) AS "{name}"'
        for name, kind in columns.items()
    ]
    return f"SELECT {', '.join(items)} FROM ({query})"


def table(name: str, drop: tuple[str, ...] = (), source: str | None = None) -> str:
    """A whole mart table."""
    hidden = {"LoadDateTime", "UpdatedDateTime", *drop}
    columns = {c: k for c, k in schemas.MART[name].items() if c not in hidden}
    return compose(typed(columns, f"SELECT * FROM {source or 'm_' + name}"))
