"""Loads that end at any step, gates inside a load, retention, and incremental loads."""

from __future__ import annotations

import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom import MartSettings, schemas
from martloom.operators.compare import diff_rows
from martloom.operators.quality import Contract, GateFailure, check_contract
from martloom.plans import changes, pipeline
from martloom.sinks import writers
from martloom.sinks import runlog
from martloom.sinks.runlog import RunLog, last_good_start, run_state
from martloom.sinks.versions import VersionedTable
from martloom.sources.readers import mart_tables

SHAPE = "k int, v string"


class Killed(BaseException):
    """Ends a load as a lost driver would: nothing of it runs any more."""


@pytest.fixture
def table(spark):
    return VersionedTable(spark, tempfile.mkdtemp(prefix="martloom-versions-") + "/t")


def frame(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], SHAPE)


def values(table, **options):
    return sorted(r.v for r in table.read(SHAPE, **options).collect())


def test_a_load_killed_at_any_step_leaves_the_old_or_the_new_table(spark, table, monkeypatch):
    writers.write_full(frame(spark, "old"), table.path)
    stage, put = VersionedTable.stage, VersionedTable._put

    def after_data(self, *a, **k):
        stage(self, *a, **k)
        raise Killed

    def half_pointer(self, number, text):
        put(self, number, text[: len(text) // 2])
        raise Killed

    def after_pointer(self, number, text):
        put(self, number, text)
        raise Killed

    def no_pointer(self, number, text):
        raise Killed

    for name, step, expected in (
        ("stage", after_data, ["old"]), ("_put", no_pointer, ["old"]), ("_put", half_pointer, ["old"]), ("_put", after_pointer, ["new"]),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(VersionedTable, name, step)
            with pytest.raises(Killed):
                writers.write_full(frame(spark, "new"), table.path)
        assert values(table) == expected, step.__name__
    # The next load removes what the killed ones have left, and works.
    assert writers.write_full(frame(spark, "newer", "newest"), table.path) == 2
    assert values(table) == ["newer", "newest"]
    table.sweep()
    left = {n for n in table._names(table.path) if n.startswith("data-")}
    assert left == {p.folder for v in table.versions()[:2] for p in v.parts}


def test_a_reader_keeps_the_version_it_opened(spark, table):
    writers.write_full(frame(spark, "a"), table.path)
    opened = table.read(SHAPE)
    writers.write_full(frame(spark, "b"), table.path)
    assert [r.v for r in opened.collect()] == ["a"] and values(table) == ["b"]
    assert values(table, version=1) == ["a"]
    writers.write_full(frame(spark, "c"), table.path)
    writers.write_full(frame(spark, "d"), table.path)
    assert table.version(1) is None and [v.number for v in table.versions()] == [4, 3, 2]
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, table.path + "-none").read(SHAPE)


def test_two_loads_cannot_take_the_same_version(spark, table, monkeypatch):
    table.replace(frame(spark, "a"))
    monkeypatch.setattr(VersionedTable, "_numbers", lambda self: [])
    with pytest.raises(Exception, match="[Ee]xist"):
        table.replace(frame(spark, "b"))
    monkeypatch.undo()
    assert values(table) == ["a"]


def test_parts_are_replaced_added_and_emptied(spark, table):
    shape = "k int, day date"
    rows = lambda *pairs: spark.createDataFrame([(k, date(2024, 1, d)) for k, d in pairs], shape)
    days = [(date(2024, 1, d),) for d in (1, 2, 3)]
    assert table.replace_parts(rows((1, 1), (2, 2), (9, 9)), ["day"], days) == 2
    assert table.add(rows((7, 7))) == 1
    assert table.replace_parts(rows((3, 2), (4, 3)), ["day"], days[1:]) == 2
    read = lambda **w: sorted(r.k for r in table.read(shape, **w).collect())
    assert read() == [1, 3, 4, 7] and read(where={"day": date(2024, 1, 2)}) == [3, 7]
    assert table.replace_parts(rows(), ["day"], days) == 0
    assert read() == [7]


def test_contracts_count_while_writing(spark, table):
    df = spark.createDataFrame([(1, "a", None), (1, None, 5), (2, "c", None)], "k int, v string, d int")
    contract = Contract(keys=("k",), required=("v",), resolved=("d",), unresolved_share=0.5, least_rows=4)
    found = []
    table.replace(df, *contract.observed(), accept=lambda seen, stored: found.extend(check_contract(contract, seen, stored)))
    assert {(f.gate, f.column): (f.found, f.passed) for f in found} == {
        ("rows", None): (3, False), ("not null", "v"): (1, False), ("not null", "k"): (0, True), ("resolved", "d"): (2, False),
        ("unique", "k"): (1, False),
    }


# ---- loads -----------------------------------------------------------------------------------------------------------
SETTINGS = MartSettings(tenant_ids=(1, 2), tenants=((1, "a", "A", True), (2, "b", "B", True)))


def base_rows():
    """Two tenants with the same ids."""
    rows = {name.replace(".", "__"): [] for name in (*schemas.RAW, *schemas.EXTERNAL)}
    for tenant in (1, 2):
        t = {"_tenant_id": tenant}
        rows["generalledgeraccounttype"] += [{"id": 1, "name": "Income", **t}, {"id": 2, "name": "Expense", **t}]
        rows["generalledgeraccount"] += [{"id": 10, "type_id": 1, **t}, {"id": 11, "type_id": 2, **t}]
        for name in ("customer", "location", "businessunit", "jobtype"):
            rows[name] += [{"id": i, "name": f"{name}{i}", **t} for i in (1, 2)]
        rows["employee"] += [{"id": 1, "name": "Ann", **t}, {"id": 2, "name": "Bob", **t}]
        rows["technician"] += [{"id": 1, "burdenrate": 5, **t}, {"id": 2, "burdenrate": 7, **t}]
        rows["material"] += [{"id": 100, **t}]
        rows["equipment"] += [{"id": 101, **t}]
        rows["customfieldtype"] += [{"id": 1, "name": "Salesperson", "ownertype": 4, **t}, {"id": 2, "name": "Job Commission%", "ownertype": 32, **t}]
        rows["customfield"] += [{"id": i, "owner_id": i, "type_id": 2, "value": "3.5", "createdon": "2024-01-01", **t} for i in (1, 2)]
        for job in range(1, 7):
            rows["job"] += [{"id": job, "customer_id": job % 3 + 1, "location_id": 1, "businessunit_id": 1, "type_id": 1, **t}]
            rows["customfield"] += [{"id": 100 + job, "owner_id": job, "type_id": 1, "value": "Ann" if job % 2 else "Bob", **t}]
            rows["inventoryreturn"] += [{"id": job, "job_id": job, "amount": job, "datereturned": "2024-03-01", "createdon": "2024-03-01", **t}]
            for n in (1, 2):
                invoice = job * 10 + n
                rows["invoice"] += [{"id": invoice, "job_id": job, "invoicedon": f"2024-0{job}-0{n}", "status": 2, "modifiedon": "2024-01-01", **t}]
                for line in (1, 2, 3):
                    rows["invoiceitem"] += [{
                        "id": invoice * 10 + line, "invoice_id": invoice, "generalledgeraccount_id": 9 + line, "total": line * tenant, "totalcost": line,
                        "skureference_skutype": line % 2 + 1, "skureference_skuid": 99 + line, "quantity": 1, **t}]
                rows["purchaseorder"] += [{"id": invoice, "invoice_id": invoice, "amount": 4, "modifiedon": "2024-01-01", **t}]
                rows["inventorybill"] += [{"id": invoice, "purchaseorder_id": invoice, "total": 6, **t}]
                rows["inventoryshipment"] += [{"id": invoice, "purchaseorder_id": invoice, "bill_id": None if n == 1 else invoice, **t}]
                rows["grosspayitem"] += [{"id": invoice, "job_id": job, "invoice_id": invoice, "technician_id": n, "amount": 8,
                                          "paiddurationhours": 2, "grosspayitemtype": 2, **t}]
                rows["payrolladjustment"] += [{"id": invoice, "invoice_id": invoice, "amount": -1, **t}]
    return rows


def edit(rows, table, match, **new):
    """Rows of ``table`` that match get new values; without any they are deleted."""
    hit = lambda r: all(r.get(k) == v for k, v in match.items())
    assert any(hit(r) for r in rows[table]), (table, match)
    rows[table] = [{**r, **new} if hit(r) else r for r in rows[table] if new or not hit(r)]


TRACKED = ("mat_invoice_revenue", "mat_invoice_materialcosts", "mat_invoice_pocosts", "mat_invoice_laborcosts", "mat_job_returns", "fact_invoice", "fact_invoiceitem")


def load(spark, src, root, incremental, tables=TRACKED, settings=SETTINGS):
    """Dimensions and rates are in the mart since the first load."""
    log = RunLog(spark, f"{root}/etl_run_log")
    written = pipeline.load_tables(spark, settings, src, mart_tables(spark, root), root, log, tables, incremental)
    return written, mart_tables(spark, root)


def same(left, right, table):
    hidden = ("LoadDateTime", "UpdatedDateTime", "InvoiceKey", "InvoiceItemKey")
    left, right = (df[table].drop(*hidden) for df in (left, right))
    return diff_rows(left, right, list(schemas.UNIQUE_KEYS[table])).collect() == []


# Edits of tenant 1, each of rows that no other touches, and the invoices that they must reach.
EDITS = [
    ("invoiceitem", {"id": 111, "_tenant_id": 1}, {"total": 50}, {11}),
    ("invoiceitem", {"id": 121, "_tenant_id": 1}, {}, {12}),
    ("invoiceitem", {"id": 211, "_tenant_id": 1}, {"invoice_id": 22}, {21, 22}),
    ("purchaseorder", {"id": 31, "_tenant_id": 1}, {"invoice_id": 32}, {31, 32}),
    ("inventorybill", {"id": 41, "_tenant_id": 1}, {"purchaseorder_id": 42}, {41, 42}),
    ("inventoryshipment", {"id": 51, "_tenant_id": 1}, {"bill_id": 51}, {51}),
    ("grosspayitem", {"id": 52, "_tenant_id": 1}, {"invoice_id": 61}, {52, 61}),
    ("payrolladjustment", {"id": 62, "_tenant_id": 1}, {}, {62}),
]
# Edits that reach invoices through jobs, reference tables, or by themselves: (edit, invoices), for each a run of its own would be the same.
WIDER = [
    ("invoice", {"id": 61, "_tenant_id": 1}, {"invoicedon": "2024-02-09"}, {61}),
    ("job", {"id": 3, "_tenant_id": 1}, {"customer_id": 2}, {31, 32}),
    ("customfield", {"id": 101, "_tenant_id": 1}, {"value": "Bob"}, {11, 12}),
    ("technician", {"id": 2, "_tenant_id": 2}, {"burdenrate": 70}, set()),
    ("inventoryreturn", {"id": 5, "_tenant_id": 1}, {"job_id": 4}, set()),
]


@pytest.fixture(scope="module")
def first(spark, tables):
    root = tempfile.mkdtemp(prefix="martloom-inc-") + "/mart"
    dims = tuple(t for t in pipeline.TABLES if t.startswith("dim_") and t not in ("dim_tenant", "dim_serviceagreement"))
    load(spark, tables(**base_rows()), root, False, (*dims, "mat_employee_commissionrates", *TRACKED))
    return root


def copy_of(root):
    import shutil

    target = tempfile.mkdtemp(prefix="martloom-inc-") + "/mart"
    shutil.copytree(root, target)
    return target


def reached(spark, tables, root, edits):
    rows = base_rows()
    for table, match, new, _ in edits:
        edit(rows, table, match, **new)
    src = tables(**rows)
    before = VersionedTable(spark, f"{root}/{pipeline.STATE}").read(changes.DIGEST)
    owners = changes.changed_owners(before, changes.digests(src, SETTINGS)).cache()
    found = changes.affected_invoices(src, SETTINGS, owners).collect()
    jobs = {r["job_id"] for r in changes.affected_jobs(owners).collect()}
    owners.unpersist()
    assert len(found) == len(set(found))
    return {r["invoice_id"] for r in found if r["_tenant_id"] == 1}, {r["invoice_id"] for r in found if r["_tenant_id"] == 2}, jobs


def test_changes_reach_their_invoices_and_no_others(spark, tables, first):
    assert reached(spark, tables, first, EDITS) == ({i for *_, ids in EDITS for i in ids}, set(), set())
    # The rate of tenant 2's second technician is in the pay of every second invoice there.
    own, others, jobs = reached(spark, tables, first, WIDER)
    assert own == {i for *_, ids in WIDER for i in ids} and others == {10 * j + 2 for j in range(1, 7)} and jobs == {4, 5}
    accounts = [("generalledgeraccount", {"id": 11, "_tenant_id": 1}, {"type_id": 1}, None)]
    assert reached(spark, tables, first, accounts)[:2] == ({10 * j + n for j in range(1, 7) for n in (1, 2)}, set())


def test_incremental_equals_full(spark, tables, first):
    rows = base_rows()
    for table, match, new, _ in (*EDITS, *WIDER):
        edit(rows, table, match, **new)
    edit(rows, "material", {"id": 100, "_tenant_id": 2})
    edit(rows, "invoiceitem", {"id": 123, "_tenant_id": 2})
    edit(rows, "invoice", {"id": 42, "_tenant_id": 2}, status=1)
    rows["invoice"].append({"id": 99, "job_id": 2, "invoicedon": "2024-08-08", "status": 2, "_tenant_id": 2})
    rows["invoiceitem"].append({"id": 990, "invoice_id": 99, "total": 3, "_tenant_id": 2})
    src, full_root, root = tables(**rows), copy_of(first), copy_of(first)
    written, refreshed = load(spark, src, root, True)
    whole, full = load(spark, src, full_root, False)
    for table in TRACKED:
        assert same(refreshed, full, table), table
        assert written[table] <= whole[table]
    for table, key in (("fact_invoice", "InvoiceKey"), ("fact_invoiceitem", "InvoiceItemKey")):
        assert refreshed[table].select(key).distinct().count() == refreshed[table].count()
    # Nothing is left to do, and the same load again changes nothing.
    numbers = [VersionedTable(spark, f"{root}/{t}").current().number for t in TRACKED]
    again, _ = load(spark, src, root, True)
    assert all(again[t] == 0 for t in TRACKED)
    assert numbers == [VersionedTable(spark, f"{root}/{t}").current().number for t in TRACKED]


def test_only_touched_months_are_written_again(spark, tables, first):
    rows, root = base_rows(), copy_of(first)
    edit(rows, "invoice", {"id": 61, "_tenant_id": 1}, invoicedon="2024-02-09")
    parts = lambda t: {dict(p.key)["PostedMonth"]: p.folder for p in VersionedTable(spark, f"{root}/{t}").current().parts}
    before = {t: parts(t) for t in ("mat_invoice_revenue", "fact_invoiceitem")}
    written, _ = load(spark, tables(**rows), root, True)
    assert written["mat_invoice_revenue"] == 1 and written["fact_invoiceitem"] == 3
    for t, folders in before.items():
        assert {m for m, f in parts(t).items() if folders[m] != f} == {"2024-02-01", "2024-06-01"}, t


def test_another_window_is_a_full_load(spark, tables, first):
    root, src = copy_of(first), tables(**base_rows())
    written, mart = load(spark, src, root, True, settings=SETTINGS.with_(to_date=date(2024, 3, 31), gates="off"))
    assert written["mat_invoice_revenue"] == 12 == mart["mat_invoice_revenue"].count()


def test_a_load_that_breaks_its_contract_leaves_the_table(spark, tables, first):
    rows, root = base_rows(), copy_of(first)
    rows["invoiceitem"].append(dict(rows["invoiceitem"][0]))  # a line twice: its id is not unique
    old = mart_tables(spark, root)["fact_invoiceitem"].count()
    with pytest.raises(GateFailure, match="unique InvoiceItemId"):
        load(spark, tables(**rows), root, False, ("fact_invoiceitem",))
    mart = mart_tables(spark, root)
    assert mart["fact_invoiceitem"].count() == old
    log = RunLog(spark, f"{root}/etl_run_log").read()
    state = {r.ProcessName: r for r in run_state(log).collect()}
    assert state["Fact_InvoiceItem"].LastRunStatus == "FAILED" and "unique" in state["Fact_InvoiceItem"].ErrorMessage
    failed = mart["etl_gate_results"].filter("NOT Passed").collect()
    assert [(r.ProcessName, r.Gate, r.Findings) for r in failed] == [("Fact_InvoiceItem", "unique", 1)]
    load(spark, tables(**rows), root, False, ("fact_invoiceitem",), SETTINGS.with_(gates="record"))
    assert mart_tables(spark, root)["fact_invoiceitem"].count() == old + 1


def test_status_rows_come_in_order_and_the_last_good_start_counts(spark):
    log = RunLog(spark, tempfile.mkdtemp(prefix="martloom-log-") + "/log")
    log.seed(("b", "a", "c"))
    before = datetime.now()
    log.run("a", lambda: 0)
    log.run("b", lambda: 5)
    with pytest.raises(ZeroDivisionError):
        log.run("b", lambda: 1 // 0)
    rows = log.status().collect()
    assert [(r.ProcessName, r.LastRunStatus, r.RowsProcessed) for r in rows] == [
        ("a", "SUCCESS_NO_DATA", 0), ("b", "FAILED", 5), ("c", "NOT_STARTED", None),
    ]
    events = log.read().filter("ProcessName = 'b' AND Status = 'RUNNING'").orderBy("EventTime").collect()
    assert last_good_start(log.read(), "b") == events[0].EventTime >= before.replace(microsecond=0)
    assert last_good_start(log.read(), "c") is None


def test_a_folded_log_tells_the_same_and_stays_small(spark, monkeypatch):
    monkeypatch.setattr(runlog, "FOLD_AT", 9)
    monkeypatch.setattr(runlog, "RUNS_KEPT", 2)
    log = RunLog(spark, tempfile.mkdtemp(prefix="martloom-log-") + "/log")
    log.seed(("a", "b"))
    every = []
    add = RunLog._write
    monkeypatch.setattr(RunLog, "_write", lambda self, rows: every.extend(rows.select("*").collect()) or add(self, spark.createDataFrame(every[-1:], rows.schema)))
    log.run("a", lambda: 7)
    for i in range(6):
        log.run("b", lambda: i)
        with pytest.raises(ValueError):
            log.run("a", lambda: int("x"))
    shape = schemas.ddl(schemas.MART["etl_run_log"])
    seeds = log.read().filter("Status = 'NOT_STARTED'")
    whole = schemas.conform(spark.createDataFrame([r.asDict() for r in every], "ProcessName string, RunId string, EventTime timestamp, Status string, RowsProcessed bigint, ErrorMessage string"), schemas.MART["etl_run_log"])
    whole = whole.unionByName(seeds)
    assert sorted(map(tuple, run_state(log.read()).collect())) == sorted(map(tuple, run_state(whole).collect()))
    assert last_good_start(log.read(), "a") == last_good_start(whole, "a")
    assert len(log.table.current().parts) < 9 and log.read().count() < whole.count()
    assert spark.createDataFrame([], shape).columns == log.read().columns


def test_loads_that_add_at_the_same_time_lose_nothing(spark, table, monkeypatch):
    table.add(frame(spark, "first"))
    other = VersionedTable(spark, table.path)
    publish, busy = VersionedTable.publish, [True]

    def interrupted(self, parts, note=None):
        if self is table and busy:
            busy.clear()
            numbers = self._numbers()
            other.add(frame(spark, "other"))
            monkeypatch.setattr(VersionedTable, "_numbers", lambda self: numbers)
            try:
                return publish(self, parts, note)
            finally:
                monkeypatch.undo()
                monkeypatch.setattr(VersionedTable, "publish", interrupted)
        return publish(self, parts, note)

    monkeypatch.setattr(VersionedTable, "publish", interrupted)
    table.add(frame(spark, "mine"))
    assert values(table) == ["first", "mine", "other"]
