"""Parameters shared by the jobs. Every date window and tenant list is an argument, never text inside a query."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

# Fixed value: the tenant the default configuration uses.
DEFAULT_TENANT_ID = 3457543957


@dataclass(frozen=True)
class MartSettings:
    """One run's parameters.

    ``from_date``/``to_date`` bound invoices, returns and the report (both ends included).
    ``period_start``/``period_end`` name the agreement period that is replaced on each run.
    """

    tenant_ids: tuple[int, ...] = (DEFAULT_TENANT_ID,)
    from_date: date = date(2023, 1, 1)
    to_date: date = date(2024, 12, 31)
    period_start: date = date(2024, 1, 1)
    period_end: date = date(2024, 12, 31)
    # Optional report filters: an empty tuple means "no filter".
    employee_ids: tuple[int, ...] = ()
    status_filter: tuple[int, ...] = ()
    # 'preaggregate' sums pay and adjustments once each; 'reference' reproduces the multiplied sums of joining both.
    labor_fanout: str = "preaggregate"
    # 'first' keeps the lowest employee id per job; 'duplicate' repeats the invoice for each salesperson.
    multi_salesperson: str = "first"
    # False: visit costs of an agreement are not limited to the period (only journal revenue is).
    filter_costs_by_period: bool = False
    # Set when the id of invoice items (and of purchase orders) has passed the unique-key gate:
    # counting ids then needs no distinct step and one shuffle less.
    line_ids_unique: bool = False
    # Lay the invoice facts out by date, so that a report over a date window reads only the files of that window.
    cluster_facts: bool = True
    # 'enforce': a load that breaks its table's contract fails and leaves the table as it was; 'record': its findings are
    # only kept; 'off': nothing is checked.
    gates: str = "enforce"
    # Share of a fact's rows whose lookup may find no member; None: such rows are counted, whatever their number.
    unresolved_share: float | None = None
    calendar_start: date = date(2020, 1, 1)
    calendar_end: date = date(2030, 12, 31)
    fiscal_start_month: int = 1
    as_of: date | None = None
    tenants: tuple[tuple[int, str, str, bool], ...] = field(
        default=((DEFAULT_TENANT_ID, "Demo Tenant", "Demo Tenant Corp", True),)
    )

    def __post_init__(self) -> None:
        if self.labor_fanout not in ("preaggregate", "reference"):
            raise ValueError(f"labor_fanout: {self.labor_fanout!r}")
        if self.gates not in ("enforce", "record", "off"):
            raise ValueError(f"gates: {self.gates!r}")
        if self.multi_salesperson not in ("first", "duplicate"):
            raise ValueError(f"multi_salesperson: {self.multi_salesperson!r}")

    def with_(self, **changes) -> "MartSettings":
        return replace(self, **changes)
