"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Agreement status names by code.
AGREEMENT_STATUS = {1: "Draft", 2: "Pending", 3: "Active", 4: "Complete", 5: "Cancelled"}


def try_decimal(text: Column, precision: int = 10, scale: int = 2) -> Column:
    """The number in a text, rounded to ``scale``; NULL when it is no number or does not fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def status_name(code: Column, names: dict[int, str] = AGREEMENT_STATUS, otherwise: str = "Unknown") -> Column:
    """Code -> name."""
    chain = None
    for value, name in names.items():
        chain = F.when(code == value, name) if chain is None else chain.when(code == value, name)
    return chain.otherwise(otherwise)


def field_label(name: Column) -> Column:
    """``'Commission Type'`` -> ``'CommissionTypeEmployee'``."""
    return F.concat(F.replace(name, F.lit(" "), F.lit("")), F.lit("Employee"))


def invoice_link(invoice_id: Column) -> Column:
    """X17."""
    return F.concat(F.lit("EditInvoice/"), invoice_id.cast("string"))


def agreement_link(customer_id: Column, agreement_id: Column) -> Column:
    """NULL when either id is NULL."""
    return F.concat(
        F.lit("customer/"), customer_id.cast("string"), F.lit("/service-agreement/"), agreement_id.cast("string")
    )
