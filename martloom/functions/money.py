"""Amount expressions. Amounts stay decimal; rounding happens where a table's declared type is applied."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F



def or_zero(value: Column) -> Column:
    """A1: NULL counts as 0."""
    return F.coalesce(value, F.lit(0))


def sum_where(condition: Column, value: Column) -> Column:
    """A2: sum of ``value`` where the condition holds; rows that fail add 0, so a group with rows is never NULL."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def is_income(account_type: Column) -> Column:
    """income unless the account type is known and does not mention income."""
    return account_type.isNull() | F.lower(account_type).contains("income")


def percent_of(amount: Column, percent: Column) -> Column:
    """``amount * percent / 100`` without a lossy decimal division; a NULL percent counts as 0."""
    return (
        amount.cast("decimal(20,2)")
        * or_zero(percent).cast("decimal(10,4)")
        * F.lit(Decimal("0.01")).cast("decimal(2,2)")
    )


def tiered_commission(
    year: Column, margin: Column, first: Column, second: Column, later: Column, otherwise: Column | None = None
) -> Column:
    """Rate by renewal year 1 / 2 / above 2; any other year gives ``otherwise`` (NULL by default)."""
    tiers = (
        F.when(year == 1, percent_of(margin, first))
        .when(year == 2, percent_of(margin, second))
        .when(year > 2, percent_of(margin, later))
    )
    return tiers if otherwise is None else tiers.otherwise(otherwise)


def difference_percent(value: Column, previous: Column) -> Column:
    """NULL when there is no previous value or it is 0."""
    return F.when(previous != 0, (value - previous) / previous * 100)
