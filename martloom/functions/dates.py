"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(day: Column) -> Column:
    """``20240131`` for 2024-01-31."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def weekday(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1


def crossings(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries between two times (10:59 -> 11:00 is one hour)."""
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))
