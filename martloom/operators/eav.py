"""Attribute-value rows to columns (A10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def eav_pivot(df: DataFrame, owner: Sequence[str], attribute: str, value: Column, columns: Mapping[str, str]) -> DataFrame:
    """One row per owner; ``columns`` maps attribute name -> output column, which holds the greatest ``value``.

    The attribute list is fixed, so no pass over the data is needed to find it. An owner that has none of the
    attributes still gets a row of NULLs.
    """
    return df.groupBy(*owner).agg(
        *[F.max(F.when(F.col(attribute) == name, value)).alias(alias) for name, alias in columns.items()]
    )
