"""Dimension lookups (J4, J16, J18) and reporting joins."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Lookup:
    """``on`` maps fact column -> dimension column; ``take`` maps dimension column -> output name."""

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    how: str = "left"


def star_lookup(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Join the dimensions one after another, keeping only the asked-for columns.

    No broadcast hint is added here: a dimension below ``spark.sql.autoBroadcastJoinThreshold`` (or found to be below it at run time
    by adaptive execution) is broadcast, a larger one is joined by sort-merge, where adaptive execution splits a hot or
    NULL key on the fact side. List lookups that share join columns next to each other: they share one shuffle.
    """
    for number, lookup in enumerate(lookups):
        keys = {f"_k{number}_{column}": column for column in lookup.on.values()}
        right = lookup.dim.select(
            *[F.col(column).alias(alias) for alias, column in keys.items()],
            *[F.col(column).alias(alias) for column, alias in lookup.take.items()],
        )
        condition = None
        for fact_column, dim_column in lookup.on.items():
            term = fact[fact_column] == right[f"_k{number}_{dim_column}"]
            condition = term if condition is None else condition & term
        fact = fact.join(right, condition, lookup.how).drop(*keys)
    return fact
