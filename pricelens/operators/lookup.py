"""Dimension lookups (J-1, J-2).

How a dimension is joined is left to the optimizer: Catalyst and AQE broadcast
a side by its size in bytes, or sort-merge and split skewed keys. The store
dimension is a local relation, whose size the optimizer knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(df: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """J-1: left join; a key missing from the dimension gives nulls."""
    return df.join(dim, key, "left")


def unknown_keys(df: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """J-2: rows whose key is not in the dimension (they become rejects)."""
    return df.join(dim, key, "left_anti")
