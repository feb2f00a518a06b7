"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.operators.materialize import clear, materialize

__all__ = ["clear", "saved"]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as Parquet and reads them again: the plan starts anew from files that outlive any executor."""
    return materialize(df, name=name)
