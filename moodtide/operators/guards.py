"""Checks made before a plan is built, and a plan-shaping helper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumnsError(ValueError):
    def __init__(self, missing: list[str], available: list[str]):
        self.missing, self.available = missing, available
        super().__init__(f"missing required columns {missing}; available columns are {available}")


def require_columns(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """``df`` unchanged, or an error naming every absent column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(missing, df.columns)
    return df


def project_columns(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Only the named columns, after checking that all are there."""
    return require_columns(df, columns).select(*columns)


def compute_once(df: DataFrame, **expressions: Column) -> DataFrame:
    """Add (or replace) expensive columns so that later filters cannot duplicate them.

    A filter on a projected column is pushed below the projection together with a copy of its
    expression, so the text would be cleaned or the JSON parsed twice. The optimiser does not push
    filters through a generator's output, and ``inline`` of a one-element array is such a
    generator: one row in, one row out, inside the same code-generated stage.
    """
    kept = [F.col(c) for c in df.columns if c not in expressions]
    row = F.struct(*[e.alias(name) for name, e in expressions.items()])
    return df.select(*kept, F.inline(F.array(row)))
