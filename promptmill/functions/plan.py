"""Keeping costly expressions from being evaluated more than once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters cannot be pushed below.

    The optimizer moves a filter under the projection that computes its column by repeating the
    expression, which for a text rule means evaluating it several times per row. Columns that come
    out of a one-row generator stay where they are; filters on the other columns still reach the
    scan.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def held(df: DataFrame, *names: str) -> DataFrame:
    """Fix columns a projection below has computed, before a filter on them.

    Unlike computing them with :func:`computed` from the start, branches that do not need the
    columns still drop them.
    """
    return computed(df, **{name: F.col(name) for name in names})
