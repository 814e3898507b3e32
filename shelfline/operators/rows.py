"""Row generators shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, values: Column, pos: str, name: str) -> DataFrame:
    """One row per element, none for null or empty.

    The plain generator would get an inferred size filter that computes ``values`` a second time, so the
    outer form is used and its empty row dropped after it.
    """
    rows = df.select(*df.columns, F.posexplode_outer(values).alias(pos, name))
    return rows.filter(F.col(pos).isNotNull())


def settle(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column as generator output.

    Later filters on it then stay above it; pushed below, they would repeat the whole extraction, once per
    mention.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode_outer(F.array(value)).alias(name))
