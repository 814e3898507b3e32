"""Local names inside column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it.

    Subexpressions are not shared inside lambdas and not between the copies a pushed filter makes, so a
    value mentioned in several places would otherwise be written out, and computed, each time.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
