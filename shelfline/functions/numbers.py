"""Number parsing with Python's ``float()`` and ``int()`` text grammar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
_INT = rf"\A[+-]?{_DIGITS}\z"
_FLOAT = rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?+)?+|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?+\z"


def parse_float(col: Column) -> Column:
    """Double from text, or null. Underscores between digits, ``nan`` and ``inf`` count; ``12.5d`` and ``1,299`` do not."""
    text = strip(col)
    return (
        F.when(text.rlike(_FLOAT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        .when(text.rlike(r"(?i)\A[+-]?nan\z"), F.lit(float("nan")))
        .when(text.rlike(r"(?i)\A\+?inf(?:inity)?\z"), F.lit(float("inf")))
        .when(text.rlike(r"(?i)\A-inf(?:inity)?\z"), F.lit(float("-inf")))
    )


def parse_int(col: Column) -> Column:
    """Bigint from text, or null (also beyond 64 bits)."""
    text = strip(col)
    return F.when(text.rlike(_INT), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))


def first_number(col: Column) -> Column:
    """First run of digits, commas and dots, commas removed, as a double."""
    return parse_float(F.replace(F.regexp_extract(col, r"[\d,.]+", 0), F.lit(","), F.lit("")))
