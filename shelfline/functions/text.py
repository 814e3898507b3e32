"""Text columns: Unicode whitespace, title case, entity decoding."""

from __future__ import annotations

import html
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Every code point that counts as whitespace (Unicode White_Space and the four separators).
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"

# Joins the text nodes of one element so that all of them decode in one string.
NODE_BREAK = "\u0000"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(col, rf"\A{WS}++|(?<!{WS}){WS}++\z", "")


def collapse(col: Column) -> Column:
    """Turn each whitespace run into one space and strip."""
    return F.trim(F.regexp_replace(col, rf"{WS}++", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def title_case(col: Column) -> Column:
    """Upper-case the first letter after any non-letter, lower-case the rest."""
    runs = F.regexp_extract_all(col, F.lit(rf"[{_CASED}]+|[^{_CASED}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))), ""
    )


@lru_cache(maxsize=1)
def _entity_decoder():
    """The one function that runs outside the JVM. Being local, it travels to the executors by value."""

    def decode_cells(cells: pa.Array) -> pa.Array:
        def decode(value):
            return html.unescape(value) if value is not None and "&" in value else value

        decoded = [None if cell is None else [decode(value) for value in cell] for cell in cells.to_pylist()]
        return pa.array(decoded, type=pa.list_(pa.string()))

    return F.arrow_udf(decode_cells, ArrayType(StringType()))


def decode_entities(values: Column) -> Column:
    """Decode HTML character references in an ``array<string>``.

    Rows without any ``&`` are sent to Python as null and keep their own array, so only the rows that
    need the decoder cross the process boundary. Pass all fields of a row in one array.
    """
    wanted = F.exists(values, lambda v: F.contains(v, F.lit("&")))
    return F.coalesce(_entity_decoder()(F.when(wanted, values)), values)


def node_text(joined: Column) -> Column:
    """Text of an element from its decoded text nodes: each node stripped, then concatenated."""
    return F.array_join(F.transform(F.split(joined, NODE_BREAK), strip), "")
