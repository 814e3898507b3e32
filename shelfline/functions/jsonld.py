"""JSON-LD columns on variants, with the truthiness and defaults of the product rules.

Fields of an unexpected type become null or the field's default; a number stands for its text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .numbers import parse_float, parse_int
from .text import blank_to_null, strip

_END = "end-of-script"
#: Largest document that a variant holds.
VARIANT_BYTES = 128 << 20
# The number words that JSON lacks but common writers emit.
_BARE = r"(NaN|-?Infinity)"
_STRINGS = r"""(?s)"(?:[^"\\]++|\\.)*+"|[^"]++|\""""


def node(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def items(value: Column, path: str = "$") -> Column:
    """Elements of an array, or null for any other type."""
    return F.try_variant_get(value, path, "array<variant>")


def _string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    """Type name of a small node; null when absent, ``VOID`` for a JSON null."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.startswith(kind(value), F.lit("OBJECT"))


def text(value: Column) -> Column:
    """A string as it is, a number as its text, anything else null."""
    return F.when(kind(value).rlike(r"\A(?:STRING|BIGINT|DOUBLE|FLOAT|DECIMAL)"), _string(value))


def number(value: Column) -> Column:
    return F.when(kind(value) == "STRING", parse_float(_string(value))).otherwise(F.try_variant_get(value, "$", "double"))


def integer(value: Column) -> Column:
    return F.when(kind(value) == "STRING", parse_int(_string(value))).otherwise(F.try_variant_get(value, "$", "bigint"))


def has_type(block: Column, *names: str) -> Column:
    """True when ``@type`` is exactly one of the names (lists of types do not count)."""
    return F.coalesce(F.try_variant_get(block, '$["@type"]', "string").isin(*names), F.lit(False))


def may_hold(script: Column, word: str) -> Column:
    """Cheap test before parsing: the word, or an escape that could spell it."""
    return F.contains(script, F.lit(word)) | F.contains(script, F.lit("\\u"))


def _strict(script: Column) -> Column:
    """The parser alone accepts text after the document. Closing the script into a two-element array with a
    known last element leaves one reading.
    """
    wrapped = items(F.try_parse_json(F.concat(F.lit("["), script, F.lit(f', "{_END}"]'))))
    return let(
        wrapped, lambda w: F.when((F.size(w) == 2) & (_string(F.get(w, F.lit(1))) == _END), F.get(w, F.lit(0)))
    )


def document(script: Column) -> Column:
    """The JSON document of a script; null when it is not exactly one.

    A script that does not parse but has bare ``NaN`` or ``Infinity`` outside its strings is read again with them as
    strings, which number rules turn back into the values.
    """

    def quote(part: Column) -> Column:
        return F.when(F.startswith(part, F.lit('"')), part).otherwise(F.regexp_replace(part, _BARE, '"$1"'))

    quoted = F.array_join(F.transform(F.regexp_extract_all(script, F.lit(_STRINGS), F.lit(0)), quote), "")
    return F.coalesce(_strict(script), F.when(script.rlike(_BARE), _strict(quoted)))


def blocks(script: Column) -> Column:
    """Top-level blocks of one script: the elements of an array, or the document itself."""
    return let(document(script), lambda top: F.coalesce(items(top), F.when(top.isNotNull(), F.array(top))))


def offer(item: Column) -> Column:
    """The offer object: the first of a list, or the object itself."""
    return F.coalesce(node(item, "$.offers[0]"), node(item, "$.offers"))


def price(offer_node: Column) -> Column:
    return number(node(offer_node, "$.price"))


def currency(offer_node: Column) -> Column:
    return F.coalesce(text(node(offer_node, "$.priceCurrency")), F.lit("USD"))


def availability(offer_node: Column) -> Column:
    return F.substring_index(blank_to_null(text(node(offer_node, "$.availability"))), "/", -1)


def images(image_node: Column) -> Column:
    """Image URLs without their query part."""

    def one(value: Column) -> Column:
        return F.when(kind(value) == "STRING", _string(value)).when(is_object(value), text(node(value, "$.url")))

    several = F.transform(items(image_node), one)
    single = F.when(image_node.isNotNull(), F.array(one(image_node)))
    found = F.filter(F.coalesce(several, single, F.array().cast("array<string>")), lambda u: u.isNotNull())
    return F.transform(found, lambda u: F.substring_index(u, "?", 1))


def _has_rating(rating_node: Column) -> Column:
    return is_object(rating_node) & (kind(rating_node) != "OBJECT<>")


def rating(rating_node: Column) -> Column:
    value = node(rating_node, "$.ratingValue")
    return F.when(_has_rating(rating_node), F.when(value.isNull(), F.lit(0.0)).otherwise(number(value)))


def review_count(rating_node: Column) -> Column:
    value = node(rating_node, "$.reviewCount")
    parsed = F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(integer(value))
    return F.when(rating(rating_node).isNotNull(), parsed)


def brand(brand_node: Column) -> Column:
    """Name of an object, a non-empty string, or the JSON text of any other truthy value."""
    as_text = _string(brand_node)
    falsy = (as_text == "[]") | F.coalesce(F.try_variant_get(brand_node, "$", "double") == 0, F.lit(False))
    return (
        F.when(is_object(brand_node), text(node(brand_node, "$.name")))
        .when(kind(brand_node) == "STRING", blank_to_null(as_text))
        .when(~falsy, as_text)
    )


def product_name(item: Column) -> Column:
    return strip(F.coalesce(text(node(item, "$.name")), F.lit("")))
