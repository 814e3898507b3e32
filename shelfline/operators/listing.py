"""Listing extraction: JSON-LD scripts, blocks, item lists, elements, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonld, markup
from ..schemas import PRODUCT_TYPES, default
from .rows import explode_rows


def jsonld_scripts(pages: DataFrame, word: str | None = None) -> DataFrame:
    """Compact page rows: every column but ``html``, plus ``scripts`` (those that may hold ``word``)."""
    scripts = markup.ld_scripts(F.col("html"))
    if word:
        scripts = F.filter(scripts, lambda s: jsonld.may_hold(s, word))
    return pages.withColumn("scripts", scripts).drop("html")


def jsonld_blocks(scripted: DataFrame) -> DataFrame:
    """``script_pos, block_pos, block`` for each well-formed script; a malformed one is skipped alone."""
    rows = explode_rows(scripted, F.col("scripts"), "script_pos", "script").drop("scripts")
    return explode_rows(rows, jsonld.blocks(F.col("script")), "block_pos", "block").drop("script")


def script_rejects(pages: DataFrame) -> DataFrame:
    """Scripts that are not one JSON document, as ``page_url, script_pos, bytes, reason``; their products are not read."""
    return bad_scripts(jsonld_scripts(pages.select("page_url", "html")))


def bad_scripts(scripted: DataFrame) -> DataFrame:
    """The same among the scripts of compact rows ``page_url, scripts``."""
    rows = explode_rows(scripted.select("page_url", "scripts"), F.col("scripts"), "script_pos", "script").drop("scripts")
    size = F.octet_length("script")
    reason = F.when(F.trim("script") == "", "empty").when(size > jsonld.VARIANT_BYTES, "larger than a variant").otherwise("not JSON")
    return rows.filter(jsonld.document(F.col("script")).isNull()).select("page_url", "script_pos", size.alias("bytes"), reason.alias("reason"))


def jsonld_itemlists(blocks: DataFrame) -> DataFrame:
    return blocks.filter(jsonld.has_type(F.col("block"), "ItemList"))


def listing_elements(itemlists: DataFrame) -> DataFrame:
    """``elem_pos, element`` of each item list."""
    return explode_rows(itemlists, jsonld.items(F.col("block"), "$.itemListElement"), "elem_pos", "element").drop("block")


def product_columns(item: Column, offer: Column, rating: Column) -> dict[str, Column]:
    """Typed product fields of one JSON-LD Product."""
    return {
        "product_name": jsonld.product_name(item),
        "brand": jsonld.brand(jsonld.node(item, "$.brand")),
        "sku": jsonld.text(jsonld.node(item, "$.sku")),
        "price": jsonld.price(offer),
        "currency": jsonld.currency(offer),
        "availability": jsonld.availability(offer),
        "description": F.nullif(jsonld.text(jsonld.node(item, "$.description")), F.lit("")),
        "image_urls": jsonld.images(jsonld.node(item, "$.image")),
        "rating": jsonld.rating(rating),
        "review_count": jsonld.review_count(rating),
    }


def raw_products(elements: DataFrame) -> DataFrame:
    """Products among the elements, before validation; unnamed ones give no row.

    ``elements`` brings ``category_path`` and ``ord`` (the page's place in the run); the element's own place
    is appended to ``ord``. Only typed columns leave, so later shuffles carry no JSON.
    """
    typed = elements.withColumn("_item", jsonld.node(F.col("element"), "$.item"))
    typed = typed.filter(jsonld.has_type(F.col("_item"), "Product"))
    typed = typed.withColumns(
        {"_offer": jsonld.offer(F.col("_item")), "_rating": jsonld.node(F.col("_item"), "$.aggregateRating")}
    )
    columns = product_columns(F.col("_item"), F.col("_offer"), F.col("_rating"))
    columns["product_url"] = F.coalesce(jsonld.text(jsonld.node(F.col("element"), "$.url")), F.lit(""))
    columns["category_path"] = F.col("category_path")
    place = F.array(*[F.col(c).cast("bigint") for c in ("script_pos", "block_pos", "elem_pos")])
    rows = typed.select(
        "page_url",
        *[columns.get(name, default(name)).alias(name) for name in PRODUCT_TYPES if name not in ("fingerprint", "scraped_at")],
        F.concat("ord", place).alias("ord"),
    )
    return rows.filter(F.col("product_name") != "")


def extract_scripts(scripted: DataFrame) -> DataFrame:
    """Raw products of compact page rows ``page_url, category_path, ord, scripts``."""
    return raw_products(listing_elements(jsonld_itemlists(jsonld_blocks(scripted))))


def extract_listing(pages: DataFrame) -> DataFrame:
    """Raw products of listing pages ``page_url, html, category_path, ord``; no shuffle."""
    return extract_scripts(jsonld_scripts(pages, "ItemList"))
