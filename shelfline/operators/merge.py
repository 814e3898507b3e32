"""Merging detail records into the products found on listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import fingerprint
from ..session import narrow
from .validate import first_wins


def first_per_address(products: DataFrame) -> DataFrame:
    """Key and description of the earliest product at each address; one row per address."""
    first = Window.partitionBy("product_url").orderBy("ord")
    slim = products.select("product_url", "fingerprint", "description", "ord")
    ranked = slim.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1")
    return ranked.select(
        "product_url", F.col("fingerprint").alias("stored_key"), F.col("description").alias("stored_description")
    )


def match_details(details: DataFrame, products: DataFrame) -> DataFrame:
    """Details next to the stored product at their address, if any; products hold an address once here."""
    near = narrow(products, details.select("product_url"))
    return details.join(first_per_address(near), "product_url", "left")


def patches(matched: DataFrame) -> DataFrame:
    """Description and specifications to write, by fingerprint: detail has a description, the product none."""
    wanted = F.col("stored_key").isNotNull() & (F.col("description") != "") & (
        F.col("stored_description").isNull() | (F.col("stored_description") == "")
    )
    found = matched.filter(wanted).select(
        F.col("stored_key").alias("fingerprint"), "ord", F.col("description").alias("new_description"), F.col("specifications").alias("new_specifications")
    )
    # The earliest detail of a key; a key is patched once.
    ranked = found.withColumn("_rank", F.row_number().over(Window.partitionBy("fingerprint").orderBy("ord")))
    return ranked.filter("_rank = 1").select("fingerprint", "new_description", "new_specifications")


def apply_patches(products: DataFrame, changes: DataFrame) -> DataFrame:
    """Products with the changes written in; specifications follow even when empty."""
    joined = products.join(changes, "fingerprint", "left")
    hit = F.col("new_description").isNotNull()
    return joined.withColumns(
        {
            "description": F.when(hit, F.col("new_description")).otherwise(F.col("description")),
            "specifications": F.when(hit, F.col("new_specifications")).otherwise(F.col("specifications")),
        }
    ).select(*products.columns)


def inserts(matched: DataFrame, columns: list[str]) -> DataFrame:
    """Details at an address no product has, as they are (neither validated nor normalised), once per key."""
    fresh = matched.filter(F.col("stored_key").isNull())
    keyed = fresh.withColumn("fingerprint", fingerprint(F.col("product_url"), F.col("sku")))
    return first_wins(keyed).select(*columns)


def merge_details(products: DataFrame, details: DataFrame) -> DataFrame:
    """Enriched products plus the detail-only inserts."""
    matched = match_details(details, products)
    return apply_patches(products, patches(matched)).unionByName(inserts(matched, products.columns))
