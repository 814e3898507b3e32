"""Table schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The closed set of page types.
PAGE_TYPES = ("category", "listing", "product", "unknown")

PAGES = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("status", T.IntegerType(), False),
        T.StructField("html", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

VISITED = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Product columns in export order, without the table id.
PRODUCT_TYPES = {
    "fingerprint": "string",
    "product_name": "string",
    "brand": "string",
    "sku": "string",
    "category_path": "string",
    "product_url": "string",
    "price": "double",
    "currency": "string",
    "unit_pack_size": "string",
    "availability": "string",
    "description": "string",
    "specifications": "map<string,string>",
    "image_urls": "array<string>",
    "alternative_products": "array<string>",
    "rating": "double",
    "review_count": "bigint",
    "scraped_at": "timestamp",
}
NESTED = ("specifications", "image_urls", "alternative_products")

# ``ord`` reproduces crawl order: phase, seed, subcategory, script, block, element.


def product_ddl(with_order: bool = True) -> str:
    """DDL text of the product table."""
    columns = [f"{name} {kind}" for name, kind in PRODUCT_TYPES.items()]
    return ", ".join(columns + (["ord array<bigint>"] if with_order else []))


def default(name: str) -> Column:
    """Typed default of one product column."""
    kind = PRODUCT_TYPES[name]
    if name == "currency":
        return F.lit("USD")
    if name == "category_path":
        return F.lit("")
    if kind.startswith("array"):
        return F.array().cast(kind)
    if kind.startswith("map"):
        return F.create_map().cast(kind)
    return F.lit(None).cast(kind)
