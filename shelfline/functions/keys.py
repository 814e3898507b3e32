"""Record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(product_url: Column, sku: Column) -> Column:
    """md5 of ``url|sku``; a null sku leaves the separator in place, which ``concat_ws`` would drop."""
    return F.md5(F.concat(product_url, F.lit("|"), F.coalesce(sku, F.lit(""))))
