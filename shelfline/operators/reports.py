"""Run reports: products per category and field coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of the published coverage report.
COVERAGE_FIELDS = ("price", "image_urls", "sku", "rating", "description")


def category_report(products: DataFrame) -> DataFrame:
    """Products and distinct subcategories per top category.

    Counts per path combine before the shuffle, so a hot category costs one row per path and task.
    """
    parts = F.split("category_path", " > ", 2)
    per_path = products.groupBy("category_path").agg(F.count(F.lit(1)).alias("n"))
    return per_path.groupBy(F.get(parts, F.lit(0)).alias("category")).agg(
        F.sum("n").alias("products"), F.count(F.get(parts, F.lit(1))).alias("subcategories")
    )


def filled(products: DataFrame, name: str) -> Column:
    """Count of the rows with a value; empty text and empty arrays are none."""
    kind, col = dict(products.dtypes)[name], F.col(name)
    if kind.startswith(("array", "map")):
        return F.count_if(F.size(col) > 0)
    return F.count_if(col != "") if kind == "string" else F.count(col)


def field_coverage(products: DataFrame, fields: tuple[str, ...] = COVERAGE_FIELDS) -> DataFrame:
    """``field, filled, total, pct`` from one pass; empty text and empty arrays are not filled."""
    counts = products.agg(F.count(F.lit(1)).alias("total"), *[filled(products, f).alias(f) for f in fields])
    long = counts.unpivot("total", list(fields), "field", "filled")
    pct = F.when(F.col("total") > 0, F.round(F.col("filled") * 100.0 / F.col("total"), 2)).otherwise(0.0)
    return long.select("field", "filled", "total", pct.alias("pct"))
