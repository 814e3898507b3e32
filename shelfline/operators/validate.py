"""Validation, normalisation, first-wins dedup and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import fingerprint
from ..functions.text import collapse, decode_entities, strip

MAX_PRICE = 50_000


def drop_reason(product_name: Column, product_url: Column) -> Column:
    """Why a record is dropped, name before address; null when it is kept. Entities are not decoded yet."""
    return F.when(product_name.isNull() | (F.length(strip(product_name)) < 2), "short_name").when(
        product_url.isNull() | (product_url == ""), "no_url"
    )


def clean_sku(sku: Column) -> Column:
    return F.upper(strip(sku))


def normal_availability(value: Column) -> Column:
    """Known stock words to their label; anything else unchanged, not even trimmed."""
    word = F.lower(value)
    return (
        F.when(F.contains(word, F.lit("instock")) | F.contains(word, F.lit("in stock")), "In Stock")
        .when(F.contains(word, F.lit("outofstock")) | F.contains(word, F.lit("out of stock")), "Out of Stock")
        .when(F.contains(word, F.lit("preorder")), "Pre-Order")
        .otherwise(value)
    )


def sane_price(price: Column) -> Column:
    """Null below 0 or above the limit. NaN stays: Spark orders it above every number, the rule does not."""
    return F.when((price < 0) | ((price > MAX_PRICE) & ~F.isnan(price)), F.lit(None)).otherwise(price)


def clean_text(df: DataFrame, *columns: str) -> DataFrame:
    """Decode entities, collapse whitespace and strip the named columns; one decoder call per row."""
    decoded = df.withColumn("_texts", decode_entities(F.array(*columns)))
    cleaned = {c: collapse(F.get("_texts", F.lit(i))) for i, c in enumerate(columns)}
    return decoded.withColumns(cleaned).drop("_texts")


def tag(raw: DataFrame) -> DataFrame:
    """Add ``drop_reason``, and the ``fingerprint`` of the kept rows with their sku in final form."""
    return raw.withColumns(
        {"drop_reason": drop_reason(F.col("product_name"), F.col("product_url")), "sku": clean_sku(F.col("sku"))}
    ).withColumn(
        "fingerprint", F.when(F.col("drop_reason").isNull(), fingerprint(F.col("product_url"), F.col("sku")))
    )


def rejects(raw: DataFrame) -> DataFrame:
    """Dropped records with their reason."""
    reason = drop_reason(F.col("product_name"), F.col("product_url"))
    return raw.withColumn("drop_reason", reason).filter(F.col("drop_reason").isNotNull())


def first_wins(products: DataFrame) -> DataFrame:
    """One row per fingerprint, the earliest by ``ord``.

    Every map task keeps only its own first row per key before the shuffle, so a hot fingerprint arrives as
    one row per task.
    """
    first = Window.partitionBy("fingerprint").orderBy("ord")
    return products.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def normalize(products: DataFrame) -> DataFrame:
    """Clean the text fields, availability, images and price of kept records."""
    fixed = products.withColumns(
        {
            "availability": normal_availability(F.col("availability")),
            "image_urls": F.array_distinct("image_urls"),
            "price": sane_price(F.col("price")),
        }
    )
    return clean_text(fixed, "product_name", "brand", "description")


def validate(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Valid, normalised, deduplicated products; ``seen`` takes the counts ``total`` and ``dropped`` on the way.

    The key needs only address and sku, so duplicates go before any text is decoded.
    """
    tagged = tag(raw)
    if seen is not None:
        tagged = tagged.observe(seen, F.count(F.lit(1)).alias("total"), F.count("drop_reason").alias("dropped"))
    kept = tagged.filter(F.col("drop_reason").isNull()).drop("drop_reason")
    return normalize(first_wins(kept))


def stats_of(spark: SparkSession, total: int, valid: int, dropped: int) -> DataFrame:
    """The counters as one row, from counts that were observed."""
    return spark.createDataFrame([(total, valid, total - valid - dropped, dropped)], "total bigint, valid bigint, duplicates bigint, dropped bigint")


def validation_stats(raw: DataFrame) -> DataFrame:
    """One row ``total, valid, duplicates, dropped``; duplicates combine before the shuffle."""
    tagged = tag(raw.select("product_name", "product_url", "sku"))
    per_key = tagged.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    is_key = F.col("fingerprint").isNotNull()
    total, valid = F.sum("n"), F.count_if(is_key)
    dropped = F.sum(F.when(~is_key, F.col("n")))
    counts = per_key.agg(
        F.coalesce(total, F.lit(0)).alias("total"), valid.alias("valid"), F.coalesce(dropped, F.lit(0)).alias("dropped")
    )
    return counts.select("total", "valid", (F.col("total") - F.col("valid") - F.col("dropped")).alias("duplicates"), "dropped")


def summary(stats: DataFrame) -> DataFrame:
    """The counters as one line of text."""
    line = F.format_string(
        "Validation: %d total, %d valid, %d duplicates, %d dropped", "total", "valid", "duplicates", "dropped"
    )
    return stats.select(line.alias("summary"))
