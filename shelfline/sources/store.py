"""Stored products and visits as append-only Parquet tables.

Products are never changed in place: enrichment from detail pages is a second append-only table that
readers apply by fingerprint.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.merge import apply_patches
from ..operators.validate import first_wins
from ..schemas import VISITED, product_ddl
from ..session import materialize, narrow
from .log import FOLD_EVERY, PageLog
from .snapshots import VERSION

#: Listings and details that were not readable, details no rule could read, products that were dropped, scripts that are not JSON;
#: for the pages also what a replay needs to put them in their place.
QUARANTINE = "key string, kind string, url string, reason string, category_path string, seed_ord bigint, sub_pos bigint, is_category boolean, ord array<bigint>, batch bigint"
PATCH_DDL = "fingerprint string, new_description string, new_specifications map<string,string>, batch bigint"


def new_products(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose fingerprint is not stored yet, the first of each; stored rows stay as they are.

    A small batch against a large store costs one scan of the key column and no shuffle of it.
    """
    known = narrow(stored.select("fingerprint"), batch.select("fingerprint"))
    return first_wins(batch.join(known, "fingerprint", "left_anti"))


def insert_new(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The table after the insert."""
    return stored.unionByName(new_products(batch, stored))


def product_count(products: DataFrame) -> DataFrame:
    return products.agg(F.count(F.lit(1)).alias("products"))


def mark_visited(visited: DataFrame, urls: DataFrame, created_at) -> DataFrame:
    """Visits plus one mark for each address not marked yet."""
    fresh = urls.select("url").distinct().join(visited.select("url"), "url", "left_anti")
    stamped = fresh.select("url", F.lit("visited").alias("status"), F.lit(created_at).cast("timestamp").alias("created_at"))
    return visited.unionByName(stamped)


def number_rows(products: DataFrame, *order: str) -> DataFrame:
    """Add a dense 1-based ``id`` in insertion order.

    A range shuffle sorts the rows; each partition numbers its own and adds the count of those before it.
    The sorted rows are written once, so both passes see the same partitions, and the offsets (one row per
    partition) are all that is broadcast. No window runs over the whole table.
    """
    order = order or ("ord",)
    spark = products.sparkSession
    # Written first: finding the ranges reads the rows once more.
    sorted_rows = materialize(products, "unordered").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, offset_in = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    before, starts = 0, []
    for row in sizes:
        starts.append((row["_part"], before))
        before += row["n"]
    offsets = spark.createDataFrame(starts, "_part bigint, _before bigint")
    keyed = placed.withColumns({"_part": part, "_in": offset_in})
    return (
        keyed.join(F.broadcast(offsets), "_part")
        .withColumn("id", F.col("_before") + F.col("_in") + 1)
        .drop("_at", "_part", "_in", "_before")
    )


class Store:
    """Product, patch and visit tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = PageLog(spark, self.path("pages"), {"listed": f"{product_ddl()}, listed_in bigint"})
        """Products of the ingested pages."""

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _read(self, name: str, ddl) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def stored(self) -> DataFrame:
        """Products as inserted, with their ``batch``, and those that the newest snapshots of the ingested pages list."""
        inserted, listed = self._read("products", product_ddl() + ", batch bigint"), self.listed()
        if listed is None:
            return inserted
        return inserted.unionByName(listed.join(inserted.select("fingerprint"), "fingerprint", "left_anti"))

    def listed(self) -> DataFrame | None:
        """Products of the ingested pages, or None without any.

        Only the newest snapshot of an address counts, whichever batch brought it; a failed one takes its address out.
        Of pages that list one product the address decides, as within a batch, so the way into batches changes nothing.
        """
        if not self.log.holds_any():
            return None
        current = self.log.live("listed").withColumnRenamed("listed_in", "batch").drop("url", *VERSION)
        first = Window.partitionBy("fingerprint").orderBy(F.slice("ord", 2, 8), "ord")
        return current.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")

    def list_pages(self, rows: DataFrame, versions: DataFrame, batch: int, name: str, fold_every: int = FOLD_EVERY) -> None:
        """Append the products of a batch of pages and the newest version of each page; ``name`` tells a replay."""
        numbered = rows.withColumn("listed_in", F.lit(batch).cast("bigint")).withColumnRenamed("page_url", "url")
        self.log.append(name, {"listed": numbered}, versions)
        if len(self.log.batches()) >= fold_every:
            self.log.fold()

    def patches(self) -> DataFrame:
        return self._read("patches", PATCH_DDL)

    def products(self) -> DataFrame:
        """Products with their enrichment; the earliest patch of a key counts."""
        changes = self.patches().groupBy("fingerprint").agg(
            F.min_by(F.struct("new_description", "new_specifications"), "batch").alias("p")
        )
        return apply_patches(self.stored(), changes.select("fingerprint", "p.*"))

    def visited(self) -> DataFrame:
        return self._read("visited", VISITED)

    def quarantined(self) -> DataFrame:
        """What a run could not use and no replay has released since, one row per key."""
        return self._read("quarantine", QUARANTINE).join(self._read("released", "key string, batch bigint").select("key"), "key", "left_anti")

    def set_aside(self, rows: DataFrame, batch: int) -> None:
        """Append rows of ``QUARANTINE`` that are not stored yet, released or not."""
        fresh = rows.join(self._read("quarantine", QUARANTINE).select("key"), "key", "left_anti").dropDuplicates(["key"])
        fresh.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(self.path("quarantine"))

    def release(self, keys: DataFrame, batch: int) -> None:
        keys.select("key").distinct().withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(self.path("released"))

    def ordered(self) -> DataFrame:
        """All products with their dense id in insertion order."""
        return number_rows(self.products(), "batch", "ord").drop("batch", "ord")

    def append(self, new: DataFrame, batch: int) -> None:
        """Append rows already known to be new."""
        new.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(
            self.path("products")
        )

    def insert(self, batch_rows: DataFrame, batch: int) -> int:
        """Insert-if-absent; returns the number of new rows, counted by the write itself."""
        observed = Observation("inserted")
        new = new_products(materialize(batch_rows, "batch"), self.stored())
        new = new.observe(observed, F.count(F.lit(1)).alias("n"))
        self.append(new, batch)
        return observed.get["n"]

    def append_patches(self, changes: DataFrame, batch: int) -> None:
        changes.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(
            self.path("patches")
        )

    def mark(self, urls: DataFrame, created_at) -> None:
        """Mark addresses as visited; known ones are ignored."""
        fresh = urls.select("url").distinct().join(self.visited().select("url"), "url", "left_anti")
        fresh.select(
            "url", F.lit("visited").alias("status"), F.lit(created_at).cast("timestamp").alias("created_at")
        ).write.mode("append").parquet(self.path("visited"))
