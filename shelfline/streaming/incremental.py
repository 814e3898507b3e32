"""Runs over a growing folder of page snapshots: the products of listings alone, or the whole shop with its details.

Both keep what was read off the pages in a log by snapshot, so the order and size of micro-batches change nothing, a replay adds
nothing, and the cost of a read follows the live pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import frontier as links
from ..operators import validate
from ..operators.listing import extract_scripts, jsonld_scripts
from ..plans.facts import StoredReader, newest_rows
from ..plans.jobs import RunResult, page_facts, run_over, stamp
from ..schemas import PAGES
from ..session import configure, deal, materialize, scratch_scope
from ..sources.log import FOLD_EVERY, PageLog, newest_versions
from ..sources.snapshots import VERSION, newest_readable, ok_pages, with_version
from ..sources.store import Store

#: Pages of a batch that one task reads for all kinds of facts.
PAGES_EACH = 10_000


def _raw(pages: DataFrame, batch: int, frontier: DataFrame | None) -> DataFrame:
    scripted = jsonld_scripts(with_version(ok_pages(pages)).select("url", "html", *VERSION), "ItemList")
    ok = newest_readable(scripted, pages).withColumn("page_url", F.col("url"))
    place = F.array(F.lit(batch).cast("bigint"))
    rows = extract_scripts(ok.withColumns({"category_path": F.lit(""), "ord": place}))
    if frontier is not None:
        labels = frontier.select(F.col("url").alias("page_url"), F.col("category_path").alias("_label"))
        rows = rows.join(labels, "page_url", "left").withColumn("category_path", F.coalesce("_label", F.lit(""))).drop("_label")
    # Pages of a batch have no crawl order: their address breaks ties, by a stable 64-bit hash.
    return rows.withColumn(
        "ord", F.concat(F.slice("ord", 1, 1), F.array(F.xxhash64("page_url")), F.slice("ord", 2, 3))
    )


def batch_products(pages: DataFrame, scraped_at, batch: int, frontier: DataFrame | None = None) -> DataFrame:
    """Valid products of one batch of pages, ordered by batch, page address and place on the page.

    ``frontier(url, category_path)`` labels the pages; without it the label stays empty.
    """
    return stamp(validate.validate(_raw(pages, batch, frontier)), scraped_at)


def page_versions(pages: DataFrame) -> DataFrame:
    """``url`` with the fetch time, status and body hash of its newest snapshot in ``pages``."""
    return newest_versions(with_version(pages))


def page_products(pages: DataFrame, versions: DataFrame, scraped_at, batch: int, frontier: DataFrame | None = None) -> DataFrame:
    """As ``batch_products``, but the first of each product on each page, with the page's address and version."""
    kept = validate.tag(_raw(pages, batch, frontier)).filter(F.col("drop_reason").isNull()).drop("drop_reason")
    first = Window.partitionBy("page_url", "fingerprint").orderBy("ord")
    kept = kept.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    stamped = stamp(validate.normalize(kept), scraped_at, "page_url")
    return stamped.join(versions.withColumnRenamed("url", "page_url"), "page_url")


def ingest(
    spark: SparkSession, source: str, store: Store, checkpoint: str, scraped_at, frontier: DataFrame | None = None,
    first_batch: int = 0, max_files: int = 1000, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Read every page file not seen yet, at most ``max_files`` to a batch, keep the products of the newest snapshots, then stop.

    The checkpoint folder remembers the files. The store keeps the products of each page with its version and reads
    those of the newest version of an address, so the order and size of batches change nothing and a replay adds nothing.
    """
    configure(spark)

    def insert(pages: DataFrame, epoch: int) -> None:
        batch = first_batch + epoch
        with scratch_scope(spark):
            versions = materialize(page_versions(pages), "versions")
            store.list_pages(page_products(pages, versions, scraped_at, batch, frontier), versions, batch, batch_name(pages, checkpoint, epoch), fold_every)

    return _start(spark, source, checkpoint, insert, max_files)


def batch_name(pages: DataFrame, checkpoint: str, epoch: int) -> str:
    """The name of a micro-batch, the same when it is replayed: the id of the query that the checkpoint folder keeps, and the epoch."""
    query = pages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or checkpoint}-{epoch}"


def _start(spark: SparkSession, source: str, checkpoint: str, insert: Callable[[DataFrame, int], None], max_files: int) -> StreamingQuery:
    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        stream.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batch(pages: DataFrame, start: DataFrame, base: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Facts of all kinds and page versions of one batch, in one pass over the readable bodies.

    A detail page may come before the listing that leads to it, so every page is read for all kinds; only pages of
    ``start`` are searched for subcategories. The few files of a batch give fewer tasks than its pages need, so a large
    batch is dealt out first, bodies and all.
    """
    read = materialize(newest_rows(page_facts(deal(pages, pages.count(), PAGES_EACH), start, base)), "batch-facts")
    # A page without a rule for its type waits for a model's answer.
    read = read.withColumn("page_type", F.nullif("page_type", F.lit("unknown")))
    failed = with_version(pages.filter(F.coalesce(F.col("status") != 200, F.lit(True))))
    versions = newest_versions(read.select("url", *VERSION).unionByName(failed.select("url", *VERSION)))
    return {"links": read.filter("hits is not null"), "listing": read, "detail": read}, versions


def ingest_shop(
    spark: SparkSession, source: str, log: PageLog, checkpoint: str, seeds: DataFrame, base: str,
    max_files: int = 1000, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Read every page file not seen yet, at most ``max_files`` to a batch, into the log of facts, then stop.

    Which pages are listings and details follows from the log as a whole (:func:`shop_run`), so categories, listings and details
    may arrive in any order, and a page that is fetched again replaces what its older snapshot said.
    """
    configure(spark)
    start = links.seed_frontier(seeds, base)

    def insert(pages: DataFrame, epoch: int) -> None:
        with scratch_scope(spark):
            rows, versions = read_batch(pages, start, base)
            log.append(batch_name(pages, checkpoint, epoch), rows, versions)
        if len(log.batches()) >= fold_every:
            log.fold()

    return _start(spark, source, checkpoint, insert, max_files)


def shop_run(log: PageLog, seeds: DataFrame, base: str, scraped_at, **options) -> RunResult:
    """The run over all pages ingested so far: frontier, listings, details and merge, from facts alone."""
    return run_over(StoredReader(log), seeds, base, scraped_at, **options)
