"""Headline timings over one scale folder; prints one JSON line.

The sample shop is rendered to Parquet first (not timed), so the queries read page snapshots from disk as a
crawl would hand them over. Each query runs once to warm up and once timed, into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators import classify, detail, frontier, listing, reports, validate
from shelfline.plans import jobs
from shelfline.registry.queries import as_details, as_listings
from shelfline.samples import catalog
from shelfline.session import configure
from shelfline.sources import store

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("shelfline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def render(spark: SparkSession, scratch: str) -> tuple[DataFrame, DataFrame]:
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    catalog.shop_pages(part).repartition(int(CPUS) * 2).write.parquet(f"{scratch}/shop")
    catalog.seeds(part).write.parquet(f"{scratch}/seeds")
    return spark.read.parquet(f"{scratch}/shop"), spark.read.parquet(f"{scratch}/seeds")


def main() -> None:
    spark = session()
    shop, seeds = render(spark, tempfile.mkdtemp(prefix="shelfline-bench-"))
    base = catalog.BASE
    web = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", F.lit(200).alias("status"), "html")
    web = web.repartition(int(CPUS) * 2)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    start = frontier.seed_frontier(seeds, base)
    listings = as_listings(shop.filter(F.contains("url", F.lit("/catalog/"))))
    details = as_details(shop.filter(F.contains("url", F.lit("/product/")) & (F.col("status") == 200)))

    def full() -> DataFrame:
        return jobs.full_run(shop, seeds, base, catalog.FETCHED).products

    runs = {
        "classify_page": lambda: classify.classify(shop.select("url", "html").unionByName(web.select("url", "html"))),
        "page_links": lambda: frontier.page_links(web, base),
        "listing_frontier": lambda: frontier.listing_frontier(start, shop, base),
        "pagination_urls": lambda: frontier.pagination_urls(shop.select("url", "html")),
        "extract_listing": lambda: listing.extract_listing(listings),
        "validate_products": lambda: validate.validate(listing.extract_listing(listings)),
        "validation_stats": lambda: validate.validation_stats(listing.extract_listing(listings)),
        "extract_detail": lambda: detail.extract_detail(details.unionByName(as_details(web))),
        "clean_text": lambda: validate.clean_text(documents.select("doc_id", "text"), "text"),
        "field_coverage": lambda: reports.field_coverage(validate.validate(listing.extract_listing(listings))),
        "products_ordered": lambda: store.number_rows(validate.validate(listing.extract_listing(listings))),
        "full_run": full,
    }
    chosen = sys.argv[1:] or list(runs)
    seconds = {}
    for name in chosen:
        for _ in range(2):
            begin = time.perf_counter()
            runs[name]().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    pages = shop.count()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "pages": pages,
    }
    if "full_run" in seconds:
        result["pages_per_sec"] = round(pages / seconds["full_run"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
