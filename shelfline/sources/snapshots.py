"""Page snapshot tables. An address may be fetched again and again; its newest snapshot counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import PAGES
from ..session import is_small, materialize, narrow


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot table from Parquet with the fixed schema."""
    return spark.read.schema(PAGES).parquet(path)


VERSION = ["fetched_at", "status", "body_hash"]


def with_version(pages: DataFrame) -> DataFrame:
    """Pages with the columns that tell snapshots of an address apart: fetch time (null if unknown), status, body hash."""
    time = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None).cast("timestamp")
    status = F.col("status") if "status" in pages.columns else F.lit(200)
    body = F.xxhash64("html") if "html" in pages.columns else F.lit(0).cast("bigint")
    return pages.withColumns({"fetched_at": time, "status": status, "body_hash": body})


def newest(rows: DataFrame, address: str = "url") -> DataFrame:
    """One row per address: the latest fetch (unknown times last), then the smallest status and body hash.

    Meant for compact rows that carry ``VERSION``. Each task sends one row of an address, however often it repeats.
    """
    order = [F.col("fetched_at").desc_nulls_last(), F.col("status").asc_nulls_last(), F.col("body_hash")]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(address).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank", "body_hash")


def newest_readable(compact: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows of ``compact`` (readable snapshots, one row each, with ``VERSION``) that are the newest of their address.

    A later snapshot that failed takes its address out, as if the page had not been read.
    """
    failed = with_version(pages.select(*[c for c in ("url", "status", "fetched_at") if c in pages.columns])).filter(_failed())
    kept = newest(compact.unionByName(failed.select("url", *VERSION), allowMissingColumns=True))
    return kept.filter(~_failed()).drop("fetched_at", "status")


def snapshot(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Frontier rows with the status and body of their page; rows without a snapshot are left out.

    The newest snapshots are ranked by keys alone (a body gives its hash where it lies). The winners then go to the bodies: as a
    broadcast where they are proven small, so no body is shuffled at all; else only the winners' bodies are.
    """
    near = with_version(narrow(pages, frontier.select("url")))
    keys = near.groupBy("url", *VERSION).agg(F.count(F.lit(1)).alias("_copies"))
    order = [F.col("fetched_at").desc_nulls_last(), F.col("status").asc_nulls_last(), F.col("body_hash")]
    ranked = keys.withColumn("_rank", F.row_number().over(Window.partitionBy("url").orderBy(*order))).filter("_rank = 1").drop("_rank")
    winners = materialize(frontier.join(ranked, "url"), "winners")
    hint = F.broadcast if is_small(winners) else (lambda df: df)
    left, right = near.select("url", "html", *VERSION).alias("p"), hint(winners).alias("w")
    same = [F.col("p.url") == F.col("w.url"), *[F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in VERSION]]
    met = left.join(right, same).select(*[F.col(f"w.{c}") for c in frontier.columns], "w.status", "p.html", "_copies")
    # The same snapshot may be stored many times; only then do equal rows meet to leave one.
    if not winners.filter("_copies > 1").limit(1).collect():
        return met.drop("_copies")
    once, often = met.filter("_copies = 1"), met.filter("_copies > 1")
    return once.unionByName(often.dropDuplicates()).drop("_copies")


def ok_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("status") == 200)


def _failed():
    return F.coalesce(F.col("status") != 200, F.lit(True))


def _statuses(pages: DataFrame) -> DataFrame:
    """Address and status of the newest snapshots; no body is read."""
    return newest(with_version(pages.select(*[c for c in ("url", "status", "fetched_at") if c in pages.columns]))).select("url", "status")


def failed_pages(pages: DataFrame) -> DataFrame:
    """Audit of the addresses whose newest snapshot failed."""
    return _statuses(pages).filter(_failed())


def status_split(pages: DataFrame) -> DataFrame:
    """``url, status, outcome`` for every address: read or skipped."""
    ok = F.coalesce(F.col("status") == 200, F.lit(False))
    return _statuses(pages).select("url", "status", F.when(ok, "read").otherwise("skipped").alias("outcome"))
