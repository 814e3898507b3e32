"""What a run reads off page bodies: only for the pages that it needs, once per snapshot.

Three kinds of facts are known: ``links`` (subcategories of a seed page), ``listing`` (type, item-list scripts and product addresses of
a listing page) and ``detail`` (the record of a product page). A run asks for a kind and the addresses it wants. Addresses,
times and states of the pages are read without their bodies; facts that a store already holds for a snapshot are taken from
there; only pages that are left are read, and only the rules of the kind run on them.

A body never passes a shuffle: the wanted snapshots come to the pages, as a broadcast where they are proven small, else as a
bitmap of their hashes whose size has a fixed bound. What the bitmap lets through by chance is dropped on compact rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsonld, markup
from ..operators import classify, detail, frontier
from ..session import BROADCAST_BYTES, BROADCAST_ROWS, materialize, narrow
from ..sources.log import PageLog
from ..sources.snapshots import VERSION, newest, ok_pages, with_version

#: Columns of the kinds, beside address and version.
TABLES = {
    "links": f"_prefix string, hits {frontier.HITS}",
    "listing": "page_type string, scripts array<string>, product_urls array<string>",
    "detail": f"record struct<{detail.RECORD}>, extracted_by string",
}
#: Bits of the largest bitmap of snapshots (64 MiB), bits for one snapshot below it, and bits of one of its rows, which Spark fixes.
MOST_BITS, BITS_EACH, ROW_BITS = 1 << 29, 16, 1 << 15
#: Most files that are named to the scan; beyond, all are opened.
MOST_FILES = 5_000


def links_of(pages: DataFrame, base: str) -> DataFrame:
    """Subcategories on pages ``url, html, VERSION``."""
    celled = frontier.with_hit_cells(pages, base).drop("html")
    return frontier.with_hits(celled, base).select("url", "_prefix", "hits", *VERSION)


def listing_of(pages: DataFrame, base: str) -> DataFrame:
    """Type by rule (null without any), item-list scripts and product addresses of pages ``url, html, VERSION``."""
    scripted = pages.withColumn("all_scripts", markup.ld_scripts(F.col("html"))).drop("html")
    page_type = F.coalesce(classify.type_by_url(F.col("url")), classify.type_by_scripts(F.col("all_scripts")))
    kept = F.filter("all_scripts", lambda s: jsonld.may_hold(s, "ItemList"))
    rows = scripted.withColumns({"page_type": page_type, "scripts": kept}).drop("all_scripts")
    found = F.when(F.size("scripts") > 0, frontier.product_links(F.col("scripts")))
    return rows.withColumn("product_urls", found).select("url", "page_type", "scripts", "product_urls", *VERSION)


def detail_of(pages: DataFrame, base: str) -> DataFrame:
    """Record by rule and how it was found, for pages ``url, html, VERSION``."""
    read = detail.read_page(pages.withColumns({"page_url": F.col("url"), "category_path": F.lit("")})).drop("html")
    return detail.resolve_record(read).select("url", "record", "extracted_by", *VERSION)


RULES: dict[str, Callable[[DataFrame, str], DataFrame]] = {"links": links_of, "listing": listing_of, "detail": detail_of}


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file")


def heads(pages: DataFrame) -> DataFrame:
    """Newest snapshot of every address: ``url, fetched_at, status, file``, read without bodies.

    Snapshots of one time and state are told apart by their bodies, later; each of their files gives a row here.
    """
    columns = [F.col(c) for c in ("url", "status", "fetched_at") if c in pages.columns]
    try:
        keys = pages.select(*columns, _file())
    except AnalysisException:  # not straight from files
        keys = pages.select(*columns, F.lit(None).cast("string").alias("file"))
    # A hot address arrives as one row per file and task.
    distinct = with_version(keys).drop("body_hash").distinct()
    order = Window.partitionBy("url").orderBy(F.col("fetched_at").desc_nulls_last(), F.col("status").asc_nulls_last())
    return distinct.withColumn("_rank", F.rank().over(order)).filter("_rank = 1").drop("_rank")


def _hashed(bits: int) -> tuple[Column, Column]:
    """Row and place of a snapshot in a bitmap of so many bits."""
    place = F.pmod(F.xxhash64("url", "fetched_at"), F.lit(bits))
    return F.floor(place / ROW_BITS).cast("int"), (place % ROW_BITS).cast("int")


def possibly_among(pages: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """Pages that may be among the ``n`` snapshots ``keys(url, fetched_at)``, by a broadcast bitmap of bounded size."""
    bits = min(MOST_BITS, max(ROW_BITS, 1 << (BITS_EACH * n - 1).bit_length()))
    row, place = _hashed(bits)
    bitmap = keys.select(row.alias("_row"), place.alias("_place")).groupBy("_row").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    met = pages.withColumns({"_row": row, "_place": place}).join(F.broadcast(bitmap), "_row")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_place", 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, F.col("_place") % 8).bitwiseAND(F.lit(1)) == 1
    return met.filter(hit).drop("_row", "_place", "_bits")


def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the snapshots ``keys(url, fetched_at)``; an unknown time equals an unknown time."""
    left, right = rows.alias("c"), keys.alias("k")
    same = [F.col("c.url") == F.col("k.url"), F.col("c.fetched_at").eqNullSafe(F.col("k.fetched_at"))]
    return left.join(right, same, "left_semi")


class PageReader:
    """Facts of a snapshot table, read on demand; ``known`` holds those of earlier runs."""

    def __init__(self, pages: DataFrame, base: str, known: PageLog | None = None):
        self.pages, self.base, self.known = pages, base, known
        self.heads = materialize(heads(pages), "heads")
        self.fresh: dict[str, DataFrame] = {}
        """Facts read by this run, by kind."""
        self.found: dict[str, DataFrame] = {}
        self.evaluated: dict[str, int] = {}
        """Pages whose bodies the rules of a kind were run on."""

    def failed(self) -> DataFrame:
        """Addresses whose newest snapshot failed, with their status."""
        return self.heads.filter(F.coalesce(F.col("status") != 200, F.lit(True))).select("url", "status").distinct()

    def facts(self, kind: str, wanted: DataFrame) -> DataFrame:
        """Facts of a kind for the readable pages among the addresses ``wanted(url)``, one row per address."""
        need = self.heads.filter("status = 200").join(wanted.select("url").distinct(), "url", "left_semi")
        if self.known is None:
            self.fresh[kind] = self.found[kind] = self._read(kind, need)
            return self.found[kind]
        need = materialize(need, f"need-{kind}")
        stored = narrow(self.known.rows(kind), need.select("url"))
        # A snapshot without a time cannot be told from a later one, so it is read again.
        kept = newest_rows(stored.join(need.select("url", "fetched_at").distinct(), ["url", "fetched_at"], "left_semi"))
        kept = materialize(kept, f"known-{kind}")
        self.fresh[kind] = self._read(kind, need.join(kept.select("url"), "url", "left_anti"))
        self.found[kind] = self.fresh[kind].unionByName(kept.select(*self.fresh[kind].columns))
        return self.found[kind]

    def facts_read(self, kind: str) -> DataFrame:
        """The facts that the run was given."""
        return self.found[kind]

    def _read(self, kind: str, need: DataFrame) -> DataFrame:
        """Facts of the snapshots ``url, fetched_at, file``, written."""
        seen = Observation(f"need-{kind}")
        need = need.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("url")), F.lit(0)).alias("b"))
        need = materialize(need, f"missing-{kind}")
        n, size = seen.get["n"], seen.get["b"]
        pages = with_version(ok_pages(self.pages)).select("url", "html", *VERSION) if n else None
        if not n:
            self.evaluated[kind] = 0
            schema = RULES[kind](with_version(self.pages).select("url", "html", *VERSION), self.base).schema
            return self.pages.sparkSession.createDataFrame([], schema)
        files = [r["file"] for r in need.select("file").distinct().limit(MOST_FILES + 1).collect()]
        if len(files) <= MOST_FILES and None not in files:
            pages = with_version(ok_pages(self.pages.filter(F.col("_metadata.file_path").isin(files)))).select("url", "html", *VERSION)
        keys = need.select("url", "fetched_at").distinct()
        small = n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
        near = among(pages, F.broadcast(keys)) if small else possibly_among(pages, keys, n)
        ran = Observation(f"rules-{kind}")
        compact = RULES[kind](near.observe(ran, F.count(F.lit(1)).alias("n")), self.base)
        written = materialize(newest_rows(compact if small else among(compact, keys)), kind)
        self.evaluated[kind] = ran.get["n"]
        return written

    def save(self, log: PageLog) -> None:
        """Add the facts read by this run to a log."""
        if not any(self.evaluated.values()):
            return
        parts = [frame.select("url", *VERSION) for frame in self.fresh.values()]
        versions = parts[0]
        for part in parts[1:]:
            versions = versions.unionByName(part)
        log.append(f"run-{uuid.uuid4().hex}", dict(self.fresh), versions.distinct())

    def prompts(self, wanted: DataFrame, prompt: Column) -> DataFrame:
        """``url, prompt`` for the pages among ``wanted(url)``; only the text of the prompt leaves a body's task."""
        need = self.heads.filter("status = 200").join(wanted.select("url").distinct(), "url", "left_semi").select("url", "fetched_at").distinct()
        rows = with_version(ok_pages(narrow(self.pages, need.select("url")))).select("url", prompt.alias("prompt"), *VERSION)
        return newest(among(rows, need)).select("url", "prompt")


def newest_rows(rows: DataFrame) -> DataFrame:
    """As ``newest``, with the version kept."""
    order = [F.col("fetched_at").desc_nulls_last(), F.col("status").asc_nulls_last(), F.col("body_hash")]
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy("url").orderBy(*order))).filter("_rank = 1").drop("_rank")


class StoredReader:
    """Facts of a log alone, for a stream whose bodies were read as they arrived."""

    def __init__(self, log: PageLog):
        self.log = log
        self.found: dict[str, DataFrame] = {}
        self.evaluated: dict[str, int] = {}

    def failed(self) -> DataFrame:
        return self.log.versions().filter(F.coalesce(F.col("status") != 200, F.lit(True))).select("url", "status")

    def facts(self, kind: str, wanted: DataFrame) -> DataFrame:
        near = narrow(self.log.live(kind), wanted.select("url")).join(wanted.select("url").distinct(), "url", "left_semi")
        # A replay may have brought a page twice.
        self.found[kind] = materialize(near.dropDuplicates(["url"]), f"stored-{kind}")
        return self.found[kind]

    def facts_read(self, kind: str) -> DataFrame:
        return self.found[kind]

    def prompts(self, wanted: DataFrame, prompt: Column) -> DataFrame:
        return wanted.select("url", F.lit(None).cast("string").alias("prompt"))


def fact_log(spark: SparkSession, root: str) -> PageLog:
    return PageLog(spark, root, TABLES)
