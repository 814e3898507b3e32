"""The listing job, the detail job and the whole run.

A run asks a reader (see ``facts``) for what it needs to know about the pages of its frontier: seed pages first, then the
listings found there, then the products linked from those and not visited yet. Only these bodies are read, and only for what
is asked. All joins run on compact rows or on typed products; a body never passes a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import jsonld, markup
from ..operators import classify as typing_
from ..operators import detail, frontier, listing, merge, monitor, validate
from ..schemas import PRODUCT_TYPES
from ..session import configure, is_small, materialize
from ..sources.log import FOLD_EVERY, PageLog
from ..sources.snapshots import VERSION, newest_readable, ok_pages, with_version
from ..sources.store import Store, new_products
from .facts import PageReader, StoredReader, fact_log

PRODUCT_COLUMNS = [*PRODUCT_TYPES, "ord"]
LISTING_PHASE, DETAIL_PHASE = 0, 1


@dataclass
class RunResult:
    """Frames of one run. Page facts, frontier, raw and valid products and details are written tables, the rest is lazy."""

    products: DataFrame
    """The product table after the run."""
    inserted: DataFrame
    """Listing products and detail-only records that were not stored before."""
    patches: DataFrame
    """Enrichment of stored products by fingerprint."""
    rejects: DataFrame
    stats: DataFrame
    """Counters of the validation, observed while its rows were written."""
    coverage: DataFrame
    """Coverage of the valid products by field, with those below the limit flagged; observed as well."""
    marks: DataFrame
    """Addresses read in this run."""
    failed: DataFrame
    audit: DataFrame
    """Page type met per listing, with the unexpected ones flagged."""
    unread: DataFrame
    """Detail pages of the run that no rule could read."""
    untyped: DataFrame
    """Listing pages of the run whose type no rule could tell."""
    front: DataFrame
    """Listing frontier of the run."""
    listings: DataFrame
    """Listing pages that were read, compact."""
    wanted: DataFrame | None
    """Detail frontier of the run; None without details."""
    reader: PageReader | StoredReader
    """Where the facts came from: ``fresh`` facts by kind, and the number of bodies ``evaluated`` for each kind."""

    @cached_property
    def requests(self) -> DataFrame:
        """Model requests ``url, prompt`` for the unread pages; a stored reader has no bodies and gives addresses only."""
        return self.reader.prompts(self.unread, detail.request_prompt())

    @cached_property
    def type_requests(self) -> DataFrame:
        """Model requests ``url, prompt`` for the untyped pages."""
        return self.reader.prompts(self.untyped, typing_.question())

    @cached_property
    def script_rejects(self) -> DataFrame:
        """Scripts of readable pages that are not JSON: ``page_url, script_pos, bytes, reason``."""
        pages = ok_pages(self.reader.pages)
        return listing.script_rejects(pages.select(F.col("url").alias("page_url"), "html"))


def page_facts(pages: DataFrame, seeds: DataFrame, base: str, details: bool = True, answers: DataFrame | None = None) -> DataFrame:
    """One compact row per readable snapshot with the facts of all kinds, for pages whose frontier is not known yet.

    ``answers(url, text)`` are model answers for detail pages that no rule reads. Narrow but for the seed flag, which is broadcast when the seed list is proven small; otherwise every
    page is searched for subcategories.
    """
    ok = with_version(ok_pages(pages)).select("url", "html", *VERSION)
    urls = seeds.select("url", F.lit(True).alias("is_seed")).distinct()
    if is_small(urls):
        flagged, where = ok.join(F.broadcast(urls), "url", "left"), F.col("is_seed")
    else:
        flagged, where = ok.withColumn("is_seed", F.lit(True)), None
    facts = flagged.withColumns(
        {"all_scripts": markup.ld_scripts(F.col("html")), "page_url": F.col("url"), "category_path": F.lit("")}
    )
    kept = F.filter("all_scripts", lambda s: jsonld.may_hold(s, "ItemList"))
    page_type = F.coalesce(
        typing_.type_by_url(F.col("url")), typing_.type_by_scripts(F.col("all_scripts")), F.lit("unknown")
    )
    facts = facts.withColumns({"scripts": kept, "page_type": page_type}).drop("all_scripts")
    facts = frontier.with_hit_cells(facts, base, where)
    columns = ["url", "page_type", "scripts", "_prefix", "hits", *VERSION]
    if details:
        facts = facts.withColumn("product_urls", F.when(F.size("scripts") > 0, frontier.product_links(F.col("scripts"))))
        facts = detail.read_page(facts)
        columns += ["product_urls", "record", "extracted_by"]
    facts = frontier.with_hits(facts.drop("html"), base)
    if details:
        facts = detail.resolve_record(facts, answers)
    return facts.select(*columns)


def _place(phase: int, batch: int, *columns: str):
    return F.array(F.lit(batch).cast("bigint"), F.lit(phase).cast("bigint"), *[F.col(c).cast("bigint") for c in columns])


def listings_read(front: DataFrame, facts: DataFrame, batch: int = 0) -> DataFrame:
    """Listing pages of the frontier that were read, as compact rows with their place in the run."""
    return front.join(facts, "url").withColumns(
        {"ord": _place(LISTING_PHASE, batch, "seed_ord", "sub_pos"), "page_url": F.col("url")}
    )


def raw_listing_products(listings: DataFrame) -> DataFrame:
    return listing.extract_scripts(listings.select("page_url", "category_path", "ord", "scripts"))


def stamp(products: DataFrame, scraped_at, *more: str) -> DataFrame:
    return products.withColumn("scraped_at", F.lit(scraped_at).cast("timestamp")).select(*PRODUCT_COLUMNS, *more)


def listing_job(
    pages: DataFrame, front: DataFrame, scraped_at, stored: DataFrame | None = None, batch: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Status, extraction, validation and insert for a listing frontier: the new products and the raw ones."""
    compact = listing.jsonld_scripts(with_version(ok_pages(pages)).select("url", "html", *VERSION), "ItemList")
    raw = raw_listing_products(listings_read(front, newest_readable(compact, pages), batch))
    valid = stamp(validate.validate(raw), scraped_at)
    # Written first: the insert reads it twice.
    return (valid if stored is None else new_products(materialize(valid, "valid"), stored)), raw


def detail_frontier(listings: DataFrame, visited: DataFrame | None, batch: int = 0) -> DataFrame:
    """Detail pages below ``listings`` to read: ``url, category_path, ord``."""
    placed = listings.withColumn("ord", _place(DETAIL_PHASE, batch, "seed_ord", "sub_pos"))
    wanted = frontier.product_frontier(placed, visited)
    # A subcategory read in this run is already marked.
    return wanted.join(listings.filter(~F.col("is_category")).select("url"), "url", "left_anti")


def detail_records(
    listings: DataFrame, facts: DataFrame, visited: DataFrame | None, batch: int = 0, wanted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Records of the detail pages below ``listings`` (or of the frontier ``wanted``), and the addresses read."""
    front = detail_frontier(listings, visited, batch) if wanted is None else wanted
    reached = front.join(facts.select("url", "record"), "url")
    rows = reached.withColumn("page_url", F.col("url")).withColumn(
        "record", F.when(F.col("record").isNotNull(), F.col("record").withField("category_path", F.col("category_path")))
    )
    return detail.records(rows), reached.select("url")


def detail_job(
    products: DataFrame, listings: DataFrame, facts: DataFrame, scraped_at, visited: DataFrame | None = None, batch: int = 0,
    wanted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Patches, inserts and marks from the detail pages of the listings read."""
    found, reached = detail_records(listings, facts, visited, batch, wanted)
    stamped = materialize(found.withColumn("scraped_at", F.lit(scraped_at).cast("timestamp")), "details")
    matched = merge.match_details(stamped, products)
    return merge.patches(matched), merge.inserts(matched, PRODUCT_COLUMNS), reached


def answers_to(task: str, answers: DataFrame | None) -> DataFrame | None:
    """Answers ``url, text`` of one task (``record`` or ``type``); without a column ``task`` all are records."""
    if answers is None or "task" not in answers.columns:
        return answers if task == "record" else None
    return answers.filter(F.col("task") == task).select("url", "text")


def full_run(
    pages: DataFrame,
    seeds: DataFrame,
    base: str,
    scraped_at,
    stored: DataFrame | None = None,
    visited: DataFrame | None = None,
    *,
    limit: int | None = None,
    skip_details: bool = False,
    batch: int = 0,
    answers: DataFrame | None = None,
    known: PageLog | None = None,
) -> RunResult:
    """One run over a page snapshot: seeds ``(seed_ord, path)`` to the product table.

    All listings go before all details, so a listing product wins over a detail-only record with its key. ``answers(url,
    text)``, with a column ``task`` if they answer both kinds, are model answers to the ``requests`` and ``type_requests`` of an
    earlier run. ``known`` holds what earlier runs read off the same snapshots.
    """
    configure(pages.sparkSession)
    reader = PageReader(pages, base, known)
    return run_over(reader, seeds, base, scraped_at, stored, visited, limit=limit, skip_details=skip_details, batch=batch, answers=answers)


def run_over(
    reader: PageReader | StoredReader,
    seeds: DataFrame,
    base: str,
    scraped_at,
    stored: DataFrame | None = None,
    visited: DataFrame | None = None,
    *,
    limit: int | None = None,
    skip_details: bool = False,
    batch: int = 0,
    answers: DataFrame | None = None,
) -> RunResult:
    """The same over what a reader knows of the pages."""
    start = frontier.seed_frontier(seeds, base, limit)
    links = reader.facts("links", start.select("url"))
    front = materialize(frontier.listing_frontier_of(start, links, visited), "frontier")
    return run_frontier(reader, front, scraped_at, stored, visited, skip_details=skip_details, batch=batch, answers=answers)


def run_frontier(
    reader: PageReader | StoredReader,
    front: DataFrame,
    scraped_at,
    stored: DataFrame | None = None,
    visited: DataFrame | None = None,
    *,
    skip_details: bool = False,
    batch: int = 0,
    answers: DataFrame | None = None,
    more_details: DataFrame | None = None,
) -> RunResult:
    """The run below a listing frontier, and over the detail pages ``more_details(url, category_path, ord)``."""
    spark = front.sparkSession
    typed = typing_.with_answers(reader.facts("listing", front.select("url")).drop(*VERSION), answers_to("type", answers))
    listings = listings_read(front, typed, batch)
    raw = materialize(raw_listing_products(listings), "raw")
    # Counters come with the rows as they are written.
    seen, kept = Observation("raw"), Observation("valid")
    checked = stamp(validate.validate(raw, seen), scraped_at)
    valid = materialize(checked.observe(kept, *monitor.coverage_metrics(checked)), "valid")
    stats = validate.stats_of(spark, seen.get["total"], kept.get["total"], seen.get["dropped"])
    if stored is None:
        fresh = products = valid
    else:
        before = stored.select(*PRODUCT_COLUMNS)
        fresh = new_products(valid, before)
        products = before.unionByName(fresh)
    marks = listings.filter(~F.col("is_category")).select("url")
    wanted = None
    if skip_details:
        none = products.limit(0).select(
            "fingerprint", F.col("description").alias("new_description"), F.col("specifications").alias("new_specifications")
        )
        inserted, changes = fresh, none
        unread = marks.limit(0)
    else:
        wanted = detail_frontier(listings, visited, batch)
        if more_details is not None:
            wanted = frontier.first_in_run(wanted.unionByName(more_details.select(*wanted.columns)))
        wanted = materialize(wanted, "detail-frontier")
        found = detail.with_answers(reader.facts("detail", wanted.select("url")).drop(*VERSION), answers_to("record", answers))
        changes, added, reached = detail_job(products, listings, found, scraped_at, visited, batch, wanted)
        inserted, marks = fresh.unionByName(added), marks.unionByName(reached)
        unread = found.filter("extracted_by = 'none'").select("url")
        products = merge.apply_patches(products, changes).unionByName(added)
    return RunResult(
        products=products,
        inserted=inserted,
        patches=changes,
        rejects=validate.rejects(raw),
        stats=stats,
        coverage=monitor.coverage_alert(spark, kept.get),
        marks=marks.distinct(),
        failed=reader.failed(),
        audit=typing_.audit_types(listings.select("url", "category_path", "page_type", "classified_by")),
        unread=unread,
        untyped=listings.filter("classified_by = 'none'").select("url").distinct(),
        front=front,
        listings=listings,
        wanted=wanted,
        reader=reader,
    )


def quarantine(result: RunResult) -> DataFrame:
    """What the run could not use, as rows of ``QUARANTINE`` without their batch.

    The key says what a row stands for, so a later run over the same page and cause adds nothing.
    """
    status = result.failed.select("url", F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown"))).alias("reason"))
    why = F.coalesce("reason", F.lit("no snapshot"))
    nothing = {"category_path": "string", "seed_ord": "bigint", "sub_pos": "bigint", "is_category": "boolean", "ord": "array<bigint>"}

    def rows(kind: str, frame: DataFrame, reason: Column, *key: str) -> DataFrame:
        own = [F.col(c).cast(t).alias(c) if c in frame.columns else F.lit(None).cast(t).alias(c) for c, t in nothing.items()]
        name = F.sha2(F.to_json(F.struct(F.lit(kind).alias("kind"), *key)), 256)
        return frame.select(name.alias("key"), F.lit(kind).alias("kind"), "url", reason.alias("reason"), *own)

    missed = result.front.join(result.listings.select("url"), "url", "left_anti").join(status, "url", "left")
    dropped = result.rejects.withColumnRenamed("page_url", "url")
    scripts = listing.bad_scripts(result.listings.select(F.col("url").alias("page_url"), "scripts"))
    out = [
        rows("listing page", missed, why, "url", "seed_ord"),
        # The batch, which comes first in the order, is not part of a product's place.
        rows("product", dropped.withColumn("place", F.slice("ord", 2, 16)), F.col("drop_reason"), "url", "place"),
        rows("script", scripts.withColumnRenamed("page_url", "url"), F.col("reason"), "url", "script_pos", "bytes"),
    ]
    if result.wanted is not None:
        read = result.reader.facts_read("detail")
        unread = result.wanted.join(result.unread, "url", "left_semi")
        lost = result.wanted.join(read.select("url"), "url", "left_anti").join(status, "url", "left")
        out += [rows("detail page", lost, why, "url"), rows("record", unread, F.lit("no rule reads it"), "url")]
    united = out[0]
    for frame in out[1:]:
        united = united.unionByName(frame)
    return united


def _keep(store: Store, log: PageLog, result: RunResult, scraped_at, batch: int) -> RunResult:
    """Append a run's facts, products, patches, quarantine and marks."""
    result.reader.save(log)
    if len(log.batches()) >= FOLD_EVERY:
        log.fold()
    inserted, changes = materialize(result.inserted, "inserted"), materialize(result.patches, "patches")
    marks = materialize(result.marks, "marks")
    aside = materialize(quarantine(result), "quarantine")
    store.append(inserted, batch)
    store.append_patches(changes, batch)
    store.set_aside(aside, batch)
    store.mark(marks, scraped_at)
    return result


def run_into(store: Store, pages: DataFrame, seeds: DataFrame, base: str, scraped_at, batch: int, **options) -> RunResult:
    """Run against a store and append what is new.

    Facts go first, then products and what was set aside, marks last: after a crash the same call finds the missing parts
    again without reading a body twice, and the keys keep it from inserting anything twice.
    """
    log = fact_log(store.spark, store.path("facts"))
    result = full_run(
        pages, seeds, base, scraped_at, store.products(), store.visited(), batch=batch, known=log, **options
    )
    return _keep(store, log, result, scraped_at, batch)


def replay(store: Store, pages: DataFrame, base: str, scraped_at, batch: int, answers: DataFrame | None = None, skip_details: bool = False) -> RunResult:
    """Try the pages in quarantine again, and only those: listings and details that can be read now, and details with an answer.

    What succeeds is released; products found now are inserted or patched as in a run.
    """
    configure(store.spark)
    log = fact_log(store.spark, store.path("facts"))
    aside = materialize(store.quarantined(), "set-aside")
    front = aside.filter("kind = 'listing page'").select("url", "category_path", "seed_ord", F.col("sub_pos").cast("int").alias("sub_pos"), "is_category")
    front = frontier.first_in_run(front, "seed_ord")
    again = aside.filter("kind in ('detail page', 'record')").select("url", "category_path", "ord")
    result = run_frontier(
        PageReader(pages, base, log), front, scraped_at, store.products(), store.visited(),
        skip_details=skip_details, batch=batch, answers=answers, more_details=None if skip_details else frontier.first_in_run(again),
    )
    freed = aside.filter("kind = 'listing page'").join(result.listings.select("url"), "url", "left_semi")
    if not skip_details:
        read = result.reader.facts_read("detail").select("url").join(result.unread, "url", "left_anti")
        freed = freed.unionByName(aside.filter("kind in ('detail page', 'record')").join(read, "url", "left_semi"))
    freed = materialize(freed.select("key"), "freed")
    _keep(store, log, result, scraped_at, batch)
    store.release(freed, batch)
    return result
