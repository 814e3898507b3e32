"""Difference of runs, shape drift, coverage alert, quarantine and replay on hand-written rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfline.operators import listing, monitor
from shelfline.plans import jobs
from shelfline.schemas import PAGES, PRODUCT_TYPES, product_ddl
from shelfline.sources import store

BASE, AT = "https://shop.example.com", "2024-05-01 00:00:00"


def products(spark, *rows):
    """Rows of ``fingerprint`` and other fields, the rest null."""
    ddl = product_ddl(with_order=False)
    return spark.createDataFrame([tuple({"currency": "USD", **r}.get(c) for c in PRODUCT_TYPES) for r in rows], ddl)


def test_run_diff(spark):
    before = products(
        spark, {"fingerprint": "same", "price": 1.0, "specifications": {"a": "1", "b": "2"}}, {"fingerprint": "gone", "price": 2.0},
        {"fingerprint": "up", "price": 2.0}, {"fingerprint": "half", "price": 2.0}, {"fingerprint": "free", "price": 0.0},
        {"fingerprint": "lost", "price": 3.0}, {"fingerprint": "nan", "price": float("nan")}, {"fingerprint": "words", "description": "", "image_urls": ["a", "b"]},
        {"fingerprint": "time", "price": 1.0},
    )
    after = products(
        spark, {"fingerprint": "same", "price": 1.0, "specifications": {"b": "2", "a": "1"}}, {"fingerprint": "new"},
        {"fingerprint": "up", "price": 3.01}, {"fingerprint": "half", "price": 1.0}, {"fingerprint": "free", "price": 0.5},
        {"fingerprint": "lost"}, {"fingerprint": "nan", "price": float("nan")}, {"fingerprint": "words", "image_urls": ["b", "a"], "specifications": {}},
        {"fingerprint": "time", "price": 1.0, "scraped_at": datetime.datetime(2030, 1, 1)},
    )
    got = {r.fingerprint: (r.change, r.fields, r.price_before, r.price_after, r.price_jump) for r in monitor.run_diff(before, after).collect()}
    assert got == {
        "gone": ("gone", [], 2.0, None, False), "new": ("new", [], None, None, False), "up": ("changed", ["price"], 2.0, 3.01, True),
        "half": ("changed", ["price"], 2.0, 1.0, False), "free": ("changed", ["price"], 0.0, 0.5, True),
        "lost": ("changed", ["price"], 3.0, None, False), "words": ("changed", ["description", "specifications", "image_urls"], None, None, False),
    }
    assert monitor.run_diff(before, before).count() == monitor.run_diff(before.limit(0), before.limit(0)).count() == 0
    narrow = monitor.run_diff(before, after, fields=("price",))
    assert {r.fingerprint for r in narrow.collect()} == set(got) - {"words"}


def shapes(spark, *items):
    body = ",".join('{"item":%s}' % i for i in items)
    page = '<script type="application/ld+json">{"@type":"ItemList","itemListElement":[%s]}</script>' % body
    rows = listing.jsonld_scripts(spark.createDataFrame([("p", page)], "page_url string, html string"))
    return monitor.shape_histogram(listing.listing_elements(listing.jsonld_itemlists(listing.jsonld_blocks(rows))))


def test_shape_drift(spark):
    one = ['{"@type":"Product","sku":1,"price":2.5,"brand":null}', '{"@type":"Product","sku":2,"tags":[1]}', '{"@type":"Service","sku":{}}', "7"]
    two = ['{"@type":"Product","sku":"1","price":2,"brand":{"name":"x"}}', '{"@type":"Product","sku":2.5,"tags":{}}']
    a, b = shapes(spark, *one), shapes(spark, *two)
    assert {(r.field, r.kind): r.n for r in a.collect()} == {
        ("", ""): 2, ("@type", "STRING"): 2, ("sku", "NUMBER"): 2, ("price", "NUMBER"): 1, ("brand", "VOID"): 1, ("tags", "ARRAY"): 1,
    }
    got = {r.field: (r.distance, r.drifted) for r in monitor.shape_drift(a, b).collect()}
    assert got == {"@type": (0.0, False), "sku": (0.5, True), "price": (0.0, False), "brand": (0.5, True), "tags": (0.5, True)}
    both = monitor.merge_histograms(a, b)
    whole = shapes(spark, *one, *two)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))
    empty = shapes(spark, "1")
    assert {r.distance for r in monitor.shape_drift(empty, a).collect()} == {1.0, 0.5}
    assert monitor.shape_drift(empty, empty).count() == 0


def test_coverage_alert(spark):
    counts = {"total": 10, "price": 9, "image_urls": 8, "sku": 10, "rating": 0, "description": 10}
    got = {r.field: (r.pct, r.alert) for r in monitor.coverage_alert(spark, counts).collect()}
    assert got == {"price": (90.0, False), "image_urls": (80.0, True), "sku": (100.0, False), "rating": (0.0, True), "description": (100.0, False)}
    assert not any(r.alert for r in monitor.coverage_alert(spark, dict.fromkeys(counts, 0)).collect())


def page(*elements, more=""):
    return f'<script type="application/ld+json">{{"@type":"ItemList","itemListElement":[{",".join(elements)}]}}</script>{more}'


def item(address, name):
    return f'{{"url":"{BASE}{address}","item":{{"@type":"Product","name":"{name}"}}}}'


@pytest.fixture(scope="module")
def crawl(spark):
    day = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    anchors = "".join(f'<a href="/catalog/c/{x}">{x}</a>' for x in ("a", "b", "z"))
    first = [
        (f"{BASE}/catalog/c", 200, anchors, day[0]), (f"{BASE}/catalog/c/b", 503, "", day[0]),
        (f"{BASE}/catalog/c/a", 200, page(item("/product/1", "Item one"), item("/product/2", "Item two"), item("/product/3", "Item three"), item("/product/4", "Q"),
                                          more='<script type="application/ld+json">{"ItemList":,}</script>'), day[0]),
        (f"{BASE}/product/1", 500, None, day[0]), (f"{BASE}/product/2", 200, "<p>nothing to read</p>", day[0]),
        (f"{BASE}/product/3", 200, "<title>Three</title><meta name='description' content='Third'>", day[0]),
    ]
    later = [
        (f"{BASE}/catalog/c/b", 200, page(item("/product/5", "Item five"), item("/product/1", "Item one again")), day[1]),
        (f"{BASE}/product/1", 200, "<title>One</title><meta name='description' content='First'>", day[1]),
        (f"{BASE}/product/3", 200, "<title>Three</title><meta name='description' content='Other'>", day[1]),
    ]
    seeds = spark.createDataFrame([(0, "/catalog/c")], "seed_ord bigint, path string")
    return spark.createDataFrame(first, PAGES), spark.createDataFrame(later, PAGES), seeds


def test_quarantine_and_replay(spark, crawl, tmp_path):
    pages, later, seeds = crawl
    kept = store.Store(spark, str(tmp_path / "s"))
    jobs.run_into(kept, pages, seeds, BASE, AT, 0)

    def aside():
        return sorted((r.kind, r.url.removeprefix(BASE), r.reason) for r in kept.quarantined().collect())

    first = [
        ("detail page", "/product/1", "status 500"), ("detail page", "/product/4", "no snapshot"), ("listing page", "/catalog/c/b", "status 503"),
        ("listing page", "/catalog/c/z", "no snapshot"), ("product", "/catalog/c/a", "short_name"), ("record", "/product/2", "no rule reads it"),
        ("script", "/catalog/c/a", "not JSON"),
    ]
    assert aside() == first
    jobs.run_into(kept, pages, seeds, BASE, AT, 1)  # the same again adds nothing
    assert aside() == first
    told = spark.createDataFrame([(f"{BASE}/product/2", '{"product_name":"Two","description":"Second"}')], "url string, text string")
    done = jobs.replay(kept, pages.unionByName(later), BASE, AT, 2, answers=told)
    # Only pages in quarantine, and those that a listing read now leads to, were read.
    assert {r.url.removeprefix(BASE) for r in done.reader.facts_read("detail").collect()} == {"/product/1", "/product/2"}
    assert done.reader.evaluated["links" if "links" in done.reader.evaluated else "listing"] == 1
    left = [x for x in first if x[1] in ("/product/4", "/catalog/c/z", "/catalog/c/a")]
    assert aside() == sorted([*left, ("detail page", "/product/5", "no snapshot")])
    got = {r.product_name: (r.description, r.batch) for r in kept.products().collect()}
    assert got == {"Item one": ("First", 0), "Item two": ("Second", 0), "Item three": ("Third", 0), "Item five": (None, 2)}
    jobs.replay(kept, pages.unionByName(later), BASE, AT, 3)
    assert {r.product_name: (r.description, r.batch) for r in kept.products().collect()} == got
    assert aside() == sorted([*left, ("detail page", "/product/5", "no snapshot")])


def test_observed_counters_equal_a_scan(spark, crawl):
    from shelfline.operators import reports, validate

    pages, later, seeds = crawl
    run = jobs.full_run(pages.unionByName(later), seeds, BASE, AT)
    raw = run.listings.withColumn("page_url", F.col("url"))
    scanned = validate.validation_stats(jobs.raw_listing_products(raw))
    assert run.stats.first() == scanned.first()
    valid = validate.validate(jobs.raw_listing_products(raw))
    assert {tuple(r)[:4] for r in run.coverage.collect()} == {tuple(r) for r in reports.field_coverage(valid).collect()}
