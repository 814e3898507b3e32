"""Whole runs, stored tables, exports and the incremental stream, on the sample shop."""

import csv
import datetime
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfline.operators import frontier
from shelfline.plans import jobs
from shelfline.samples import catalog
from shelfline.schemas import PAGES, PRODUCT_TYPES
from shelfline.session import is_small, narrow
from shelfline.sources import export, snapshots, store
from shelfline.streaming import incremental

from .conftest import DATA

BASE, AT = catalog.BASE, catalog.FETCHED


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    part = spark.read.parquet(f"{DATA}/sf0.001/part.parquet")
    path = str(tmp_path_factory.mktemp("shop"))
    catalog.shop_pages(part).repartition(4).write.parquet(f"{path}/pages")
    catalog.seeds(part).write.parquet(f"{path}/seeds")
    return snapshots.read_pages(spark, f"{path}/pages"), spark.read.parquet(f"{path}/seeds")


def table(df):
    return sorted(tuple(map(str, r)) for r in df.select(*PRODUCT_TYPES).collect())


@pytest.fixture(scope="module")
def full(shop):
    return jobs.full_run(*shop, BASE, AT)


def test_run_adds_up(full):
    stats = full.stats.first()
    assert stats["total"] == stats["valid"] + stats["duplicates"] + stats["dropped"]
    assert full.rejects.count() == stats["dropped"]
    keys = [r["fingerprint"] for r in full.products.collect()]
    assert len(keys) == len(set(keys)) == full.inserted.count() >= stats["valid"]
    assert full.patches.count() > 0
    assert full.failed.filter("status = 200").count() == 0
    assert full.audit.filter("unexpected_type").count() == 0


def test_run_does_not_depend_on_layout(spark, shop, full):
    pages, seeds = shop
    with_other = jobs.full_run(pages.repartition(13, "status"), seeds.repartition(3), BASE, AT)
    assert table(with_other.products) == table(full.products)


def test_seed_flag_beyond_the_broadcast_bound(shop, full, monkeypatch):
    for module in (jobs, frontier):
        monkeypatch.setattr(module, "is_small", lambda df: False)
    assert table(jobs.full_run(*shop, BASE, AT).products) == table(full.products)


def test_size_bound(spark):
    assert is_small(spark.range(10), rows=10)
    assert not is_small(spark.range(11), rows=10)
    assert not is_small(spark.range(3).select(F.repeat(F.lit("x"), 100).alias("s")), max_bytes=200)
    assert is_small(spark.range(0))


def test_narrow_keeps_every_match(spark):
    table, keys = spark.range(100).withColumnRenamed("id", "k"), spark.createDataFrame([(3,), (3,), (200,)], "k bigint")
    assert [r["k"] for r in narrow(table, keys).collect()] == [3]


def test_skipping_details(shop, full):
    plain = jobs.full_run(*shop, BASE, AT, skip_details=True)
    assert plain.patches.count() == 0
    assert {r["fingerprint"] for r in plain.products.collect()} < {r["fingerprint"] for r in full.products.collect()}


def test_bodies_never_meet_a_shuffle(spark, shop):
    pages, seeds = shop
    facts = jobs.page_facts(pages, frontier.seed_frontier(seeds, BASE), BASE)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    pages_side = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in pages_side
    assert plan.count("html") and plan.count("FileScan parquet [url") == 1


def test_store_in_steps_equals_one_run(spark, shop, full, tmp_path):
    pages, seeds = shop
    kept = store.Store(spark, str(tmp_path / "store"))
    jobs.run_into(kept, pages, seeds, BASE, AT, 0, limit=2)
    first = {r["fingerprint"]: r for r in kept.products().collect()}
    jobs.run_into(kept, pages, seeds, BASE, AT, 1)
    again = kept.products()
    assert again.count() == full.products.count()
    for r in again.filter("batch = 0").collect():
        assert r == first[r["fingerprint"]]
    before = table(again)
    jobs.run_into(kept, pages, seeds, BASE, AT, 2)
    assert table(kept.products()) == before
    assert table(kept.products().drop("batch")) == table(full.products)
    visits = kept.visited()
    assert visits.count() == visits.select("url").distinct().count() == full.marks.count()
    ordered = kept.ordered().orderBy("id").collect()
    assert [r["id"] for r in ordered] == list(range(1, len(ordered) + 1))


def test_insert_counts_and_keeps_rows(spark, full, tmp_path):
    kept = store.Store(spark, str(tmp_path / "s"))
    rows = full.inserted
    n = rows.count()
    assert kept.insert(rows.limit(0), 0) == 0
    assert kept.insert(rows.unionByName(rows), 1) == n
    assert kept.insert(rows.withColumn("price", F.lit(1.0)), 2) == 0
    assert table(kept.stored()) == table(rows)
    assert store.product_count(kept.products()).first()[0] == n


def test_marks_are_ignored_when_known(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "v"))
    urls = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    kept.mark(urls, AT)
    kept.mark(urls.unionByName(spark.createDataFrame([("c",)], "url string")), AT)
    assert sorted(r["url"] for r in kept.visited().collect()) == ["a", "b", "c"]
    assert store.mark_visited(kept.visited(), urls, AT).count() == 3


def test_exports(spark, full, tmp_path):
    ordered = store.number_rows(full.products)
    export.write_json(ordered, str(tmp_path / "j"))
    lines = [json.loads(x) for f in glob.glob(f"{tmp_path}/j/*.json") for x in open(f, encoding="utf-8")]
    assert len(lines) == full.products.count()
    assert list(lines[0]) == ["id", *PRODUCT_TYPES]
    assert all(isinstance(r["image_urls"], list) and isinstance(r["specifications"], dict) for r in lines)
    assert any("©" in r["product_name"] for r in lines)
    export.write_csv(ordered, str(tmp_path / "c"))
    flat = [r for f in glob.glob(f"{tmp_path}/c/*.csv") for r in csv.DictReader(open(f, encoding="utf-8", newline=""))]
    assert {r["fingerprint"] for r in flat} == {r["fingerprint"] for r in lines}
    by_key = {r["fingerprint"]: r for r in lines}
    for r in flat:
        assert "id" not in r and json.loads(r["image_urls"]) == by_key[r["fingerprint"]]["image_urls"]
        assert r["brand"] == (by_key[r["fingerprint"]]["brand"] or "")


def test_empty_export(spark, full, tmp_path):
    export.write_json(store.number_rows(full.products.limit(0)), str(tmp_path / "j"))
    assert not [x for f in glob.glob(f"{tmp_path}/j/*.json") for x in open(f)]


def test_stream_replays_add_nothing(spark, shop, tmp_path):
    pages, _ = shop
    kept, source = store.Store(spark, str(tmp_path / "s")), str(tmp_path / "in")
    listings = pages.filter(F.contains("url", F.lit("/catalog/")))
    half = F.pmod(F.xxhash64("url"), F.lit(2)) == 0
    listings.filter(half).write.mode("append").parquet(source)
    incremental.ingest(spark, source, kept, str(tmp_path / "cp"), AT).awaitTermination()
    first = kept.products().count()
    assert first > 0
    listings.write.mode("append").parquet(source)
    incremental.ingest(spark, source, kept, str(tmp_path / "cp"), AT, first_batch=10).awaitTermination()
    whole = incremental.batch_products(pages, AT, 0)
    assert {r["fingerprint"] for r in kept.products().collect()} == {r["fingerprint"] for r in whole.collect()}
    total = kept.products().count()
    assert total == whole.count() > first
    incremental.ingest(spark, source, kept, str(tmp_path / "cp"), AT, first_batch=20).awaitTermination()
    incremental.ingest(spark, source, kept, str(tmp_path / "cp2"), AT, first_batch=30).awaitTermination()
    assert kept.products().count() == total


def test_stream_batches_change_nothing(spark, tmp_path):
    """One file to a batch, older and newer snapshots in either order, equals all in one batch."""
    def page(*items):
        listed = ",".join(f'{{"@type":"ListItem","url":"/p/{k}","item":{{"@type":"Product","name":"Product {k}","offers":{{"price":"{price}"}}}}}}' for k, price in items)
        return f'<script type="application/ld+json">{{"@type":"ItemList","itemListElement":[{listed}]}}</script>'

    day = [datetime.datetime(2024, 1, d) for d in range(1, 4)]
    rows = [
        ("/a", 200, page(("a", 1), ("c", 5)), day[0]), ("/a", 200, page(("a", 2)), day[1]),  # newer later: c leaves this page
        ("/b", 200, page(("b", 4)), day[2]), ("/b", 200, page(("b", 3)), day[0]),  # newer first
        ("/c", 200, page(("c", 6), ("a", 9)), day[0]),  # takes over c
        ("/d", 200, page(("d", 7)), day[0]), ("/d", 500, "", day[1]),  # the latest fetch failed
        ("/e", 200, page(("e", 8)), day[0]), ("/e", 200, "<p>nothing</p>", day[1]),  # lists nothing any more
    ]
    files = [[r for r in rows if r[3] == d] for d in day]
    for order, name in ((files, "up"), (files[::-1], "down")):
        source = str(tmp_path / name)
        for k, part in enumerate(order):
            spark.createDataFrame(part, PAGES).coalesce(1).write.mode("append").parquet(source)
            for f in glob.glob(f"{source}/*.parquet"):
                if os.path.getmtime(f) > 10_000:
                    os.utime(f, (1000 + k, 1000 + k))
        got = []
        for size in (1, 1000):
            kept = store.Store(spark, str(tmp_path / f"{name}{size}"))
            incremental.ingest(spark, source, kept, str(tmp_path / f"cp{name}{size}"), AT, max_files=size).awaitTermination()
            assert (len(kept.log.batches()) > 1) == (size == 1)
            got.append({r["product_name"]: r["price"] for r in kept.products().collect()})
        assert got[0] == got[1]
        assert set(got[0]) == {"Product a", "Product b", "Product c"}
        assert (got[0]["Product b"], got[0]["Product c"]) == (4.0, 6.0)


def test_stream_labels(spark, shop):
    pages, seeds = shop
    front = frontier.listing_frontier(frontier.seed_frontier(seeds, BASE), pages, BASE).select("url", "category_path")
    labelled = incremental.batch_products(pages, AT, 0, front)
    assert labelled.filter("category_path like 'economy-0 > %'").count() > 0


def test_one_hot_address(spark):
    """A third of all rows under one address and one key; the rest unique."""
    n = 3000
    elements = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.concat(
            F.lit('{"url":"'), F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), i.cast("string"))),
            F.lit('","item":{"@type":"Product","name":"n'), i.cast("string"), F.lit('","sku":"'),
            F.when(i % 2 == 0, F.lit("s")).otherwise(i.cast("string")), F.lit('"}}'),
        ),
    )
    page = F.concat(
        F.lit('<script type="application/ld+json">{"@type":"ItemList","itemListElement":['), F.array_join(elements, ","),
        F.lit("]}</script>"),
    )
    pages = spark.range(1).select(F.lit(f"{BASE}/catalog/x").alias("url"), F.lit(200).alias("status"), page.alias("html"))
    seeds = spark.createDataFrame([(0, "/catalog/x")], "seed_ord bigint, path string")
    got = jobs.full_run(pages, seeds, BASE, AT)
    want = {("hot" if i % 3 == 0 else f"u{i}", "S" if i % 2 == 0 else str(i)): f"n{i}" for i in reversed(range(n))}
    assert {(r["product_url"], r["sku"]): r["product_name"] for r in got.products.collect()} == want


def test_newest_snapshot_counts(spark, shop, full):
    pages, seeds = shop
    again = jobs.full_run(catalog.with_history(pages), seeds, BASE, AT)
    assert table(again.products) == table(full.products)
    assert again.stats.first() == full.stats.first()
    assert sorted(map(tuple, again.failed.collect())) == sorted(map(tuple, full.failed.collect()))
    twice = jobs.full_run(pages.unionByName(pages), seeds, BASE, AT)
    assert table(twice.products) == table(full.products)
    assert twice.stats.first() == full.stats.first()


def test_newest_rule(spark):
    at = "2024-01-0{} 00:00:00".format
    rows = [("a", 200, "old", at(1)), ("a", 200, "new", at(2)), ("b", 200, "fine", at(1)), ("b", 500, None, at(2)), ("c", 404, None, at(1)), ("c", 200, "back", at(2)), ("d", 200, "x", None), ("d", 200, "y", at(1)), ("e", 500, None, at(1)), ("e", 200, "tie", at(1))]
    pages = spark.createDataFrame(rows, "url string, status int, html string, fetched_at string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    front = spark.createDataFrame([(x,) for x in "abcde"], "url string")
    got = {r.url: (r.status, r.html) for r in snapshots.snapshot(front, pages).collect()}
    assert got == {"a": (200, "new"), "b": (500, None), "c": (200, "back"), "d": (200, "y"), "e": (200, "tie")}
    assert [r.url for r in snapshots.failed_pages(pages).collect()] == ["b"]


def test_base_with_slash_and_gapped_seeds(spark, shop, full):
    pages, seeds = shop
    assert table(jobs.full_run(pages, seeds, BASE + "/", AT).products) == table(full.products)
    gapped = spark.createDataFrame([(10, "/catalog/a"), (30, "/catalog/c"), (20, "/catalog/b")], "seed_ord int, path string")
    assert sorted(r.seed_ord for r in frontier.seed_frontier(gapped, BASE, limit=2).collect()) == [10, 20]


def test_model_answers_reach_the_run(spark, shop, full):
    pages, seeds = shop
    open_pages = {r.url for r in full.requests.collect()}
    part = spark.read.parquet(f"{DATA}/sf0.001/part.parquet")
    answered = jobs.full_run(pages, seeds, BASE, AT, answers=catalog.model_answers(part))
    assert open_pages
    assert {r.url for r in answered.requests.collect()} < open_pages
    seen = [r for r in answered.products.collect() if (r.description or "").startswith("Seen ")]
    assert seen
    assert all(r.product_url in open_pages for r in seen)


def test_scratch_folder_is_shared_or_an_error(spark, monkeypatch):
    from shelfline import session

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, named=None):
            self.sparkContext, self.conf = Context(master), {"spark.checkpoint.dir": named} if named else {}

    with pytest.raises(ValueError, match="share"):
        session.scratch_dir(Session("spark://host:7077"))
    assert session.scratch_dir(Session("yarn", "/shared/x")) == "/shared/x"
    assert "shelfline-" in session.scratch_dir(Session("local[4]"))


def test_exports_follow_ids(spark, tmp_path):
    rows = spark.range(3000).selectExpr("3000 - id AS id", *(f"cast(null AS {k}) AS {n}" for n, k in PRODUCT_TYPES.items() if n != "product_name"), "repeat('x', cast(id % 400 AS int)) || id AS product_name").repartition(7)
    export.write_json(rows, str(tmp_path / "json"))
    export.write_csv(rows, str(tmp_path / "csv"))
    ids = [json.loads(line)["id"] for f in sorted(glob.glob(str(tmp_path / "json/part-*"))) for line in open(f)]
    assert ids == sorted(ids)
    names = [r["product_name"].lstrip("x") for f in sorted(glob.glob(str(tmp_path / "csv/part-*"))) for r in csv.DictReader(open(f))]
    assert [int(n) for n in names] == sorted((int(n) for n in names), reverse=True)
