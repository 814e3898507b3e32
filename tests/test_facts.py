"""Facts read on demand, the log that keeps them, and runs over a stream of pages with details."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfline.operators import frontier
from shelfline.plans import facts, jobs
from shelfline.samples import catalog
from shelfline.schemas import PAGES, PRODUCT_TYPES
from shelfline.sources import snapshots, store
from shelfline.sources.log import PageLog
from shelfline.streaming import incremental

from .conftest import DATA

BASE, AT = catalog.BASE, catalog.FETCHED


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    part = spark.read.parquet(f"{DATA}/sf0.001/part.parquet")
    path = str(tmp_path_factory.mktemp("shop"))
    catalog.with_history(catalog.shop_pages(part)).repartition(6).write.parquet(f"{path}/pages")
    catalog.seeds(part).write.parquet(f"{path}/seeds")
    return snapshots.read_pages(spark, f"{path}/pages"), spark.read.parquet(f"{path}/seeds"), f"{path}/pages"


def table(df):
    return sorted(tuple(map(str, r)) for r in df.select(*PRODUCT_TYPES).collect())


@pytest.fixture(scope="module")
def full(shop):
    return jobs.full_run(*shop[:2], BASE, AT)


def test_only_wanted_pages_are_read(shop, full):
    pages, seeds, _ = shop
    ok = pages.filter("status = 200")
    assert full.reader.evaluated["links"] <= ok.join(frontier.seed_frontier(seeds, BASE), "url", "left_semi").count()
    details = full.reader.fresh["detail"]
    assert 0 < full.reader.evaluated["detail"] < ok.count()
    assert details.count() == details.select("url").distinct().count()
    assert details.filter(~F.contains("url", F.lit("/product/"))).count() == 0


@pytest.mark.parametrize("bits", [facts.MOST_BITS, facts.ROW_BITS])
def test_bitmap_of_addresses(shop, full, monkeypatch, bits):
    """Beyond the broadcast bound the same facts come through a bitmap, however many strangers it lets through."""
    monkeypatch.setattr(facts, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(facts, "MOST_BITS", bits)
    again = jobs.full_run(*shop[:2], BASE, AT)
    assert table(again.products) == table(full.products)
    assert all(again.reader.evaluated[k] >= full.reader.evaluated[k] for k in facts.TABLES)


def test_bitmap_keeps_every_key(spark):
    time = F.when(F.col("id") % 3 > 0, F.timestamp_seconds("id"))
    rows = spark.range(20_000).select(F.concat(F.lit("u"), "id").alias("url"), time.alias("fetched_at"), "id")
    keys = rows.filter("id % 20 = 3").select("url", "fetched_at")
    met = facts.possibly_among(rows, keys, 1000)
    assert met.columns == ["url", "fetched_at", "id"]
    assert facts.among(rows, keys).count() == 1000
    assert met.filter("id % 20 = 3").count() == 1000
    assert met.count() < 2500


def test_no_exchange_carries_a_body(shop):
    pages, seeds, _ = shop
    seen = []
    plain = facts.materialize

    def watch(df, label):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    facts.materialize = watch
    try:
        reader = facts.PageReader(pages, BASE)
        for kind in facts.TABLES:
            reader.facts(kind, pages.select("url"))
    finally:
        facts.materialize = plain
    assert any("html" in plan for plan in seen)
    assert "html" not in seen[0]  # the newest snapshots are chosen without bodies
    for plan in seen:
        for line in plan.splitlines():
            assert not ("Exchange hashpartitioning" in line and "html" in line)
        above = plan.split("Exchange hashpartitioning")[0]
        assert "Project [url#" not in above or "html#" not in above


def test_files_without_wanted_pages_stay_closed(spark, tmp_path):
    for day in range(4):
        rows = [(f"/p{day}-{i}", 200, "<title>x</title>", datetime.datetime(2024, 1, day + 1)) for i in range(5)]
        spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    pages = snapshots.read_pages(spark, str(tmp_path / "p"))
    reader = facts.PageReader(pages, BASE)
    need = reader.heads.filter("url like '/p2-%'")
    assert need.select("file").distinct().count() == 1
    near = pages.filter(F.col("_metadata.file_path").isin([need.first()["file"]]))
    near.count()
    scan = near.select("html")
    scan.collect()
    assert scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numFiles").get().value() == 1
    assert sorted(r.url for r in reader.facts("detail", need.select("url")).collect()) == [f"/p2-{i}" for i in range(5)]
    assert reader.evaluated["detail"] == 5


def test_rerun_over_visited_pages_evaluates_nothing(spark, shop, full, tmp_path):
    pages, seeds, _ = shop
    kept = store.Store(spark, str(tmp_path / "s"))
    first = jobs.run_into(kept, pages, seeds, BASE, AT, 0)
    assert first.reader.evaluated == full.reader.evaluated
    before = table(kept.products())
    again = jobs.run_into(kept, pages, seeds, BASE, AT, 1)
    assert again.reader.evaluated == {"links": 0, "listing": 0, "detail": 0}
    assert again.inserted.count() == 0 and table(kept.products()) == before == table(full.products)


def test_facts_survive_without_marks(spark, shop, full, tmp_path):
    """After a crash between facts and marks the bodies are not read again, and the products are the same."""
    pages, seeds, _ = shop
    log = facts.fact_log(spark, str(tmp_path / "facts"))
    first = jobs.full_run(pages, seeds, BASE, AT, known=log)
    first.reader.save(log)
    second = jobs.full_run(pages, seeds, BASE, AT, known=log)
    assert set(second.reader.evaluated.values()) == {0}
    assert table(second.products) == table(full.products)
    log.fold()
    third = jobs.full_run(pages, seeds, BASE, AT, known=log)
    assert set(third.reader.evaluated.values()) == {0} and table(third.products) == table(full.products)
    # A later snapshot of one product page is read, alone.
    page = first.reader.fresh["detail"].filter("extracted_by = 'jsonld'").select("url").orderBy("url").first()["url"]
    later = pages.unionByName(spark.createDataFrame([(page, 200, "<title>New words | shop</title>", datetime.datetime(2030, 1, 1))], PAGES))
    fourth = jobs.full_run(later, seeds, BASE, AT, known=log)
    assert fourth.reader.evaluated["detail"] == 1


def test_times_unknown_are_read_again(spark, tmp_path):
    page = '<script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"url":"/p","item":{"@type":"Product","name":"%s"}}]}</script>'
    seeds = spark.createDataFrame([(0, "/catalog/x")], "seed_ord bigint, path string")
    log = facts.fact_log(spark, str(tmp_path / "f"))
    for name in ("One thing", "Other thing"):
        pages = spark.createDataFrame([(f"{BASE}/catalog/x", 200, page % name, None)], PAGES)
        run = jobs.full_run(pages, seeds, BASE, AT, known=log)
        run.reader.save(log)
        assert [r.product_name for r in run.products.collect()] == [name]


def test_type_answers_in_a_run(spark):
    seeds = spark.createDataFrame([(0, "/a"), (1, "/b"), (2, "/catalog/c")], "seed_ord bigint, path string")
    pages = spark.createDataFrame([(f"{BASE}{p}", 200, "<p>words</p>", None) for p in ("/a", "/b", "/catalog/c")], PAGES)
    first = jobs.full_run(pages, seeds, BASE, AT)
    asked = {r.url: r.prompt for r in first.type_requests.collect()}
    assert set(asked) == {f"{BASE}/a", f"{BASE}/b"} and all("<p>words</p>" in p for p in asked.values())
    assert {r.url: (r.page_type, r.unexpected_type) for r in first.audit.collect()}[f"{BASE}/a"] == ("unknown", True)
    answers = spark.createDataFrame([(f"{BASE}/a", "type", " Listing\n"), (f"{BASE}/a", "type", "zebra"), (f"{BASE}/b", "type", "product"), (f"{BASE}/b", "record", "{}"), (f"{BASE}/catalog/c", "type", "product")], "url string, task string, text string")
    second = jobs.full_run(pages, seeds, BASE, AT, answers=answers)
    got = {r.url: (r.page_type, r.classified_by, r.unexpected_type) for r in second.audit.collect()}
    assert got == {f"{BASE}/a": ("listing", "model", False), f"{BASE}/b": ("product", "model", True), f"{BASE}/catalog/c": ("category", "rule", False)}
    assert second.type_requests.count() == 0


def test_log_folds_and_replays(spark, tmp_path):
    log = PageLog(spark, str(tmp_path / "log"), {"words": "word string"})
    day = [datetime.datetime(2024, 1, d) for d in range(1, 5)]

    def batch(name, *pages):
        rows = spark.createDataFrame([(u, d, s, b, w) for u, d, s, b, ws in pages for w in ws], "url string, fetched_at timestamp, status int, body_hash bigint, word string")
        versions = spark.createDataFrame([p[:4] for p in pages], "url string, fetched_at timestamp, status int, body_hash bigint")
        return log.append(name, {"words": rows}, versions)

    def words():
        return sorted((r.url, r.word) for r in log.live("words").collect())

    assert not log.holds_any() and words() == [] and log.fold() == -1
    assert batch("a", ("x", day[0], 200, 1, ["x1", "x2"]), ("y", day[1], 200, 2, ["y1"]))
    assert batch("b", ("x", day[2], 200, 3, ["x3"]), ("z", None, 200, 4, ["z1"]))
    want = [("x", "x3"), ("y", "y1"), ("z", "z1")]
    assert words() == want
    assert log.fold() == 0 and log.batches() == [] and words() == want
    assert log.rows("words").count() == 3  # only live rows are read from now on
    assert not batch("b", ("x", day[3], 200, 9, ["never"])) and words() == want
    assert batch("c", ("y", day[2], 500, 5, []), ("z", day[0], 200, 6, ["z2"]), ("x", day[1], 200, 7, ["old"]))
    assert words() == [("x", "x3"), ("z", "z2")]
    # What a crash left behind is neither read nor in the way.
    spark.createDataFrame([("x", day[3], 200, 8, "lost")], log.ddl["words"]).write.parquet(str(tmp_path / "log/tail/words/seq=3"))
    assert words() == [("x", "x3"), ("z", "z2")]
    assert batch("d", ("w", day[0], 200, 1, ["w1"])) and words() == [("w", "w1"), ("x", "x3"), ("z", "z2")]
    assert log.fold() == 1 and words() == [("w", "w1"), ("x", "x3"), ("z", "z2")]


@pytest.mark.parametrize(("order", "fold_every"), [("up", 20), ("down", 2)])
def test_any_order_of_files_gives_one_table(spark, shop, full, tmp_path, order, fold_every):
    _, seeds, folder = shop
    source = tmp_path / "in"
    os.makedirs(source)
    files = sorted(glob.glob(f"{folder}/*.parquet"))
    for at, file in enumerate(files if order == "up" else files[::-1]):
        os.symlink(file, source / f"{at}.parquet")
        os.utime(source / f"{at}.parquet", (1000 + at, 1000 + at), follow_symlinks=False)
    log = facts.fact_log(spark, str(tmp_path / "log"))
    for _ in range(2):  # the second time there is nothing new
        incremental.ingest_shop(spark, str(source), log, str(tmp_path / "cp"), seeds, BASE, max_files=2, fold_every=fold_every).awaitTermination()
    assert (log.folded()[0] >= 0) == (fold_every == 2)
    run = incremental.shop_run(log, seeds, BASE, AT)
    assert table(run.products) == table(full.products)
    assert sorted(map(tuple, run.failed.collect())) == sorted(map(tuple, full.failed.collect()))
    # The same files under a new checkpoint are a replay of all pages.
    incremental.ingest_shop(spark, str(source), log, str(tmp_path / "cp2"), seeds, BASE, max_files=4, fold_every=fold_every).awaitTermination()
    assert table(incremental.shop_run(log, seeds, BASE, AT).products) == table(full.products)


def test_snapshot_bodies_do_not_move(spark, monkeypatch):
    at = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    rows = [("a", 200, "old", at[0]), ("a", 200, "new", at[1]), ("a", 200, "new", at[1]), ("b", 200, "x", None), ("b", 200, "y", None), ("c", 500, None, at[0])]
    front = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "url string, n int")
    pages = spark.createDataFrame(rows, PAGES)
    got = snapshots.snapshot(front, pages)
    assert got.columns == ["url", "n", "status", "html"]
    first = {r.url: (r.n, r.status, r.html) for r in got.collect()}
    assert got.count() == 3 and first["a"] == (1, 200, "new") and first["c"] == (3, 500, None) and first["b"][2] in ("x", "y")
    once = snapshots.snapshot(front, spark.createDataFrame(list(dict.fromkeys(rows)), PAGES))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "html" in line] and "BroadcastHashJoin" in plan
    monkeypatch.setattr(snapshots, "is_small", lambda df: False)
    assert {r.url: (r.n, r.status, r.html) for r in snapshots.snapshot(front, pages).collect()} == first
