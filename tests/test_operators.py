"""Operators on small literal tables."""

import pytest
from pyspark.sql import functions as F

from shelfline.operators import classify, detail, frontier, listing, merge, reports, validate
from shelfline.schemas import PAGE_TYPES, product_ddl

BASE = "https://shop.example.com"
LD = '<script type="application/ld+json">%s</script>'


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# Classification

URLS = {
    f"{BASE}/product/1": "product", f"{BASE}/catalog/gloves": "category", f"{BASE}/catalog/gloves/": "category",
    f"{BASE}/catalog/gloves/nitrile": "listing", f"{BASE}/catalog/gloves?x=a/b": "listing", f"{BASE}/catalog/": None,
    f"{BASE}/CATALOG/a/b": "listing", f"{BASE}/catalog/a/product/b": "product", f"{BASE}/": None,
    f"{BASE}/catalog/a/catalog/b/c": "category",
}


def test_type_by_url(cells):
    got = dict(zip(URLS, cells(list(URLS), classify.type_by_url(F.col("value")))))
    # Only the text between the first two marks counts, without the slash that starts the second.
    assert got == URLS


@pytest.mark.parametrize(
    ("scripts", "want"),
    [
        (['{"@type":"Product"}', '{"@type":"ItemList"}'], "product"), (['{"@type":"ItemList","x":"Product"}'], "listing"),
        (["{}", '"Product"'], "product"), ([], None), (["Product"], None), (['"ItemList" broken'], "listing"),
    ],
)
def test_type_by_scripts(spark, scripts, want):
    df = spark.createDataFrame([(scripts,)], "s array<string>")
    assert df.select(classify.type_by_scripts(F.col("s"))).first()[0] == want


def test_type_by_answer(cells):
    assert cells([" Listing\n", "listing.", "", None, "unknown"], classify.type_by_answer(F.col("value"))) == [
        "listing", None, None, None, "unknown",
    ]


def test_classify_order_and_audit(spark):
    pages = spark.createDataFrame(
        [(f"{BASE}/product/1", LD % '{"@type":"ItemList"}'), ("u2", LD % '{"@type":"ItemList"}'), ("u3", ""), ("u4", None)],
        "url string, html string",
    )
    answers = spark.createDataFrame([("u2", "product"), ("u3", "category")], "url string, text string")
    typed = classify.audit_types(classify.classify(pages, answers))
    assert rows(typed) == [
        (f"{BASE}/product/1", "product", "url", True), ("u2", "listing", "html", False),
        ("u3", "category", "model", False), ("u4", "unknown", "none", True),
    ]
    assert set(r[1] for r in rows(typed)) <= set(PAGE_TYPES)
    assert rows(classify.classify_requests(pages).select("url")) == [("u3",), ("u4",)]


# Frontier


def _seed(spark, *paths):
    seeds = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "seed_ord bigint, path string")
    return frontier.seed_frontier(seeds, BASE)


def _pages(spark, **html):
    return spark.createDataFrame(
        [(f"{BASE}/catalog/{k}", 200, v) for k, v in html.items()], "url string, status int, html string"
    )


def test_seed_limit(spark):
    seeds = spark.createDataFrame([(0, "/catalog/a/"), (1, "catalog/b"), (2, "https://x/c")], "seed_ord bigint, path string")
    assert rows(frontier.seed_frontier(seeds, BASE)) == [
        (0, f"{BASE}/catalog/a/", "a"), (1, f"{BASE}/catalog/b", "b"), (2, "https://x/c", "c"),
    ]
    assert frontier.seed_frontier(seeds, BASE, 2).count() == 2
    assert frontier.seed_frontier(seeds, BASE, 0).count() == 3


def test_children_rules(spark):
    html = (
        '<a href="/catalog/a/one-2x">&nbsp;</a><a href="/catalog/a/one-2x/">dup</a><a href="/catalog/ab/no">n</a>'
        f'<a href="{BASE}/catalog/a/two?q=1#f"> T<i> wo </i></a><a href="relative">r</a><a href="/catalog/a/">self</a>'
        '<a href="http://other.example.org/catalog/a/x">off</a><a href="/catalog/a/b/c">deep</a>'
        '<a href="/catalog/a&amp;b/x">amp</a><a name="/catalog/a/none">no href</a>'
    )
    got = frontier.subcategories(_seed(spark, "/catalog/a"), _pages(spark, a=html), BASE)
    assert [(r["name"], r["url"], r["parent"], r["depth"]) for r in got.orderBy("sub_pos").collect()] == [
        ("One 2X", f"{BASE}/catalog/a/one-2x", "a", 1), ("Two", f"{BASE}/catalog/a/two?q=1#f", "a", 1),
    ]


def _collection(*names):
    items = ",".join(f'{{"item":{{"@type":"CollectionPage","name":"{n}","url":"{BASE}/{n}/"}}}}' for n in names)
    return f'{{"@type":"ItemList","itemListElement":[{items}]}}'


def test_jsonld_lists_after_the_first_hit(spark):
    none = '{"@type":"ItemList","itemListElement":[{"item":{"@type":"Product","url":"p"}},{"item":"text"}]}'
    html = (
        LD % f"[{none},{_collection('a', 'b', 'a')},{_collection('skipped')}]"
        + LD % f"[{none},{_collection('late')}]"
        + LD % f"[{_collection('c')},{_collection('d')}]"
    )
    got = frontier.subcategories_jsonld(_seed(spark, "/catalog/x"), _pages(spark, x=html), BASE)
    assert [r["name"] for r in got.orderBy("sub_pos").collect()] == ["a", "b", "c"]


def test_anchors_beat_jsonld_and_categories_fall_back(spark):
    pages = _pages(
        spark, a='<a href="/catalog/a/x">X</a>' + LD % _collection("j"), b=LD % _collection("k"), c="nothing"
    ).unionByName(spark.createDataFrame([(f"{BASE}/catalog/d", 500, "")], "url string, status int, html string"))
    seeds = _seed(spark, "/catalog/a", "/catalog/b", "/catalog/c", "/catalog/d", "/catalog/c")
    assert [r["name"] for r in frontier.subcategories_all(seeds, pages, BASE).orderBy("seed_ord").collect()] == ["X", "k"]
    front = frontier.listing_frontier(seeds, pages, BASE)
    assert rows(front.select("seed_ord", "url", "category_path", "is_category")) == [
        (0, f"{BASE}/catalog/a/x", "a > X", False), (1, f"{BASE}/k", "b > k", False),
        (2, f"{BASE}/catalog/c", "c", True), (3, f"{BASE}/catalog/d", "d", True), (4, f"{BASE}/catalog/c", "c", True),
    ]
    visited = spark.createDataFrame(
        [(f"{BASE}/catalog/a/x", "visited"), (f"{BASE}/k", "failed"), (f"{BASE}/catalog/c", "visited")], "url string, status string"
    )
    left = frontier.listing_frontier(seeds, pages, BASE, visited)
    assert [r["seed_ord"] for r in left.orderBy("seed_ord").collect()] == [1, 2, 3, 4]


def test_first_url_in_run_wins(spark):
    pages = _pages(spark, a='<a href="/catalog/a/x">A</a>', b=f'<a href="{BASE}/catalog/b/y">Y</a>')
    front = frontier.listing_frontier(_seed(spark, "/catalog/a", "/catalog/b", "/catalog/a"), pages, BASE)
    assert rows(front.select("url", "seed_ord")) == [(f"{BASE}/catalog/a/x", 0), (f"{BASE}/catalog/b/y", 1)]


def test_product_frontier_needs_a_named_product(spark):
    named = '{"@type":"ItemList","itemListElement":[{"url":"u1","item":{"@type":"Product","name":"n"}},{"url":"u2"},{"url":"u1"},{"url":5}]}'
    blank = '{"@type":"ItemList","itemListElement":[{"url":"u3","item":{"@type":"Product","name":" "}}]}'
    df = spark.createDataFrame([([named], "p", [0]), ([blank], "q", [1])], "scripts array<string>, category_path string, ord array<bigint>")
    linked = df.withColumn("product_urls", frontier.product_links(F.col("scripts")))
    assert rows(frontier.product_frontier(linked)) == [("5", "p", [0, 3]), ("u1", "p", [0, 0]), ("u2", "p", [0, 1])]


def test_pagination_containers(spark):
    html = (
        "<div class='toolbar'><p><div>in</div><a href='?sp=1'>a</a></div><a href='?sp=2'>b</a>"
        "<ul class='items pages'><li><a href='x?sp=3'>c</a><ul></ul><a href='x?sp=4'>d</a></ul><a href='x?sp=5'>e</a>"
        "<a class='next' href='?xp=6'>f</a><a class='nextt' href='?xp=7'>g</a><a href='/y?a=1&amp;p=8'>h</a><a href='?p=2'>i</a>"
    )
    pages = spark.createDataFrame([(f"{BASE}/c/l", html)], "url string, html string")
    got = [r["url"].removeprefix(BASE) for r in frontier.pagination_urls(pages).orderBy("pos").collect()]
    assert got == ["/c/l?sp=1", "/c/x?sp=3", "/c/x?sp=4", "/c/l?xp=6", "/y?a=1&p=8", "/c/l?p=2"]


# Listing and detail extraction


def _listing(spark, html):
    df = spark.createDataFrame([("p", html, "c", [0])], "page_url string, html string, category_path string, ord array<bigint>")
    return listing.extract_listing(df).orderBy("ord").collect()


def test_listing_shapes(spark):
    html = (
        LD % "{bad" + LD % '[1,[{"@type":"ItemList","itemListElement":[]}],{"@type":["ItemList"]}]'
        + LD % '{"@graph":[{"@type":"ItemList"}]}' + LD % '{"@type":"ItemList"}' + LD % '{"@type":"ItemList","itemListElement":{"a":1}}'
        + LD % '{"@type":"ItemList","itemListElement":["x",null,{"item":"u"},{"item":{"@type":"Product","name":"A","url":"ignored"}},'
        '{"url":"u2","item":{"@type":"Product","name":"B","sku":7}},{"url":"u3","item":{"@type":["Product"],"name":"C"}}]}'
    )
    got = _listing(spark, html)
    assert [(r["product_name"], r["product_url"], r["sku"], r["currency"]) for r in got] == [("A", "", None, "USD"), ("B", "u2", "7", "USD")]
    assert got[0]["image_urls"] == [] and got[0]["specifications"] == {} and got[0]["category_path"] == "c"


def test_escaped_type_is_found(spark):
    html = LD % '{"@type":"\\u0049temList","itemListElement":[{"url":"u","item":{"@type":"Product","name":"A"}}]}'
    assert len(_listing(spark, html)) == 1


def _detail(spark, html, answer=None):
    df = spark.createDataFrame([("u", html, "c", [0])], "page_url string, html string, category_path string, ord array<bigint>")
    answers = None if answer is None else spark.createDataFrame([("u", answer)], "url string, text string")
    return detail.extract_detail(df, answers).first()


def test_detail_cascade(spark):
    assert _detail(spark, LD % '{"@type":"Product","name":"J"}' + "<title>T</title>")["extracted_by"] == "jsonld"
    # The first Product decides: unnamed, the markup is next, not the second Product.
    html = LD % '[{"@type":"Product","name":" "},{"@type":"Product","name":"J"}]' + "<title>T | x</title>"
    got = _detail(spark, html)
    assert (got["extracted_by"], got["record"]["product_name"]) == ("html", "T")
    got = _detail(spark, '<meta property="og:title"><title> &lt;b&gt; | </title>')
    assert got["record"]["product_name"] == "<b>"
    assert _detail(spark, "<title> | x</title>")["extracted_by"] == "none"
    assert _detail(spark, None)["extracted_by"] == "none"


@pytest.mark.parametrize(
    ("body", "price"),
    [
        ('<span class="x price-y">$1,299<sup>.50</sup></span>', 1299.5), ('<span class="price"></span><span class="price">5</span>', None),
        ('<span class="Price">5</span>', None), ('<div class="price">5</div>', None), ('<span class="price">1.234,56</span>', 1.23456),
        ('<span class="price-box"><span class="label">From</span> 12</span> 99', 12.0), ('<span class="price">...</span>', None),
    ],
)
def test_detail_price(spark, body, price):
    assert _detail(spark, "<title>T</title>" + body)["record"]["price"] == price


@pytest.mark.parametrize(
    ("body", "sku", "with_label"),
    [
        ("<p>SKU: ABC123</p>", "ABC123", "SKU"), ("<p>Item # 12345</p>", "12345", "12345"), ("<div>sku: <b>XY-999</b></div>", "999", "999"),
        ("<p>Product Code AB</p>", None, None), ("<div><span>SKU</span><b>ABC</b></div>", None, "SKU"), ("<p>none 12345</p>", None, None),
        ("<div><br>Item#<i>A1</i>B2</div>", "A1B2", "A1B2"),
    ],
)
def test_detail_sku(spark, body, sku, with_label):
    page = f"<html><head><title>SKU HEAD99</title></head><body>{body}</body></html>"
    df = spark.createDataFrame([("u", page)], "page_url string, html string")
    parts = detail.with_markup_parts(df)
    kept, cut = (detail.markup_columns(k)["sku"] for k in (True, False))
    got = parts.select(cut.alias("cut"), kept.alias("kept")).first()
    assert got["cut"] == sku
    assert got["kept"] == with_label


def test_detail_meta(spark):
    got = _detail(spark, "<META NAME=description CONTENT='  '><title>T</title><meta property=og:image>")["record"]
    assert got["description"] == "" and got["image_urls"] == [""] and got["currency"] == "USD"


@pytest.mark.parametrize(
    ("answer", "name", "price"),
    [
        ('{"product_name":"A","price":"2.5"}', "A", 2.5), ("```json\n{\"price\":0}\n```", "Unknown", None), ("no", None, None),
        ("{}", None, None), ('[{"product_name":"A"}]', None, None), ('{"product_name":null}', None, None),
        ('{"product_name":"A","price":"x"}', None, None), ('{"product_name":"A","price":""}', "A", None), ("```{}```", None, None),
        ('{"product_name":"A","specifications":5}', None, None), ("```\n{\"product_name\":\"A\"}", "A", None),
    ],
)
def test_model_answers(spark, answer, name, price):
    got = _detail(spark, "<p>x</p>", answer)
    assert got["extracted_by"] == ("model" if name else "none")
    if name:
        assert (got["record"]["product_name"], got["record"]["price"]) == (name, price)


def test_model_answer_nested_values(spark):
    got = _detail(spark, "", '{"product_name":"A","specifications":{"a":1,"b":"x","c":{"d":[1]}},"image_urls":["i"],"unit_pack_size":"10"}')
    assert got["record"]["specifications"] == {"a": "1", "b": "x", "c": '{"d":[1]}'}
    assert got["record"]["image_urls"] == ["i"] and got["record"]["unit_pack_size"] == "10"


# Validation


def _raw(spark, *items):
    """Rows of ``name, url, sku`` with optional further fields."""
    cols = [c.split()[0] for c in product_ddl().split(", ")]
    base = dict.fromkeys(cols) | {"category_path": "", "currency": "USD", "specifications": {}, "image_urls": [], "alternative_products": []}
    data = []
    for i, (name, url, sku, extra) in enumerate(items):
        data.append(tuple((base | {"product_name": name, "product_url": url, "sku": sku, "ord": [i]} | extra)[c] for c in cols))
    df = spark.createDataFrame(data, product_ddl())
    return df.drop("fingerprint").withColumn("page_url", F.lit("p"))


def test_rejects(spark):
    raw = _raw(spark, ("ab", "u", None, {}), (" a ", "u", None, {}), (None, "u", None, {}), ("ab", "", None, {}), ("a", "", None, {}), ("&amp;", "u", "s", {}))
    got = [r["drop_reason"] for r in validate.rejects(raw).orderBy("ord").collect()]
    assert got == ["short_name", "short_name", "no_url", "short_name"]
    assert [r["product_name"] for r in validate.validate(raw).orderBy("ord").collect()] == ["ab", "&"]


def test_first_wins_and_counts(spark):
    raw = _raw(
        spark, ("first", "u", " s1", {}), ("second", "u", "S1 ", {}), ("other", "u", None, {}), ("empty", "u", "", {}), ("x", "u", "s", {})
    )
    assert [r["product_name"] for r in validate.validate(raw).orderBy("ord").collect()] == ["first", "other"]
    assert validate.validation_stats(raw).first().asDict() == {"total": 5, "valid": 2, "duplicates": 2, "dropped": 1}
    assert validate.summary(validate.validation_stats(raw)).first()[0] == "Validation: 5 total, 2 valid, 2 duplicates, 1 dropped"
    assert validate.validation_stats(raw.limit(0)).first().asDict() == {"total": 0, "valid": 0, "duplicates": 0, "dropped": 0}


def test_normalize_fields(spark):
    prices = [0.0, 50000.0, 50000.01, -0.01, float("nan"), float("inf"), None]
    raw = _raw(spark, *[(f"p{i}", f"u{i}", None, {"price": p, "image_urls": ["b", "a", "b"]}) for i, p in enumerate(prices)])
    got = validate.validate(raw).orderBy("ord").collect()
    assert [r["price"] if r["price"] == r["price"] else "nan" for r in got] == [0.0, 50000.0, None, None, "nan", None, None]
    assert got[0]["image_urls"] == ["b", "a"]


@pytest.mark.parametrize(
    ("value", "want"),
    [("InStock", "In Stock"), (" in stock ", "In Stock"), ("OutOfStock", "Out of Stock"), ("PreOrder", "Pre-Order"),
     ("BackOrder ", "BackOrder "), ("", ""), (None, None), ("not in stock: out of stock", "In Stock")],
)
def test_availability(cells, value, want):
    assert cells([value], validate.normal_availability(F.col("value"))) == [want]


def test_normalising_twice_changes_nothing(spark):
    raw = _raw(spark, (" a &lt; b ", "u", " x ", {"brand": "B  C", "availability": "InStock", "price": 60000.0}))
    once = validate.validate(raw)
    again = validate.normalize(once)
    assert once.drop("ord").collect() == again.select(*once.drop("ord").columns).collect()


def test_result_does_not_depend_on_layout(spark):
    raw = _raw(spark, *[(f"n{i}", f"u{i % 7}", f"s{i % 3}", {}) for i in range(60)])
    want = rows(validate.validate(raw).select("fingerprint", "product_name"))
    for n in (1, 3, 17):
        assert rows(validate.validate(raw.repartition(n)).select("fingerprint", "product_name")) == want


def test_hot_key_shrinks_before_the_shuffle(spark):
    plan = validate.validate(_raw(spark, ("ab", "u", "s", {})))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


# Merge and reports


def test_merge(spark):
    stored = validate.validate(
        _raw(spark, ("first", "u1", "a", {}), ("same url", "u1", "b", {}), ("has text", "u2", None, {"description": "old"}), ("blank", "u3", None, {"description": ""}))
    )
    details = _raw(
        spark, ("d", "u1", "z", {"description": "new", "specifications": {"k": "v"}}), ("d", "u2", None, {"description": "new"}),
        ("d", "u3", None, {"description": ""}), ("Raw &amp;", "u4", "low", {"availability": "InStock", "price": 99999.0}),
    )
    got = {r["fingerprint"]: r for r in merge.merge_details(stored, details).collect()}
    by_name = {r["product_name"]: r for r in got.values()}
    assert by_name["first"]["description"] == "new" and by_name["first"]["specifications"] == {"k": "v"}
    assert by_name["same url"]["description"] is None
    assert by_name["has text"]["description"] == "old"
    assert by_name["blank"]["description"] == ""
    added = by_name["Raw &amp;"]
    assert (added["sku"], added["availability"], added["price"]) == ("low", "InStock", 99999.0)
    assert len(got) == 5


def test_reports(spark):
    products = validate.validate(
        _raw(spark, ("p1", "u1", "a", {"category_path": "c > s", "price": 1.0}), ("p2", "u2", "", {"category_path": "c > t"}),
             ("p3", "u3", None, {"category_path": "c > s", "image_urls": ["i"]}), ("p4", "u4", None, {"category_path": "d"}))
    )
    assert rows(reports.category_report(products)) == [("c", 3, 2), ("d", 1, 0)]
    got = {r["field"]: (r["filled"], r["total"], r["pct"]) for r in reports.field_coverage(products).collect()}
    assert got == {"price": (1, 4, 25.0), "image_urls": (1, 4, 25.0), "sku": (1, 4, 25.0), "rating": (0, 4, 0.0), "description": (0, 4, 0.0)}
