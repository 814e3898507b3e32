"""JSON-LD parsing rules on odd documents."""

import math

import pytest
from pyspark.sql import functions as F

from shelfline.functions import jsonld
from shelfline.operators.listing import extract_listing, script_rejects

V = F.col("value")


@pytest.mark.parametrize(
    ("raw", "blocks"),
    [
        ('{"a":1}', 1), ("[1,{}]", 2), ("[]", 0), ("", None), ("{", None), ('{"a":1} xyz', None), ('{"a":1},{"b":2}', None),
        ('{"a":1}], [', None), ("  {}\n", 1), ("null", 1), ('"text"', 1), ("{'a':1}", None), ('{"a":"x\ny"}', None),
    ],
)
def test_blocks(cells, raw, blocks):
    got = cells([raw], F.size(F.coalesce(jsonld.blocks(V), F.lit(None).cast("array<variant>"))))[0]
    assert (None if got in (-1, None) else got) == blocks


def test_last_duplicate_key_wins(cells):
    got = cells(['{"a":1,"a":2}'], F.try_variant_get(F.get(jsonld.blocks(V), F.lit(0)), "$.a", "int"))
    assert got == [2]


def _item(cells, raw, build):
    return cells([raw], build(F.try_parse_json(V)))[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"name":"  x "}', "x"), ('{"name":null}', ""), ("{}", ""), ('{"name":12}', "12"), ('{"name":["x"]}', ""),
    ],
)
def test_name(cells, raw, want):
    assert _item(cells, raw, jsonld.product_name) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"offers":{"price":12.5}}', 12.5), ('{"offers":[{"price":"7"},{"price":8}]}', 7.0), ('{"offers":[]}', None),
        ('{"offers":null}', None), ("{}", None), ('{"offers":{"price":true}}', 1.0), ('{"offers":{"price":"1,2"}}', None),
        ('{"offers":{"price":[1]}}', None), ('{"offers":"x"}', None), ('{"offers":{"price":null}}', None),
    ],
)
def test_price(cells, raw, want):
    assert _item(cells, raw, lambda i: jsonld.price(jsonld.offer(i))) == want


def test_nan_price_is_kept(cells):
    assert math.isnan(_item(cells, '{"offers":{"price":"nan"}}', lambda i: jsonld.price(jsonld.offer(i))))


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('"https://schema.org/InStock"', "InStock"), ('"In"', "In"), ('""', None), ('"x/"', ""), ("null", None),
    ],
)
def test_availability(cells, raw, want):
    got = _item(cells, f'{{"availability":{raw}}}', jsonld.availability)
    assert got == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('"a?w=1?x"', ["a"]), ('["a?b","a","c"]', ["a", "a", "c"]), ("null", []), ('{"url":"u?x"}', ["u"]),
        ('[{"url":"u"},5,"v"]', ["u", "v"]), ('""', [""]), ("[]", []),
    ],
)
def test_images(cells, raw, want):
    assert _item(cells, f'{{"image":{raw}}}', lambda i: jsonld.images(jsonld.node(i, "$.image"))) == want


def test_absent_image(cells):
    assert _item(cells, "{}", lambda i: jsonld.images(jsonld.node(i, "$.image"))) == []


@pytest.mark.parametrize(
    ("raw", "rating", "count"),
    [
        ('{"ratingValue":"4.5","reviewCount":12}', 4.5, 12), ('{"ratingValue":4}', 4.0, 0), ('{"reviewCount":3}', 0.0, 3),
        ('{"ratingValue":"x","reviewCount":3}', None, None), ('{"ratingValue":1,"reviewCount":"12.7"}', 1.0, None),
        ('{"ratingValue":1,"reviewCount":12.7}', 1.0, 12), ('{"ratingValue":null,"reviewCount":3}', None, None),
        ('{"ratingValue":1,"reviewCount":null}', 1.0, None), ("{}", None, None), ("null", None, None), ('"4.5"', None, None),
        ("[]", None, None), ('{"x":1}', 0.0, 0),
    ],
)
def test_rating(cells, raw, rating, count):
    node = lambda i: jsonld.node(i, "$.r")
    assert _item(cells, f'{{"r":{raw}}}', lambda i: jsonld.rating(node(i))) == rating
    assert _item(cells, f'{{"r":{raw}}}', lambda i: jsonld.review_count(node(i))) == count


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"name":"B"}', "B"), ('{"@type":"Brand"}', None), ('{"name":""}', ""), ('"B"', "B"), ('""', None), ("null", None),
        ("5", "5"), ("0", None), ("false", None), ("true", "true"), ("[]", None), ('["B"]', '["B"]'), ('"0"', "0"),
    ],
)
def test_brand(cells, raw, want):
    assert _item(cells, f'{{"brand":{raw}}}', lambda i: jsonld.brand(jsonld.node(i, "$.brand"))) == want


def test_absent_brand(cells):
    assert _item(cells, "{}", lambda i: jsonld.brand(jsonld.node(i, "$.brand"))) is None


def test_bare_number_words(spark):
    page = """<script type="application/ld+json">{"@type":"ItemList","itemListElement":[
      {"url":"/a","item":{"@type":"Product","name":"A, NaN, b","offers":{"price":NaN}}},
      {"url":"/b","item":{"@type":"Product","name":"B","offers":{"price":-Infinity}}}]}</script>
      <script type="application/ld+json">{"@type":"ItemList","name":"x: NaN, y"}</script>
      <script type="application/ld+json">{"@type":"ItemList", oops}</script>"""
    pages = spark.createDataFrame([("u", page)], "page_url string, html string")
    rows = extract_listing(pages.withColumns({"category_path": F.lit(""), "ord": F.array(F.lit(0).cast("bigint"))})).orderBy("product_url").collect()
    assert [(r.product_url, str(r.price)) for r in rows] == [("/a", "nan"), ("/b", "-inf")]
    assert [(r.script_pos, r.reason) for r in script_rejects(pages).collect()] == [(2, "not JSON")]
