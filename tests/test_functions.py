"""Column functions against hand-written cases and the standard library."""

import html
import math
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.functions import keys, markup, numbers, text, urls

V = F.col("value")
SPACES = [" a ", " a　b\x1c", " ", "", "a", "\x85x ", " \t\n x  y \r\n", "x​ "]


def test_strip_matches_python(cells):
    assert cells(SPACES, text.strip(V)) == [v.strip() for v in SPACES]


def test_collapse(cells):
    assert cells(SPACES, text.collapse(V)) == [" ".join(v.split()) for v in SPACES]


@pytest.mark.parametrize("value", ["n95 masks 3m o'neil", "", "a-b", "ABC dEF", "x1y2z", "éclair ünd"])
def test_title_case(cells, value):
    assert cells([value], text.title_case(V)) == [value.title()]


def test_decode_entities_is_single_pass(cells):
    values = ["&amp;amp;", "&copy2", "&notit;", "a & b", None, "&#8364;&nbsp;x", "plain"]
    got = cells(values, F.get(text.decode_entities(F.array(V)), F.lit(0)))
    assert got == [None if v is None else html.unescape(v) for v in values]


FLOATS = ["12.5", " 12.5 ", "1e3", "1_000.5", "12.5d", "12.5f", "1,299.00", "nan", "-inf", "Infinity", "", "abc", "1__0",
          "_1", "1_", "+.5", "5.", ".", "0x10", " 7 ", "1e", "-1.5E-3", "12 3"]


def _python(kind, value):
    try:
        return kind(value)
    except ValueError:
        return None


def test_parse_float_matches_python(cells):
    for value, got in zip(FLOATS, cells(FLOATS, numbers.parse_float(V))):
        want = _python(float, value)
        assert got == want or (math.isnan(want) and math.isnan(got)), value


def test_parse_int_matches_python(cells):
    values = ["12", " 12 ", "12.7", "1_000", "+5", "-5", "", "1,000", "12a"]
    assert cells(values, numbers.parse_int(V)) == [_python(int, v) for v in values]


def test_parse_int_beyond_64_bits(cells):
    assert cells(["9" * 30], numbers.parse_int(V)) == [None]


def test_first_number(cells):
    assert cells(["From $1,299.50 now", "1.234,56", "...", "none", "7"], numbers.first_number(V)) == [
        1299.5, 1.23456, None, None, 7.0,
    ]


def test_fingerprint_keeps_separator(spark):
    row = spark.sql("SELECT 'u' AS u, CAST(NULL AS STRING) AS s, md5('u|') AS want")
    got = row.select(keys.fingerprint(F.col("u"), F.col("s")).alias("got"), "want").first()
    assert got["got"] == got["want"]


REFS = ["", "a", "/a/b/", "../x", "../../../x", "./", "..", "?p=2", "#top", "?", "#", "//cdn.example.com/y?z#f", "http://h/x?",
        "https://h/a/../b", "mailto:me@x", "a/./b/../c?q=1#f", "a//b", "/a//b/", "  /pad", "x\ty", "HTTPS://H/q", "g;x=1/../y"]


@pytest.mark.parametrize("base", ["https://shop.example.com", "https://h/a/b/c?q=1#f", "https://h/a/b/", "http://h/?x"])
def test_resolve_url_matches_python(cells, base):
    got = cells(REFS, urls.resolve_url(F.lit(base), V))
    want = [urljoin(base, r) for r in REFS]
    assert [(r, g) for r, g in zip(REFS, got)] == [(r, w) for r, w in zip(REFS, want)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab/.?#&=", max_size=12), min_size=20, max_size=20))
def test_resolve_url_property(cells, refs):
    base = "https://h.example/a/b/c?k=v"
    got = cells(refs, urls.resolve_url(F.lit(base), V))
    assert got == [urljoin(base, r) for r in refs]


def _nodes(value):
    return text.node_text(markup.text_nodes(value))


def test_ld_scripts(cells):
    page = (
        "<!-- <script type='application/ld+json'>{\"hidden\":1}</script> -->"
        "<script type=\"application/ld+json; charset=utf-8\">no</script>"
        "<script>var s = '<!-- <script type=\"application/ld+json\">no';</script>"
        "<SCRIPT id=x TYPE='application/ld+json' data-a=\"1>0\">one</SCRIPT >"
        "<script type=application/ld+json>two < 3</script>"
        "<script type=\"application/LD+JSON\">no</script><script type='application/ld+json'></script>"
        "<script type=\"application/ld+json\">open"
    )
    assert cells([page], markup.ld_scripts(V)) == [["one", "two < 3", "open"]]


def test_anchors_end_at_the_next_one(cells):
    page = "<a href=1>one<a class='x' href=\"2\">t<b>w</b>o</a> out <abbr>no</abbr><A HREF='3'>three"
    found = markup.anchors(V)
    assert cells([page], F.transform(found, lambda a: markup.attribute(a, "href"))) == [["1", "2", "3"]]
    assert cells([page], F.transform(found, _nodes)) == [["one", "two", "three"]]


@pytest.mark.parametrize(
    ("tag", "want"),
    [
        ('<a href="x">', "x"), ("<a HREF = 'x y'>", "x y"), ("<a href=x/y>", "x/y"), ("<a data-href=no>", None),
        ("<a title=' href=\"no\"' href=yes>", "yes"), ("<a title=\"a > b\" href=\"q\">", "q"), ('<a href="">', ""),
        ("<a href>", None), ("<a title='x'href='z'>", "z"), ("<a hreflang=en href=z>", "z"), ("<a disabled href=z>", "z"),
    ],
)
def test_attribute(cells, tag, want):
    assert cells([tag], markup.attribute(V, "href")) == [want]


def test_hidden_markup_splits_text(cells):
    assert cells(["a<!-- x --> b <script>c</script>d<style>e</style>"], _nodes(markup.visible(V))) == ["abd"]


def test_unclosed_blocks_are_linear(cells):
    page = "<!--" * 50_000 + "<script " * 50_000 + "<a " * 50_000 + "<a href=1>" * 20_000 + " " * 200_000 + "x"
    assert cells([page], F.size(markup.anchors(markup.visible(V)))) == [0]
    assert cells(["<a href=1>" * 100_000], F.size(markup.anchors(markup.visible(V)))) == [100_000]
    assert cells([" x" + " " * 300_000 + "y "], F.length(text.strip(V))) == [300_002]


def test_title_and_body(cells):
    page = "<html><head><title x=1>A | B</title></head><body class=y>in</body></html>"
    assert cells([page], _nodes(markup.title_text(V))) == ["A | B"]
    assert cells([page, "<title>t</title>bare"], _nodes(markup.body(V))) == ["in", "bare"]


def test_element_text_nesting(cells):
    deep = "a<span>b<span>c<span>d</span></span></span>e</span>f"
    flat = "a<b>b</b></span>c"
    assert cells([deep, flat, "</span>x"], text.node_text(markup.element_text(V, "span"))) == ["abcde", "ab", ""]
