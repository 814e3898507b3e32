"""Render a web shop (category, listing and detail pages) from the ``part`` table, inside Spark.

Every irregularity of a page follows from arithmetic on the part key, so the products an extraction must
find can be computed from ``part`` alone. A page holds the parts of one key range, so no group grows with
the table: about 50 products per listing, at most 100 listings per category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = "https://shop.example.com"
IMAGES = "https://img.example.com"

# Part types in seed order.
TYPES = ("economy", "large", "medium", "promo", "small", "standard")
RACK, DEAL, SHELF = 300, 6_000, 30_000
FETCHED = "2024-05-01 00:00:00"

NBSP, WIDE = "\u00a0", "\u3000"


def _text(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])


def _cases(*pairs: tuple[Column | None, Column | str]) -> Column:
    """First matching case; a final pair without condition is the default, null otherwise."""
    out = None
    for cond, value in pairs:
        value = F.lit(value) if isinstance(value, str) else value
        if cond is None:
            return out.otherwise(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def _parts(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("k"),
        F.col("p_name").alias("nm"),
        F.col("p_brand").alias("br"),
        F.lower("p_type").alias("t"),
        F.col("p_retailprice").cast("string").alias("pr"),
        F.floor(k / RACK).alias("g"),
        F.floor(k / DEAL).alias("d"),
        F.floor(k / SHELF).alias("c"),
    )


def _slug() -> Column:
    return _text("/catalog/", F.col("t"), "-", F.col("c"))


def _path() -> Column:
    return _text(_slug(), F.when(F.col("t") == "large", "/").otherwise(""))


def seeds(part: DataFrame) -> DataFrame:
    """``seed_ord, path`` of every category."""
    place = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("t")) - 1
    shelves = _parts(part).select("t", "c").distinct()
    return shelves.select((F.col("c") * len(TYPES) + place).cast("bigint").alias("seed_ord"), _path().alias("path"))


def product_json() -> Column:
    """JSON-LD Product of one part, with every supported shape of every field."""
    k, nm, br, pr = F.col("k"), F.col("nm"), F.col("br"), F.col("pr")
    name = _cases(
        (k % 27 == 3, "Z"),
        (k % 36 == 4, "   "),
        (k % 45 == 5, "&amp;"),
        (k % 9 == 0, _text("  ", nm, " ", k, "  ")),
        (k % 9 == 1, _text(nm, " &amp; Co &copy2 ", k)),
        (k % 9 == 2, _text(NBSP, nm, NBSP, WIDE, " ", k)),
        (None, _text(nm, " ", k)),
    )
    sku = _cases(
        (k % 5 == 1, _text(',"sku":" ab-', k, ' "')),
        (k % 5 == 2, _text(',"sku":', k)),
        (k % 5 == 3, ',"sku":""'),
        (k % 5 == 4, _text(',"sku":"SKU', k, '"')),
        (None, ""),
    )
    brand = _cases(
        (k % 6 == 0, _text(',"brand":{"@type":"Brand","name":"', br, '"}')),
        (k % 6 == 1, _text(',"brand":"', br, '"')),
        (k % 6 == 2, ',"brand":{"@type":"Brand"}'),
        (k % 6 == 3, ',"brand":null'),
        (k % 6 == 5, _text(',"brand":{"name":" ', br, ' &amp; Sons "}')),
        (None, ""),
    )
    price = _cases(
        (k % 8 == 2, _text(',"price":"', pr, '"')),
        ((k % 8 == 3) & (k % 3 == 0), ',"price":" 1_000.5 "'),
        ((k % 8 == 3) & (k % 3 == 1), ',"price":"1,299.00"'),
        (k % 8 == 3, ',"price":"12.5d"'),
        (k % 8 == 4, ',"price":-5'),
        (k % 8 == 5, ',"price":50000'),
        (k % 8 == 6, ',"price":"50000.01"'),
        (k % 16 == 7, ',"price":null'),
        (k % 16 == 15, ""),
        (None, _text(',"price":', pr)),
    )
    currency = _cases((k % 3 == 0, ',"priceCurrency":"EUR"'), (None, ""))
    stock = _cases(
        (k % 10 == 0, ',"availability":"https://schema.org/InStock"'),
        (k % 10 == 1, ',"availability":"https://schema.org/OutOfStock"'),
        (k % 10 == 2, ',"availability":"http://schema.org/PreOrder"'),
        (k % 10 == 3, ',"availability":"https://schema.org/BackOrder"'),
        (k % 10 == 4, ',"availability":" in stock "'),
        (k % 10 == 6, ',"availability":""'),
        (k % 10 == 7, ',"availability":"https://schema.org/"'),
        (k % 10 == 8, ',"availability":"Currently Out of Stock"'),
        (k % 10 == 9, ',"availability":"LimitedAvailability "'),
        (None, ""),
    )
    offer = _text('{"@type":"Offer"', price, currency, stock, "}")
    offers = _cases(
        (k % 7 == 4, _text(',"offers":[', offer, ',{"price":1,"priceCurrency":"GBP"}]')),
        (k % 7 == 5, ',"offers":[]'),
        (k % 7 == 6, ""),
        (None, _text(',"offers":', offer)),
    )
    half, url = F.floor(k / 2) % 5, _text(IMAGES, "/", k)
    image = _cases(
        (half == 0, _text(',"image":"', url, '.jpg?width=100"')),
        (half == 1, _text(',"image":["', url, '.jpg?w=1","', url, '.jpg?w=2","', url, '-b.jpg"]')),
        (half == 3, _text(',"image":{"@type":"ImageObject","url":"', url, '.jpg?x"}')),
        (half == 4, _text(',"image":[{"url":"', url, '-o.jpg"},"', url, '.jpg"]')),
        (None, ""),
    )
    third = F.floor(k / 3) % 6
    rating = _cases(
        ((third == 0) & (k % 2 == 0), ',"aggregateRating":{"ratingValue":"4.5","reviewCount":12.7}'),
        (third == 0, ',"aggregateRating":{"ratingValue":"4.5","reviewCount":" 12 "}'),
        (third == 1, ',"aggregateRating":{"ratingValue":4.2}'),
        (third == 2, ',"aggregateRating":{"ratingValue":3.9,"reviewCount":"12.7"}'),
        (third == 3, ',"aggregateRating":{"ratingValue":"good","reviewCount":5}'),
        (third == 4, ',"aggregateRating":{}'),
        (None, ""),
    )
    description = _cases(
        (k % 16 == 0, _text(',"description":"Desc &lt;', k, '&gt; for\\n  ', k, '"')),
        (k % 16 == 1, ',"description":""'),
        (None, ""),
    )
    return _text('{"@type":"Product","name":"', name, '"', sku, brand, offers, image, rating, description, "}")


def product_address() -> Column:
    """Address of a part's detail page as its listing gives it; null where the listing has none."""
    k = F.col("k")
    return _cases(
        (k % 13 == 0, F.lit(None).cast("string")),
        (k % 17 == 0, _text(BASE, "/product/", k - 1)),
        (None, _text(BASE, "/product/", k)),
    )


def _elements(parts: DataFrame) -> DataFrame:
    address = F.coalesce(_text('"url":"', product_address(), '",'), F.lit(""))
    element = _text('{"@type":"ListItem",', address, '"item":', product_json(), "}")
    return parts.withColumn("element", element)


def _ld(body: Column | str, attrs: str = 'type="application/ld+json"') -> Column:
    return _text(f"<script {attrs}>", body, "</script>")


def _item_list(elements: Column) -> Column:
    return _text('{"@context":"https://schema.org","@type":"ItemList","itemListElement":[', elements, "]}")


def _joined(rows: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(rows), lambda r: r["element"]), ",")


_GHOST = '<!-- <script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"url":"g","item":{"@type":"Product","name":"Ghost"}}]}</script> -->'
_BROKEN = '<script type="application/ld+json">{"@type":"ItemList","itemListElement":[],}</script>'
_TRACK = '<script>var t="</p><a href=\'/catalog/tracked\'>x</a>";</script>'
_SITE = '{"@type":"WebSite","name":"Sample shop"}'


def _service(tag: Column) -> Column:
    return _text('{"@type":"ListItem","url":"', BASE, "/info/", tag, '","item":{"@type":"Service","name":"Help"}}')


def _pager(url: Column) -> Column:
    return _text(
        '<div class="x toolbar y"><div><a href="?p=2">2</a></div><a href="?sp=9">s</a></div><a href="?sp=1">no</a>',
        '<ul class="items pages"><li><a class="page" href="', F.replace(url, F.lit(BASE), F.lit("")),
        '?dir=asc&amp;p=3">3</a><li><a href="#top">top</a></ul><a class="action next" href="//cdn.example.com/next?up=1">n</a>',
        '<a href="rack-x?p=4#top">4</a><a href="?page=2">p</a>',
    )


def _listing_html(title: Column, scripts: Column, url: Column) -> Column:
    return _text(
        "<!DOCTYPE html><html><head><title>", title, " | Sample shop</title>", _GHOST, _BROKEN, _TRACK, scripts,
        "</head><body><h1>", title, "</h1>", _pager(url), "</body></html>",
    )


def listing_pages(part: DataFrame) -> DataFrame:
    """Rack pages (all parts of a key range and type) and deal pages (every twentieth part again)."""
    parts = _elements(_parts(part))
    pair = F.struct("k", "element")
    odd = F.col("g") % 3 == 2
    racks = parts.groupBy("t", "c", "g").agg(
        F.collect_list(F.when(~odd | (F.col("k") % 2 == 0), pair)).alias("one"),
        F.collect_list(F.when(odd & (F.col("k") % 2 == 1), pair)).alias("two"),
    )
    url = _text(BASE, _slug(), "/rack-", F.col("g"))
    comma = F.when(F.size("one") > 0, ",").otherwise("")
    first = _item_list(_text(_joined(F.col("one")), comma, _service(F.col("g"))))
    scripts = _text(
        _cases(
            (F.col("g") % 2 == 1, _ld(_text(f"[{_SITE},", first, "]"), "id='ld' type='application/ld+json'")),
            (None, _text(_ld(_SITE), _ld(first))),
        ),
        F.when(odd, _ld(_item_list(_joined(F.col("two"))))).otherwise(""),
    )
    rack_pages = racks.select(
        url.alias("url"),
        F.when(F.col("g") % 7 == 3, 503).otherwise(200).alias("status"),
        _listing_html(_text("Rack ", F.col("g")), scripts, url).alias("html"),
    )
    deals = parts.filter(F.col("k") % 20 == 0).groupBy("t", "c", "d").agg(F.collect_list(pair).alias("one"))
    deal_url = _text(BASE, _slug(), "/deals-", F.col("d"))
    deal_pages = deals.select(
        deal_url.alias("url"),
        F.lit(200).alias("status"),
        _listing_html(_text("Deals ", F.col("d")), _ld(_item_list(_joined(F.col("one")))), deal_url).alias("html"),
    )
    return rack_pages.unionByName(deal_pages)


def _rack_anchor(g: Column) -> Column:
    """Anchor of a rack in one of four spellings."""
    path = _text(_slug(), "/rack-", g)
    label = _text("<span> Rack </span><b>&amp; <i>", g, "</i></b>")
    return _cases(
        (g % 4 == 0, _text('<a class="nav" href="', path, '">', label, "</a>")),
        (g % 4 == 1, _text('<a href="', BASE, path, '/">', label, "</a>")),
        (g % 4 == 2, _text("<A title='a > b' HREF=' ", path, "' >", label, "</A>")),
        (None, _text('<a href="', path, '"><img src="x.png"></a>')),
    )


def category_pages(part: DataFrame) -> DataFrame:
    """Category pages: anchors, JSON-LD only (standard), a listing of their own (promo), or missing (medium)."""
    parts = _elements(_parts(part))
    shelves = parts.groupBy("t", "c").agg(
        F.sort_array(F.collect_set("g")).alias("gs"),
        F.sort_array(F.collect_set(F.when(F.col("k") % 20 == 0, F.col("d")))).alias("ds"),
        F.collect_list(
            F.when((F.col("t") == "promo") & (F.col("k") % 25 == 0), F.struct("k", "element"))
        ).alias("own"),
    )
    anchors = _text(
        F.array_join(F.transform("gs", _rack_anchor), "\n"),
        F.array_join(
            F.transform("ds", lambda d: _text("<a href='", _slug(), "/deals-", d, "'>Deals ", d, "</a>")), "\n"
        ),
        '<a href="', _slug(), '/rack-0?sort=asc">Sorted</a>',
        '<a href="', _slug(), "/rack-", F.get("gs", F.lit(0)), '/">again</a>',
        '<a href="', _slug(), '/rack-0/extra">deep</a><a href="https://other.example.org', _slug(), '/rack-0">off</a>',
        '<a href="', _slug(), '">same</a><a href="/product/5">p</a><a href="', _slug(), '/product/6">p</a>',
        '<a href="#top">t</a><a href="mailto:x@example.com">m</a><!-- <a href="', _slug(), '/hidden">h</a> -->',
    )

    def pages_of(kind: str, label: str):
        return lambda i: _text(
            '{"item":{"@type":"CollectionPage","name":"', label, " ", i, '","url":"', BASE, _slug(), f"/{kind}-", i,
            F.when(i % 2 == 1, "/").otherwise(""), '"}}',
        )

    nav = F.concat(F.transform("gs", pages_of("rack", "Rack")), F.transform("ds", pages_of("deals", "Deals")))
    other = _text('{"item":{"@type":"Category","name":"Late","url":"', BASE, _slug(), '/late"}}')
    jsonld = _ld(_text("[", _item_list(F.array_join(nav, ",")), ",", _item_list(other), "]"))
    content = _cases(
        (F.col("t") == "standard", jsonld),
        (F.col("t") == "promo", _ld(_item_list(_joined(F.col("own"))))),
        (F.col("t") == "medium", "<h1>Not found</h1>"),
        (None, anchors),
    )
    return shelves.select(
        _text(BASE, _path()).alias("url"),
        F.when(F.col("t") == "medium", 404).otherwise(200).alias("status"),
        _text("<html><head><title>", F.col("t"), "</title></head><body>", _TRACK, content, "</body></html>").alias("html"),
    )


def detail_pages(part: DataFrame) -> DataFrame:
    """Detail pages: JSON-LD, markup, title only, or nothing to read."""
    k, nm = F.col("k"), F.col("nm")
    about = F.when(k % 8 == 0, _text(',"description":"About ', k, '"')).otherwise("")
    html = _cases(
        (
            k % 4 == 0,
            _text(
                "<html><head><title>Wrong</title>", _ld('{"@type":"Organization","name":"Shop"}'),
                _ld(_text('{"@type":"Product","name":"Detail ', nm, '","sku":"d', k, '","offers":{"price":', k,
                          ',"availability":"https://schema.org/InStock"}', about, "}")),
                "</head><body></body></html>",
            ),
        ),
        (
            k % 4 == 1,
            _text(
                '<html><head><title>Item number SKU</title><meta property="og:title" content=" Og &amp; ', nm, " ", k, ' ">',
                "<meta name='description' content=\" Meta ", k, '"><meta content="', IMAGES, "/og/", k,
                '.png?a=1&amp;b=2" property="og:image"></head><body><span class="label">7</span>',
                '<span class="old price-box">From <span>&#36;</span><b>1,', k, ".5</b> USD</span><span>9</span>",
                "<div><p>Text</p><div class=\"meta\"><br>SKU: <b>ZX", k, "</b></div></div></body></html>",
            ),
        ),
        (k % 4 == 2, _text("<html><head><title> ", nm, "\n ", k, " | Shop</title></head><body>plain</body></html>")),
        (None, _text("<html><body><p>Script only ", k, "</p></body></html>")),
    )
    return _parts(part).select(
        _text(BASE, "/product/", k).alias("url"), F.when(k % 11 == 5, 404).otherwise(200).alias("status"), html.alias("html")
    )


def shop_pages(part: DataFrame) -> DataFrame:
    """All pages of the shop in snapshot form."""
    return stamped(category_pages(part).unionByName(listing_pages(part)).unionByName(detail_pages(part)))


def stamped(pages: DataFrame) -> DataFrame:
    """Pages with their fetch time."""
    return pages.withColumn("fetched_at", F.lit(FETCHED).cast("timestamp"))


def with_history(shop: DataFrame) -> DataFrame:
    """The shop's pages and, for half of the addresses, a snapshot of the day before: failed, or with other content."""
    h = F.pmod(F.xxhash64("url"), F.lit(6))
    other = F.concat(F.replace(F.replace("html", F.lit('"price"'), F.lit('"was"')), F.lit("Desc"), F.lit("Before")), F.lit("<!-- old -->"))
    older = shop.filter(h < 3).select(
        "url", F.when((h == 0) & (F.col("status") == 200), 503).otherwise(200).cast("int").alias("status"),
        F.coalesce(other, F.lit('<html><a href="/catalog/gone">Gone</a></html>')).alias("html"),
        (F.col("fetched_at") - F.expr("INTERVAL 1 DAY")).alias("fetched_at"),
    )
    return shop.select(*older.columns).unionByName(older)


def model_answers(part: DataFrame) -> DataFrame:
    """Offline model answers ``url, text`` for the unreadable detail pages: plain, fenced or broken JSON."""
    k, nm = F.col("k"), F.col("nm")
    body = _text(
        '{"product_name":"Model ', nm, '","brand":null,"sku":"m', k, '","price":"', k, '.25","availability":"InStock",',
        '"description":"Seen ', k, '","unit_pack_size":"Box of ', k, '","specifications":{"size":"', k,
        '","count":3},"image_urls":["', IMAGES, "/m/", k, '.png"]}',
    )
    text = _cases(
        (k % 12 == 3, body),
        (k % 12 == 7, _text("  ```json\n", body, "\n```\n")),
        (None, _text("Sorry, page ", k, " shows no product.")),
    )
    return _parts(part).filter(k % 4 == 3).select(_text(BASE, "/product/", k).alias("url"), text.alias("text"))
