"""Frontier discovery: links, subcategories, listings, product pages and pagination.

Everything about one page is decided inside its row with arrays, so discovery itself never shuffles.
Only "first URL wins" across pages does, on URLs alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonld, markup
from ..functions.bind import let
from ..functions.text import blank_to_null, decode_entities, node_text, strip, title_case
from ..functions.urls import drop_slashes, last_segment, resolve_url
from ..session import is_small
from .rows import settle

_SUBCATEGORY_TYPES = ("CollectionPage", "Category")
HITS = "array<struct<name:string,url:string,raw_url:string,found_by:string>>"


def with_anchor_cells(pages: DataFrame, where: Column | None = None) -> DataFrame:
    """Add ``_anchor_cells``: raw href and text of every anchor, one after the other; null outside ``where``."""
    found = markup.anchors(markup.visible(F.col("html")))
    staged = pages.withColumn("_anchors", found if where is None else F.when(where, found))
    pair = F.transform("_anchors", lambda a: F.array(markup.attribute(a, "href"), markup.text_nodes(a)))
    return staged.withColumn("_anchor_cells", F.flatten(pair)).drop("_anchors")


def with_links(celled: DataFrame) -> DataFrame:
    """Turn ``_anchor_cells`` into ``links``: array of ``pos, href, text`` for the anchors with an href.

    All cells of a page decode in one call. Drop the body first where it is no longer needed: rows wait in
    a buffer while the decoder runs.
    """
    decoded = celled.withColumn("_anchor_cells", decode_entities(F.col("_anchor_cells")))
    count = (F.size("_anchor_cells") / 2).cast("int")
    pairs = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)),
        lambda i: F.struct(
            i.alias("pos"),
            F.get("_anchor_cells", i * 2).alias("href"),
            node_text(F.get("_anchor_cells", i * 2 + 1)).alias("text"),
        ),
    )
    none = F.array().cast("array<struct<pos:int,href:string,text:string>>")
    kept = F.filter(F.coalesce(pairs, none), lambda p: p["href"].isNotNull())
    return decoded.withColumn("links", kept).drop("_anchor_cells")


def absolute_link(href: Column, base: str) -> Column:
    """Root-relative links get the base, ``http`` links stay, all others are null; no trailing slash."""
    base = base.rstrip("/")
    return let(strip(href), lambda h: _absolute(h, base))


def _absolute(href: Column, base: str) -> Column:
    return drop_slashes(
        F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), drop_slashes(href))).when(
            F.startswith(href, F.lit("http")), href
        )
    )


def page_links(pages: DataFrame, base: str) -> DataFrame:
    """``page_url, pos, href, text, link_url`` for every anchor that resolves to an address."""
    celled = with_anchor_cells(pages.select(F.col("url").alias("page_url"), "html")).drop("html")
    links = with_links(celled).select("page_url", F.explode_outer("links").alias("l"))
    full = absolute_link(F.col("l.href"), base)
    return links.select("page_url", "l.pos", "l.href", "l.text", full.alias("link_url")).filter(
        F.col("link_url").isNotNull()
    )


def seed_frontier(seeds: DataFrame, base: str, limit: int | None = None) -> DataFrame:
    """Resolve seed paths ``(seed_ord, path)`` and keep the first ``limit`` (none or 0 keeps all)."""
    kept = seeds.orderBy("seed_ord", "path").limit(limit) if limit else seeds
    resolved = settle(kept, "url", resolve_url(F.lit(base), F.col("path")))
    return resolved.select("seed_ord", "url", last_segment(F.col("url")).alias("category_name"))


def path_prefix(category_url: Column, base: str) -> Column:
    return drop_slashes(F.replace(category_url, F.lit(base.rstrip("/")), F.lit("")))


def _children(links: Column, prefix: Column, base: str) -> Column:
    """Links one level below ``prefix``, in page order, as ``name, url``."""
    base = base.rstrip("/")

    def child(link: Column) -> Column:
        return let(absolute_link(link["href"], base), lambda url: below(link, url))

    def below(link: Column, url: Column) -> Column:
        path = F.when(F.contains(url, F.lit(base)), F.replace(url, F.lit(base), F.lit("")))
        rest = F.when(
            F.startswith(path, F.concat(prefix, F.lit("/"))) & ~F.contains(path, F.lit("/product/")),
            F.substr(path, F.length(prefix) + 2),
        )
        name = F.coalesce(blank_to_null(link["text"]), title_case(F.replace(rest, F.lit("-"), F.lit(" "))))
        return F.when((rest != "") & ~F.contains(rest, F.lit("/")), F.struct(name.alias("name"), url.alias("url")))

    return F.filter(F.transform(links, child), lambda c: c.isNotNull())


def _jsonld_children(html: Column) -> Column:
    """Subcategories from the JSON-LD item lists of a page, as ``name, url, raw_url``.

    Lists count up to the first one with a hit; each later script adds only its first list.
    """
    empty = F.array().cast("array<struct<name:string,url:string,raw_url:string>>")

    def hit(entry: Column) -> Column:
        item = jsonld.node(entry, "$.item")
        url = jsonld.text(jsonld.node(item, "$.url"))
        return F.when(
            jsonld.has_type(item, *_SUBCATEGORY_TYPES) & (url != ""),
            F.struct(
                F.coalesce(jsonld.text(jsonld.node(item, "$.name")), F.lit("")).alias("name"),
                drop_slashes(url).alias("url"),
                url.alias("raw_url"),
            ),
        )

    def hits(block: Column) -> Column:
        entries = jsonld.items(block, "$.itemListElement")
        return F.coalesce(F.filter(F.transform(entries, hit), lambda h: h.isNotNull()), empty)

    def lists(script: Column) -> Column:
        return F.transform(F.filter(jsonld.blocks(script), lambda b: jsonld.has_type(b, "ItemList")), hits)

    scripts = F.filter(markup.ld_scripts(html), lambda s: jsonld.may_hold(s, "ItemList"))
    per_script = F.filter(F.transform(scripts, lists), lambda ls: ls.isNotNull() & (F.size(ls) > 0))
    return F.aggregate(
        per_script,
        empty,
        lambda found, ls: F.concat(
            found,
            F.when(F.size(found) > 0, F.get(ls, F.lit(0))).otherwise(
                F.coalesce(F.get(F.filter(ls, lambda h: F.size(h) > 0), F.lit(0)), empty)
            ),
        ),
    )


def _seed_pages(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Readable pages worth searching for subcategories.

    A seed list proven small is broadcast, so bodies stay where they are and other pages are skipped. Beyond
    that every page is searched and only the compact result meets the seeds.
    """
    ok = pages.filter(F.col("status") == 200).select("url", "html")
    urls = seeds.select("url").distinct()
    return ok.join(F.broadcast(urls), "url", "left_semi") if is_small(urls) else ok


def _candidates(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """Every seed with the subcategories on its page, one row each; a seed without any keeps one row."""
    rows = seeds.join(hits.select("url", "_prefix", "hits"), "url", "left").select(
        "seed_ord", F.col("url").alias("category_url"), "category_name", "_prefix",
        F.posexplode_outer("hits").alias("sub_pos", "h"),
    )
    last = F.substring_index("_prefix", "/", -1)
    parent = F.when(F.col("h.found_by") == "html", F.coalesce(blank_to_null(F.col("category_name")), last))
    return rows.select(
        "seed_ord", "sub_pos", "category_url", "category_name", "h.name",
        F.col("h.url").alias("url"), F.col("h.raw_url").alias("raw_url"),
        F.coalesce(parent, "category_name").alias("parent"), F.lit(1).alias("depth"), "h.found_by",
    )


def _as_categories(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """Subcategories only, first occurrence of a URL per seed."""
    first = Window.partitionBy("seed_ord", "raw_url").orderBy("sub_pos")
    found = _candidates(seeds, hits).filter(F.col("sub_pos").isNotNull())
    return found.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank", "raw_url")


def _tagged(hits: Column, found_by: str, raw: str) -> Column:
    return F.transform(
        hits,
        lambda h: F.struct(h["name"].alias("name"), h["url"].alias("url"), h[raw].alias("raw_url"),
                           F.lit(found_by).alias("found_by")),
    )


def with_hit_cells(pages: DataFrame, base: str, where: Column | None = None, how: str = "all") -> DataFrame:
    """Add what :func:`with_hits` needs from the body: the path prefix, anchor cells and JSON-LD hits.

    ``how`` is ``html`` (anchors), ``jsonld``, or ``all``. Rows outside ``where`` get nulls at no cost.
    """
    staged = pages.withColumn("_prefix", path_prefix(F.col("url"), base))
    by_json = _tagged(_jsonld_children(F.col("html")), "jsonld", "raw_url") if how != "html" else F.lit(None).cast(HITS)
    staged = staged.withColumn("_ld_hits", by_json if where is None else F.when(where, by_json))
    return with_anchor_cells(staged, F.lit(False) if how == "jsonld" else where)


def with_hits(celled: DataFrame, base: str) -> DataFrame:
    """``hits``, the subcategories of each page: from anchors, else from JSON-LD."""
    by_anchor = _tagged(_children(F.col("links"), F.col("_prefix"), base), "html", "url")
    staged = with_links(celled).withColumn("hits", by_anchor).drop("links")
    best = F.when((F.size("hits") == 0) & F.col("_ld_hits").isNotNull(), F.col("_ld_hits")).otherwise(F.col("hits"))
    return staged.withColumn("hits", best).drop("_ld_hits")


def _page_hits(seeds: DataFrame, pages: DataFrame, base: str, how: str) -> DataFrame:
    return with_hits(with_hit_cells(_seed_pages(seeds, pages), base, how=how).drop("html"), base)


def subcategories(seeds: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Subcategories from anchors only."""
    return _as_categories(seeds, _page_hits(seeds, pages, base, "html")).drop("found_by")


def subcategories_jsonld(seeds: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Subcategories from JSON-LD only, whatever the anchors say."""
    return _as_categories(seeds, _page_hits(seeds, pages, base, "jsonld")).drop("found_by")


def subcategories_all(seeds: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Subcategories of every seed: anchors first, JSON-LD where anchors gave none."""
    return _as_categories(seeds, _page_hits(seeds, pages, base, "all"))


def listing_frontier(seeds: DataFrame, pages: DataFrame, base: str, visited: DataFrame | None = None) -> DataFrame:
    """Listing pages to read: ``url, category_path, seed_ord, sub_pos, is_category``.

    Subcategories count once, at their first place in the run, and not when already visited. A category
    without any (or without a readable page) is read as a listing itself; it is neither checked nor marked.
    """
    return listing_frontier_of(seeds, _page_hits(seeds, pages, base, "all"), visited)


def listing_frontier_of(seeds: DataFrame, hits: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """The same from pages whose ``hits`` are known: one pass, one shuffle on the address."""
    alone = F.col("sub_pos").isNull()
    rows = _candidates(seeds, hits).select(
        F.when(alone, F.col("category_url")).otherwise(F.col("url")).alias("url"),
        F.when(alone, F.col("category_name")).otherwise(F.concat_ws(" > ", "category_name", "name")).alias("category_path"),
        "seed_ord", F.coalesce("sub_pos", F.lit(0)).alias("sub_pos"), alone.alias("is_category"),
    )
    if visited is not None:
        done = visited.filter(F.col("status") == "visited").select(F.col("url").alias("_done"))
        rows = rows.join(done, (F.col("url") == F.col("_done")) & ~F.col("is_category"), "left_anti")
    own_seed = F.when(F.col("is_category"), F.col("seed_ord"))
    first = Window.partitionBy("url", own_seed).orderBy("seed_ord", "sub_pos")
    return rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def unvisited(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Frontier rows whose URL has no successful visit."""
    done = visited.filter(F.col("status") == "visited").select("url")
    return frontier.join(done, "url", "left_anti")


def product_links(scripts: Column) -> Column:
    """Element URLs of a listing page's scripts, or null when none of its elements is a named product."""
    parsed = F.flatten(
        F.transform(scripts, lambda s: F.coalesce(jsonld.blocks(s), F.array().cast("array<variant>")))
    )

    def named(entry: Column) -> Column:
        item = jsonld.node(entry, "$.item")
        return jsonld.has_type(item, "Product") & (jsonld.product_name(item) != "")

    def links(blocks: Column) -> Column:
        found = listed_elements(blocks)
        return F.when(F.exists(found, named), listed_urls(found))

    return let(parsed, links)


def listed_elements(blocks: Column) -> Column:
    """Elements of the item lists among ``blocks``, in order."""
    return F.flatten(
        F.transform(
            F.filter(blocks, lambda b: jsonld.has_type(b, "ItemList")),
            lambda b: F.coalesce(jsonld.items(b, "$.itemListElement"), F.array().cast("array<variant>")),
        )
    )


def listed_urls(elements: Column) -> Column:
    """URLs of the elements, whatever their item."""
    urls = F.transform(elements, lambda e: jsonld.text(jsonld.node(e, "$.url")))
    return F.filter(urls, lambda u: u.isNotNull() & (u != ""))


def product_frontier(listings: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """Detail pages to read: ``url, category_path, ord`` from compact listing rows with ``product_urls`` and ``ord``.

    Each URL counts once, at its first place in the run.
    """
    rows = listings.select("category_path", "ord", F.posexplode_outer("product_urls").alias("pos", "url"))
    rows = rows.filter(F.col("pos").isNotNull())
    placed = rows.select("url", "category_path", F.concat("ord", F.array(F.col("pos").cast("bigint"))).alias("ord"))
    first = first_in_run(placed)
    return first if visited is None else unvisited(first, visited)


def first_in_run(frontier: DataFrame, order: str = "ord") -> DataFrame:
    """One row per URL, the earliest by ``order``; duplicates shrink before the shuffle."""
    first = Window.partitionBy("url").orderBy(order)
    return frontier.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def _class_has(tag: Column, token: str) -> Column:
    """Class list of a start tag holds ``token``."""
    names = F.coalesce(markup.attribute(tag, "class"), F.lit(""))
    return F.array_contains(F.split(names, r"[ \t\n\r\f]+"), token)


def _pager_anchors(shown: Column) -> Column:
    """Start tags of anchors that are pager links by class or by container, in page order.

    Containers are followed by the depth of their own tag name only, so other unclosed tags do no harm.
    """
    tag = F.filter(markup.tokens(shown), lambda t: t.rlike(r"(?s)\A</?[a-zA-Z].*>\z"))
    state = F.struct(
        F.lit("").alias("bar"), F.lit(0).alias("bar_depth"), F.lit(0).alias("list_depth"),
        F.array().cast("array<string>").alias("out"),
    )

    def walk(acc: Column, t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"\A</?([a-zA-Z][a-zA-Z0-9:-]*)", 1))
        closing = F.startswith(t, F.lit("</"))
        void = name.isin(*markup.VOID) | F.endswith(t, F.lit("/>"))
        step = F.when(void, 0).when(closing, -1).otherwise(1)
        bar_opens = (acc["bar_depth"] == 0) & (step == 1) & _class_has(t, "toolbar")
        bar = F.when(bar_opens, name).otherwise(acc["bar"])
        bar_depth = (
            F.when(bar_opens, 1)
            .when((acc["bar_depth"] > 0) & (name == acc["bar"]), acc["bar_depth"] + step)
            .otherwise(acc["bar_depth"])
        )
        list_opens = (acc["list_depth"] == 0) & (step == 1) & (name == "ul") & _class_has(t, "pages")
        list_depth = (
            F.when(list_opens, 1)
            .when((acc["list_depth"] > 0) & (name == "ul"), acc["list_depth"] + step)
            .otherwise(acc["list_depth"])
        )
        inside = (acc["list_depth"] > 0) | ((acc["bar_depth"] > 0))
        wanted = (name == "a") & ~closing & (inside | _class_has(t, "page-link") | _class_has(t, "next"))
        return F.struct(
            bar.alias("bar"), bar_depth.alias("bar_depth"), list_depth.alias("list_depth"),
            F.when(wanted, F.concat(acc["out"], F.array(t))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(tag, state, walk, lambda acc: acc["out"])


def pagination_urls(pages: DataFrame) -> DataFrame:
    """``page_url, pos, url``: pager links with ``p=``, then any link with ``?p=`` or ``&p=``; distinct per page."""
    # The cheap test on the raw body goes first, so other pages are not stripped at all.
    likely = pages.filter(F.contains("html", F.lit("p="))).select(F.col("url").alias("page_url"), "html")
    candidates = settle(likely, "_shown", markup.visible(F.col("html"))).drop("html").select(
        "page_url",
        F.transform(_pager_anchors(F.col("_shown")), lambda a: markup.attribute(a, "href")).alias("_pager"),
        F.transform(
            markup.tags(F.col("_shown"), "a"), lambda a: markup.attribute(a, "href")
        ).alias("_all"),
    )
    split_at = candidates.withColumn("_n", F.size("_pager")).withColumn(
        "_cells", decode_entities(F.concat("_pager", "_all"))
    )
    hrefs = F.filter(
        F.transform(
            "_cells",
            lambda h, i: F.when(
                F.when(i < F.col("_n"), F.contains(h, F.lit("p="))).otherwise(
                    F.contains(h, F.lit("?p=")) | F.contains(h, F.lit("&p="))
                ),
                h,
            ),
        ),
        lambda h: h.isNotNull(),
    )
    # A page is one row, so its links are made distinct inside it.
    urls = settle(split_at, "_urls", F.transform(hrefs, lambda h: resolve_url(F.col("page_url"), h)))
    placed = F.transform("_urls", lambda u, i: F.struct(i.alias("pos"), u.alias("url")))
    first = F.filter(placed, lambda p: F.array_position(F.col("_urls"), p["url"]) == p["pos"] + 1)
    return urls.select("page_url", F.explode(first).alias("p")).select("page_url", "p.pos", "p.url")
