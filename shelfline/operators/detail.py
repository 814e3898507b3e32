"""Detail-page extraction: JSON-LD, then meta tags and visible markup, then an offline model answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonld, markup
from ..functions.bind import let
from ..functions.numbers import first_number
from ..functions.text import blank_to_null, decode_entities, node_text, strip
from ..schemas import PRODUCT_TYPES, default
from .listing import product_columns
from .rows import settle

SNIPPET_CHARS = 5000
REQUEST = (
    "Read the product shown on this web page and reply with one JSON object holding product_name, brand, sku, "
    "price (a number), availability, description, unit_pack_size, specifications (an object) and image_urls "
    "(a list of strings). Use null for anything the page does not give.\n\nAddress: %s\n\nMarkup:\n%s"
)

# Words that mark an item number on a page, and the shape of the number itself.
SKU_LABEL = r"(?i)SKU|Item\s*#|Product\s*Code"
SKU_VALUE = r"[A-Z0-9]{3,}"

_FIELDS = [n for n in PRODUCT_TYPES if n not in ("fingerprint", "scraped_at")]
RECORD = ", ".join(f"{n}: {PRODUCT_TYPES[n]}" for n in _FIELDS)


def _record(columns: dict[str, Column]) -> Column:
    """Product struct with defaults for the fields not given."""
    return F.struct(*[columns.get(n, default(n)).cast(PRODUCT_TYPES[n]).alias(n) for n in _FIELDS])


def with_jsonld(pages: DataFrame) -> DataFrame:
    """Add ``by_jsonld``: the first Product block as a record, null without one or when it has no name."""
    scripts = F.filter(markup.ld_scripts(F.col("html")), lambda s: jsonld.may_hold(s, "Product"))
    parsed = F.flatten(F.transform(scripts, lambda s: F.coalesce(jsonld.blocks(s), F.array().cast("array<variant>"))))
    staged = pages.withColumn("_item", F.get(F.filter(parsed, lambda b: jsonld.has_type(b, "Product")), F.lit(0)))
    staged = staged.withColumns(
        {"_offer": jsonld.offer(F.col("_item")), "_rating": jsonld.node(F.col("_item"), "$.aggregateRating")}
    )
    columns = product_columns(F.col("_item"), F.col("_offer"), F.col("_rating"))
    columns |= {"product_url": F.col("page_url"), "category_path": F.col("category_path")}
    staged = staged.withColumn("_found", _record(columns)).drop("_item", "_offer", "_rating")
    named = F.when(F.col("_found.product_name") != "", F.col("_found"))
    return settle(staged, "by_jsonld", named).drop("_found")


def _meta(metas: Column, key: str, value: str) -> Column:
    """Content of the first meta tag with that key; empty without content, null without the tag."""
    tag = F.get(F.filter(metas, lambda m: markup.attribute(m, key) == value), F.lit(0))
    return F.when(tag.isNotNull(), F.coalesce(markup.attribute(tag, "content"), F.lit("")))


def _price_nodes(shown: Column) -> Column:
    """Raw text of the first span with a class containing ``price``."""
    classes = lambda t: F.coalesce(markup.attribute(t, "class"), F.lit(""))
    first = F.get(F.filter(markup.tags(shown, "span"), lambda t: F.contains(classes(t), F.lit("price"))), F.lit(0))

    def inside(tag: Column) -> Column:
        rest = F.substr(shown, F.instr(shown, tag) + F.length(tag))
        return F.when(tag.isNotNull(), markup.element_text(rest, "span"))

    return F.when(F.contains(shown, F.lit("price")), let(first, inside))


def _sku_nodes(shown: Column) -> Column:
    """Raw text of the element around the first visible item-number label."""

    def around(found: Column) -> Column:
        at = F.get(
            F.filter(
                F.transform(found, lambda t, i: F.when(~F.startswith(t, F.lit("<")) & t.rlike(SKU_LABEL), i)),
                lambda i: i.isNotNull(),
            ),
            F.lit(0),
        )
        start = F.coalesce(markup.parent_start(F.slice(found, 1, at)), F.lit(-1))
        rest = F.slice(found, start + 2, F.size(found) - start - 1)
        return F.when(at.isNotNull(), markup.element_nodes(rest))

    return F.when(shown.rlike(SKU_LABEL), let(markup.tokens(markup.body(shown)), around))


def sku_in(text: Column, keep_label: bool = False) -> Column:
    """First item number in the element's text.

    The label itself is cut first: it would satisfy the pattern (``SKU: AB12`` would give ``SKU``).
    ``keep_label=True`` reads the text as it stands.
    """
    searched = text if keep_label else F.regexp_replace(text, SKU_LABEL, " ")
    return blank_to_null(F.regexp_extract(searched, SKU_VALUE, 0))


_PARTS = ("og_title", "title", "price", "sku", "description", "image")


def with_markup_cells(pages: DataFrame, where: Column | None = None) -> DataFrame:
    """Replace ``html`` by ``_cells``: raw texts of the page (``_PARTS``), null where absent.

    Only rows that satisfy ``where`` are searched.
    """
    guard = F.lit(True) if where is None else where
    shown = pages.withColumn("_shown", F.when(guard, markup.visible(F.col("html"))))
    shown = shown.withColumn("_metas", markup.tags(F.col("_shown"), "meta"))
    raw = F.array(
        _meta(F.col("_metas"), "property", "og:title"),
        markup.title_text(F.col("_shown")),
        _price_nodes(F.col("_shown")),
        _sku_nodes(F.col("_shown")),
        _meta(F.col("_metas"), "name", "description"),
        _meta(F.col("_metas"), "property", "og:image"),
    )
    return shown.withColumn("_cells", raw).drop("_shown", "_metas", "html")


def with_parts(celled: DataFrame) -> DataFrame:
    """Decode ``_cells`` into the struct ``parts``."""
    decoded = celled.withColumn("_cells", decode_entities(F.col("_cells")))
    parts = F.struct(*[F.get("_cells", F.lit(i)).alias(name) for i, name in enumerate(_PARTS)])
    return decoded.withColumn("parts", parts).drop("_cells")


def with_markup_parts(pages: DataFrame, where: Column | None = None) -> DataFrame:
    """Replace ``html`` by ``parts``, the decoded raw texts of the page."""
    return with_parts(with_markup_cells(pages, where))


def title_name(parts: str = "parts") -> Column:
    """``og:title``, else the title text before the first bar; null when both are blank."""
    og = strip(F.col(f"{parts}.og_title"))
    title = strip(F.substring_index(node_text(F.col(f"{parts}.title")), "|", 1))
    return F.coalesce(blank_to_null(og), blank_to_null(title))


def markup_columns(keep_label: bool = False) -> dict[str, Column]:
    """Product fields readable from ``parts``."""
    image = F.col("parts.image")
    return {
        "product_name": title_name(),
        "price": first_number(node_text(F.col("parts.price"))),
        "sku": sku_in(node_text(F.col("parts.sku")), keep_label),
        "description": strip(F.col("parts.description")),
        "image_urls": F.when(image.isNotNull(), F.array(image)).otherwise(default("image_urls")),
    }


def with_markup(parted: DataFrame) -> DataFrame:
    """Turn ``parts`` into ``by_markup``: the record read from meta tags and visible markup, null without a name."""
    columns = markup_columns() | {"product_url": F.col("page_url"), "category_path": F.col("category_path")}
    staged = parted.withColumn("_found", _record(columns)).drop("parts")
    named = F.when(F.col("_found.product_name").isNotNull(), F.col("_found"))
    return settle(staged, "by_markup", named).drop("_found")


def read_page(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by ``by_jsonld`` and ``_cells``; the markup is searched only where JSON-LD gave nothing."""
    return with_markup_cells(with_jsonld(pages), F.col("by_jsonld").isNull())


def clean_answer(text: Column) -> Column:
    """Model answer without a code fence: the first line goes, and a closing fence after it."""
    answer = strip(text)
    fenced = F.startswith(answer, F.lit("```"))
    inner = F.regexp_replace(answer, r"(?s)\A[^\n]*\n", "")
    return F.when(fenced & F.contains(answer, F.lit("\n")), F.regexp_replace(inner, r"```\z", "")).when(~fenced, answer)


def answer_record(answers: DataFrame) -> DataFrame:
    """Add ``by_model`` to ``answers(page_url, category_path, text)``: the JSON answer as a record, else null."""
    staged = answers.withColumn("_a", jsonld.document(clean_answer(F.col("text"))))
    staged = staged.withColumn("_a", F.when(jsonld.is_object(F.col("_a")) & (jsonld.kind(F.col("_a")) != "OBJECT<>"), F.col("_a")))
    a = F.col("_a")

    def field(name: str) -> Column:
        return jsonld.text(jsonld.node(a, f"$.{name}"))

    name = jsonld.node(a, "$.product_name")
    price = jsonld.node(a, "$.price")
    price_value = jsonld.number(price)
    price_falsy = price.isNull() | F.is_variant_null(price) | (F.try_variant_get(price, "$", "string").isin("", "[]", "{}"))
    zero = (jsonld.kind(price) != "STRING") & (price_value == 0)
    specs = jsonld.node(a, "$.specifications")
    image = jsonld.node(a, "$.image_urls")
    columns = {
        "product_name": F.when(name.isNull(), F.lit("Unknown")).otherwise(jsonld.text(name)),
        "brand": field("brand"),
        "sku": field("sku"),
        "price": F.when(~price_falsy & ~F.coalesce(zero, F.lit(False)), price_value),
        "availability": field("availability"),
        "description": field("description"),
        "unit_pack_size": field("unit_pack_size"),
        "specifications": F.coalesce(
            F.transform_values(F.try_variant_get(specs, "$", "map<string,variant>"), lambda k, v: F.try_variant_get(v, "$", "string")),
            default("specifications"),
        ),
        "image_urls": F.coalesce(
            F.filter(F.transform(jsonld.items(image), jsonld.text), lambda u: u.isNotNull()), default("image_urls")
        ),
        "product_url": F.col("page_url"),
        "category_path": F.col("category_path"),
    }
    bad_price = ~price_falsy & price_value.isNull()
    bad = (
        F.col("_found.product_name").isNull()
        | F.coalesce(bad_price, F.lit(False))
        | (specs.isNotNull() & ~F.coalesce(jsonld.is_object(specs), F.lit(False)))
        | (image.isNotNull() & jsonld.items(image).isNull())
    )
    staged = staged.withColumn("_found", _record(columns))
    return settle(staged, "by_model", F.when(a.isNotNull() & ~bad, F.col("_found"))).drop("_found", "_a")


def extract_detail(pages: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """One row per page ``page_url, html, category_path, ...``: ``record`` and ``extracted_by``."""
    return resolve_record(read_page(pages), answers)


def resolve_record(read: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``record`` and ``extracted_by`` from the rows of :func:`read_page`; no body is left to shuffle or buffer."""
    ruled = with_markup(with_parts(read))
    if answers is None:
        ruled = ruled.withColumn("by_model", F.lit(None).cast(f"struct<{RECORD}>"))
    else:
        ruled = answer_record(ruled.join(one_answer(answers).withColumnRenamed("url", "page_url"), "page_url", "left"))
        ruled = ruled.drop("text")
    by = (
        F.when(F.col("by_jsonld").isNotNull(), "jsonld")
        .when(F.col("by_markup").isNotNull(), "html")
        .when(F.col("by_model").isNotNull(), "model")
        .otherwise("none")
    )
    return ruled.withColumns(
        {"record": F.coalesce("by_jsonld", "by_markup", "by_model"), "extracted_by": by}
    ).drop("by_jsonld", "by_markup", "by_model")


def one_answer(answers: DataFrame) -> DataFrame:
    """One answer ``url, text`` for each address: of several the first in the order of their text."""
    return answers.groupBy("url").agg(F.min("text").alias("text"))


def with_answers(facts: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Facts ``url, record, extracted_by`` with the records of model answers where no rule gave one."""
    if answers is None:
        return facts
    named = facts.withColumns({"page_url": F.col("url"), "category_path": F.lit("")})
    answered = answer_record(named.join(one_answer(answers).withColumnRenamed("url", "page_url"), "page_url", "left"))
    by_model = F.col("record").isNull() & F.col("by_model").isNotNull()
    return answered.withColumns(
        {"extracted_by": F.when(by_model, "model").otherwise(F.col("extracted_by")), "record": F.coalesce("record", "by_model")}
    ).select(*facts.columns)


def request_prompt(template: str = REQUEST, chars: int = SNIPPET_CHARS) -> Column:
    """The question about a page ``url, html``."""
    return F.format_string(template, F.col("url"), F.substring("html", 1, chars))


def extract_requests(pages: DataFrame, template: str = REQUEST, chars: int = SNIPPET_CHARS) -> DataFrame:
    """Model requests ``url, prompt`` for pages neither JSON-LD nor markup could read."""
    prompt = F.format_string(template, F.col("page_url"), F.substring("html", 1, chars))
    ruled = with_markup(with_parts(read_page(pages.withColumn("prompt", prompt))))
    open_pages = ruled.filter(F.col("by_jsonld").isNull() & F.col("by_markup").isNull())
    return open_pages.select(F.col("page_url").alias("url"), "prompt")


def records(details: DataFrame) -> DataFrame:
    """Product rows of the pages that gave one, with the columns of the raw listing products."""
    return details.filter(F.col("record").isNotNull()).select("page_url", "record.*", "ord")
