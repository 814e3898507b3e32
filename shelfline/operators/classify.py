"""Page typing: URL rule, then JSON-LD rule, then an offline model answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.text import strip
from ..functions.urls import drop_slashes
from ..schemas import PAGE_TYPES

SNIPPET_CHARS = 3000
QUESTION = (
    "Decide which kind of web shop page this is, from its address and the start of its markup.\n"
    "Answer with one word: category, listing, product or unknown.\n\n"
    "Address: %s\n\nMarkup:\n%s"
)


def type_by_url(url: Column) -> Column:
    """Type from the address, query text included; null when it says nothing."""
    path = F.lower(drop_slashes(url))
    below = F.split(F.get(F.split(path, "/catalog/"), F.lit(1)), "/")
    return (
        F.when(F.contains(path, F.lit("/product/")), "product")
        .when(F.contains(path, F.lit("/catalog/")) & (F.size(below) >= 2), "listing")
        .when(F.contains(path, F.lit("/catalog/")), "category")
    )


def type_by_scripts(scripts: Column) -> Column:
    """Type from the first JSON-LD script that quotes ItemList or Product; null without one."""

    def label(script: Column) -> Column:
        return F.when(F.contains(script, F.lit('"ItemList"')), "listing").when(
            F.contains(script, F.lit('"Product"')), "product"
        )

    return F.get(F.filter(F.transform(scripts, label), lambda t: t.isNotNull()), F.lit(0))


def type_by_answer(answer: Column) -> Column:
    """Type from a model's one-word answer; null unless it is one of the known types."""
    word = F.lower(strip(answer))
    return F.when(word.isin(*PAGE_TYPES), word)


def classify(pages: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``url, page_type, classified_by`` per page; ``answers(url, text)`` fill in where both rules are silent.

    The scripts are searched only where the URL rule gave nothing. The body is dropped before the answers
    are joined, so only addresses and labels are ever shuffled.
    """
    by_url = type_by_url(F.col("url"))
    ruled = pages.select(
        "url",
        by_url.alias("by_url"),
        F.when(by_url.isNull(), type_by_scripts(markup.ld_scripts(F.col("html")))).alias("by_html"),
    )
    if answers is None:
        ruled = ruled.withColumn("by_model", F.lit(None).cast("string"))
    else:
        answered = answers.select("url", type_by_answer(F.col("text")).alias("by_model"))
        ruled = ruled.join(answered, "url", "left")
    return ruled.select(
        "url",
        F.coalesce("by_url", "by_html", "by_model", F.lit("unknown")).alias("page_type"),
        F.when(F.col("by_url").isNotNull(), "url")
        .when(F.col("by_html").isNotNull(), "html")
        .when(F.col("by_model").isNotNull(), "model")
        .otherwise("none")
        .alias("classified_by"),
    )


def with_answers(facts: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Facts ``url, page_type`` (null where both rules are silent) with ``page_type`` and ``classified_by`` settled."""
    if answers is None:
        joined = facts.withColumn("_answer", F.lit(None).cast("string"))
    else:
        # Of several answers for an address, the first in the order of their text that names a type.
        known = answers.groupBy("url").agg(F.min_by(type_by_answer(F.col("text")), F.when(type_by_answer(F.col("text")).isNotNull(), F.col("text"))).alias("_answer"))
        joined = facts.join(known, "url", "left")
    by = F.when(F.col("page_type").isNotNull(), "rule").when(F.col("_answer").isNotNull(), "model").otherwise("none")
    return joined.withColumn("classified_by", by).withColumn("page_type", F.coalesce("page_type", "_answer", F.lit("unknown"))).drop("_answer")


def question(template: str = QUESTION, chars: int = SNIPPET_CHARS) -> Column:
    """The question about a page ``url, html``."""
    return F.format_string(template, F.col("url"), F.substring(F.coalesce("html", F.lit("")), 1, chars))


def classify_requests(pages: DataFrame, template: str = QUESTION, chars: int = SNIPPET_CHARS) -> DataFrame:
    """Model questions ``url, prompt`` for the pages both rules leave open."""
    undecided = pages.filter(type_by_url(F.col("url")).isNull()).filter(
        type_by_scripts(markup.ld_scripts(F.col("html"))).isNull()
    )
    return undecided.select("url", question(template, chars).alias("prompt"))


def audit_types(typed: DataFrame) -> DataFrame:
    """Mark pages met where a listing was expected; a warning only, never a filter."""
    return typed.withColumn("unexpected_type", ~F.col("page_type").isin("listing", "category"))
