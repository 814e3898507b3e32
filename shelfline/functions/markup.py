"""HTML columns: scripts, tags, attributes and element text by native regular expressions.

Every pattern is linear: repeated groups are possessive, and an unclosed comment, script or anchor ends
at the next one or at the end of the page, so a broken page costs one pass and no deep recursion.

Bounds of the grammar: implied end tags are not inserted, and a tag broken by a stray quote is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .text import NODE_BREAK

_IN_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""

_LD_TYPE = r"""(?-i:"application/ld\+json"|'application/ld\+json'|application/ld\+json(?=[\s/>]))"""
_COMMENT = r"!--(?:[^-]++|-(?!->))*+(?:-->|\z)"


def _raw_body(name: str) -> str:
    """Content of an element whose text is not markup, up to its end tag."""
    return rf"(?:[^<]++|<(?!/{name}[\s/>]))*+"


def _raw_end(name: str) -> str:
    return rf"(?:</{name}[^>]*+>|\z)"


# All alternatives start with one literal, so the scan tests a single character at most positions.
_LD_SCRIPTS = (
    rf"(?is)<(?:{_COMMENT}|script(?=[\s/>])"
    rf"(?:(?=[^>]*?\stype\s*+=\s*+{_LD_TYPE}){_IN_TAG}>({_raw_body('script')})|{_raw_body('script')}){_raw_end('script')})"
)
_HIDDEN = (
    rf"(?is)<(?:{_COMMENT}"
    rf"|script(?=[\s/>]){_raw_body('script')}{_raw_end('script')}"
    rf"|style(?=[\s/>]){_raw_body('style')}{_raw_end('style')})"
)
_ANCHORS = rf"(?is)<a(?=[\s/>]){_IN_TAG}>(?:[^<]++|<(?!/?a[\s/>]))*+"
_TAG = rf"</?[a-zA-Z]{_IN_TAG}>|<![^>]*+>"
_TOKENS = rf"(?s){_TAG}|[^<]++|<"

# Elements without an end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_VOID_TAG = rf"(?is)\A<(?:{'|'.join(VOID)})[\s/>]"


def ld_scripts(html: Column) -> Column:
    """Bodies of the JSON-LD scripts in document order; empty and commented-out scripts are left out."""
    return F.filter(F.regexp_extract_all(html, F.lit(_LD_SCRIPTS), F.lit(1)), lambda s: s != "")


def visible(html: Column) -> Column:
    """Page without comments, scripts and styles; each leaves a marker that still splits text nodes."""
    return F.regexp_replace(html, _HIDDEN, "<!>")


def anchors(shown: Column) -> Column:
    """Every anchor (its tag and content) in document order, from :func:`visible` markup."""
    return F.regexp_extract_all(shown, F.lit(_ANCHORS), F.lit(0))


def tags(shown: Column, name: str) -> Column:
    """Every start tag called ``name``."""
    return F.regexp_extract_all(shown, F.lit(rf"(?is)<{name}(?=[\s/>]){_IN_TAG}>"), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute of a start tag; null without it, quotes of either kind or none."""
    skipped = rf"(?:[\s/]*+(?!{name}[\s=/>])[^\s\"'<>/=]++(?:\s*+=\s*+{_VALUE})?+)*+"
    quoted = F.regexp_extract(tag, rf"(?is)\A<[a-z][a-z0-9:-]*+{skipped}[\s/]*+{name}\s*+=\s*+({_VALUE})", 1)
    bare = lambda q: F.when(q.rlike("\\A[\"']"), F.substring(q, F.lit(2), F.length(q) - 2)).otherwise(q)
    return let(F.nullif(quoted, F.lit("")), bare)


def text_nodes(content: Column) -> Column:
    """Raw text nodes of some markup joined by ``NODE_BREAK``, ready for decoding."""
    return F.regexp_replace(content, rf"(?s){_TAG}", NODE_BREAK)


def title_text(shown: Column) -> Column:
    """Raw text of the first title element; null without one."""
    found = F.regexp_extract(shown, rf"(?is)(<title(?=[\s/>]){_IN_TAG}>.*?)(?:</title\s*>|\z)", 1)
    return F.when(found != "", text_nodes(found))


def body(shown: Column) -> Column:
    """Markup of the body, or of the whole page less its head when no body tag is given."""
    inner = F.regexp_extract(shown, rf"(?is)<body(?=[\s/>]){_IN_TAG}>(.*)", 1)
    rest = F.regexp_replace(shown, r"(?is)<head(?=[\s/>]).*?(?:</head\s*>|\z)|<title(?=[\s/>]).*?(?:</title\s*>|\z)", "")
    return F.when(shown.rlike(r"(?i)<body[\s/>]"), inner).otherwise(rest)


def tokens(shown: Column) -> Column:
    """Markup as a list of tags and text runs."""
    return F.regexp_extract_all(shown, F.lit(_TOKENS), F.lit(0))


def _step(token: Column, tag: str | None) -> Column:
    """+1 for a start tag, -1 for an end tag, 0 for text and void elements; one tag name or all."""
    name = tag or "[a-z]"
    opens, closes = rf"(?i)\A<{name}", rf"(?i)\A</{name}"
    if tag:
        opens, closes = opens + r"[\s/>]", closes + r"[\s/>]"
    return (
        F.when(token.rlike(closes), -1)
        .when(token.rlike(opens) & ~token.rlike(_VOID_TAG) & ~F.endswith(token, F.lit("/>")), 1)
        .otherwise(0)
    )


def element_nodes(following: Column, tag: str | None = None) -> Column:
    """Text nodes of the element whose start tag came just before ``following`` (a token list).

    Depth counts only tags called ``tag``, or every tag when none is named.
    """
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def walk(acc: Column, token: Column) -> Column:
        is_tag = token.rlike(rf"(?s)\A(?:{_TAG})\z")
        depth = acc["depth"] + _step(token, tag)
        piece = F.when(depth <= 0, F.lit("")).when(is_tag, F.lit(NODE_BREAK)).otherwise(token)
        return F.when(acc["depth"] <= 0, acc).otherwise(
            F.struct(depth.alias("depth"), F.concat(acc["text"], piece).alias("text"))
        )

    return F.aggregate(following, start, walk, lambda acc: acc["text"])


def element_text(following: Column, tag: str) -> Column:
    """Text nodes of the element whose start tag came just before the markup ``following``.

    Two levels of elements of the same name match by pattern; only deeper nesting is walked token by token.
    """
    plain = rf"(?:[^<]++|<(?!/?{tag}[\s/>]))"
    inner = rf"<{tag}(?=[\s/>]){_IN_TAG}>{plain}*+</{tag}\s*>"
    middle = rf"<{tag}(?=[\s/>]){_IN_TAG}>(?:{plain}|{inner})*+</{tag}\s*>"
    found = F.regexp_extract(following, rf"(?is)\A((?:{plain}|{middle})*+</{tag}\s*>)", 1)
    return F.when(found != "", text_nodes(found)).otherwise(element_nodes(tokens(following), tag))


def parent_start(preceding: Column) -> Column:
    """Zero-based index of the start tag still open at the end of ``preceding``; null at top level."""
    size = F.size(preceding)
    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("int").alias("at"))

    def walk(acc: Column, pair: Column) -> Column:
        depth = acc["depth"] + _step(pair["token"], None)
        found = F.when(depth > 0, pair["i"])
        return F.when(acc["at"].isNotNull(), acc).otherwise(F.struct(depth.alias("depth"), found.alias("at")))

    indexed = F.transform(preceding, lambda t, i: F.struct(t.alias("token"), i.alias("i")))
    return F.when(size > 0, F.aggregate(F.reverse(indexed), start, walk, lambda acc: acc["at"]))
