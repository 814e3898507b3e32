"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let

_SCHEME = r"\A([a-zA-Z][a-zA-Z0-9+.-]*):"
# RFC 3986 appendix B split of a reference: authority, path, query, fragment (scheme handled apart).
_PARTS = r"\A(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def drop_slashes(url: Column) -> Column:
    """Remove all trailing slashes."""
    return F.rtrim(url, F.lit("/"))


def last_segment(url: Column) -> Column:
    return F.substring_index(drop_slashes(url), "/", -1)


def _resolve_dots(segments: Column) -> Column:
    """Path from its segments with ``.`` and ``..`` worked off."""
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda out, s: F.when(s == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))))
        .when(s == ".", out)
        .otherwise(F.concat(out, F.array(s))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return let(F.array_join(F.concat(walked, tail), "/"), lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)))


def _split(url: Column) -> Column:
    """Parts of a URL; a bare ``//``, ``?`` or ``#`` counts as none."""
    names = ("authority", "path", "query", "fragment")
    parts = [F.regexp_extract(url, _PARTS, i + 1).alias(n) for i, n in enumerate(names)]
    return let(
        F.struct(F.lower(F.regexp_extract(url, _SCHEME, 1)).alias("scheme"), *parts),
        lambda u: u.withField("authority", F.when(u["authority"] != "//", u["authority"]).otherwise(""))
        .withField("query", F.when(u["query"] != "?", u["query"]).otherwise(""))
        .withField("fragment", F.when(u["fragment"] != "#", u["fragment"]).otherwise("")),
    )


def _merged_path(base_path: Column, path: Column) -> Column:
    """Path of a reference below the folder of the base path."""
    folder = let(
        F.split(base_path, "/"),
        lambda d: F.when(F.element_at(d, -1) != "", F.slice(d, 1, F.size(d) - 1)).otherwise(d),
    )
    relative = let(
        F.concat(folder, F.split(path, "/")),
        lambda all_: F.filter(all_, lambda s, i: (i == 0) | (i == F.size(all_) - 1) | (s != "")),
    )
    return let(F.when(F.startswith(path, F.lit("/")), F.split(path, "/")).otherwise(relative), _resolve_dots)


def resolve_url(base: Column, ref: Column) -> Column:
    """Resolve ``ref`` against the absolute URL ``base`` (RFC 3986, with empty queries and fragments dropped)."""
    cleaned = F.regexp_replace(F.regexp_replace(ref, r"\A[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def resolved(pair: Column) -> Column:
        r, b, raw = pair["r"], pair["b"], pair["raw"]
        origin = F.concat(b["scheme"], F.lit(":"), b["authority"])
        own_query = F.when(r["query"] != "", r["query"]).otherwise(b["query"])
        return (
            F.when(raw == "", pair["base"])
            .when((r["scheme"] != "") & (r["scheme"] != b["scheme"]), raw)
            .when(
                r["authority"] != "",
                F.concat(b["scheme"], F.lit(":"), r["authority"], r["path"], r["query"], r["fragment"]),
            )
            .when(r["path"] == "", F.concat(origin, b["path"], own_query, r["fragment"]))
            .otherwise(F.concat(origin, _merged_path(b["path"], r["path"]), r["query"], r["fragment"]))
        )

    return let(
        cleaned,
        lambda raw: let(
            F.struct(_split(raw).alias("r"), _split(base).alias("b"), raw.alias("raw"), base.alias("base")), resolved
        ),
    )
