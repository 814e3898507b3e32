"""Watching runs: difference of two product tables, drift of JSON-LD shapes, coverage below a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonld
from ..schemas import PRODUCT_TYPES
from .reports import COVERAGE_FIELDS, filled

#: A price that moved by more than this share of its old value is reported as a jump.
PRICE_JUMP = 0.5
#: Coverage in percent below which a field is reported.
LEAST_COVERAGE = 90.0
#: Fields compared between two runs: all but the key, its parts and the time.
COMPARED = tuple(n for n in PRODUCT_TYPES if n not in ("fingerprint", "scraped_at", "product_url", "sku"))
_LONG = ("description", "specifications", "image_urls", "alternative_products")


def _comparable(name: str) -> Column:
    """A field as it crosses the shuffle: long ones as a digest, maps in the order of their keys."""
    column = F.array_sort(F.map_entries(name)) if PRODUCT_TYPES[name].startswith("map") else F.col(name)
    if name not in _LONG:
        return column
    text = F.col(name) if PRODUCT_TYPES[name] == "string" else F.to_json(F.struct(column.alias("v")))
    return F.when(F.col(name).isNotNull(), F.sha2(text, 256))


def run_diff(before: DataFrame, after: DataFrame, fields: tuple[str, ...] = COMPARED, jump: float = PRICE_JUMP) -> DataFrame:
    """Products that went, came or changed between two tables with one row per fingerprint.

    ``fingerprint, change`` (gone, new, changed), ``fields`` that differ (in order; null equals null), ``price_before``,
    ``price_after`` and ``price_jump``: both prices are there and differ by more than the share ``jump`` of the older one.
    One shuffle of narrow rows per side, on the unique key.
    """

    def side(df: DataFrame) -> DataFrame:
        return df.select("fingerprint", "price", F.struct(*[_comparable(f).alias(f) for f in fields]).alias("f"))

    both = side(before).alias("b").join(side(after).alias("a"), F.col("b.fingerprint") == F.col("a.fingerprint"), "full_outer")
    gone, new = F.col("a.fingerprint").isNull(), F.col("b.fingerprint").isNull()
    differ = F.array_compact(F.array(*[F.when(~F.col(f"b.f.{f}").eqNullSafe(F.col(f"a.f.{f}")), f) for f in fields]))
    old, young = F.col("b.price"), F.col("a.price")
    rows = both.select(
        F.coalesce("b.fingerprint", "a.fingerprint").alias("fingerprint"),
        F.when(gone, "gone").when(new, "new").otherwise("changed").alias("change"),
        F.when(gone | new, F.array().cast("array<string>")).otherwise(differ).alias("fields"),
        old.alias("price_before"), young.alias("price_after"),
        F.coalesce(F.abs(young - old) > F.abs(old) * jump, F.lit(False)).alias("price_jump"),
    )
    return rows.filter((F.col("change") != "changed") | (F.size("fields") > 0))


def shape_histogram(elements: DataFrame) -> DataFrame:
    """``field, kind, n`` over the products among list elements, with one row of an empty field that counts the products.

    Kinds are STRING, NUMBER, BOOLEAN, OBJECT, ARRAY and VOID (a JSON null). Histograms of parts of a table add up.
    """
    item = jsonld.node(F.col("element"), "$.item")
    typed = elements.select(F.explode_outer(F.array(item)).alias("item")).filter(jsonld.has_type(F.col("item"), "Product"))
    fields = F.try_variant_get("item", "$", "map<string,variant>")
    name = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kind = F.when(name.isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), "NUMBER").otherwise(name)
    named = typed.select(F.explode_outer(fields).alias("field", "value")).select("field", kind.alias("kind"))
    total = typed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("field"), F.lit("").alias("kind"), "n")
    return named.filter("field is not null").groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n")).unionByName(total)


def merge_histograms(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("field", "kind").agg(F.sum("n").alias("n"))


def shape_drift(before: DataFrame, after: DataFrame, limit: float = 0.1) -> DataFrame:
    """``field, distance, drifted`` for every field of either histogram.

    The distance is the total variation between the shares of kinds, a missing field being a kind: 0 for equal shapes,
    1 where no product has the kind it had. Histograms are small: fields times kinds.
    """

    def shares(histogram: DataFrame, name: str) -> DataFrame:
        total = histogram.filter("field = ''").agg(F.sum("n")).first()[0]
        return histogram.filter("field <> ''").select("field", "kind", (F.col("n") / F.lit(total or 1)).alias(name))

    both = shares(before, "p").join(shares(after, "q"), ["field", "kind"], "full_outer").fillna(0.0, ["p", "q"])
    per_field = both.groupBy("field").agg(F.sum(F.abs(F.col("p") - F.col("q"))).alias("moved"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    distance = (F.col("moved") + F.abs(F.col("p") - F.col("q"))) / 2
    return per_field.select("field", distance.alias("distance"), (distance > limit).alias("drifted"))


def coverage_metrics(products: DataFrame, fields: tuple[str, ...] = COVERAGE_FIELDS) -> list[Column]:
    """Metrics for ``observe()`` on a table while it is written: ``total``, and the filled rows of each field."""
    return [F.count(F.lit(1)).alias("total"), *[filled(products, f).alias(f) for f in fields]]


def coverage_alert(spark: SparkSession, counts: dict[str, int], fields: tuple[str, ...] = COVERAGE_FIELDS, least: float = LEAST_COVERAGE) -> DataFrame:
    """``field, filled, total, pct, alert`` from the observed counts; a table without rows alerts for no field."""
    total = counts["total"]
    rows = [(f, counts[f], total, round(counts[f] * 100.0 / total, 2) if total else 0.0) for f in fields]
    return spark.createDataFrame([(*r, bool(total) and r[3] < least) for r in rows], "field string, filled bigint, total bigint, pct double, alert boolean")
