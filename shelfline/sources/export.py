"""JSON and CSV exports, written by all tasks in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import NESTED, PRODUCT_TYPES
from ..session import materialize
from .store import Store

# Fixed value: ISO text of a timestamp on export.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_columns(products: DataFrame, with_id: bool) -> DataFrame:
    """Columns in export order, timestamps as ISO text."""
    names = (["id"] if with_id else []) + list(PRODUCT_TYPES)
    cols = [F.date_format(n, ISO).alias(n) if n == "scraped_at" else F.col(n) for n in names]
    return products.select(*cols)


def json_rows(products: DataFrame) -> DataFrame:
    """One JSON object per product, id first, nulls kept."""
    rows = export_columns(products, True)
    return rows.select("id", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def _by_id(products: DataFrame) -> DataFrame:
    """Rows in order of ``id`` within and across the parts they are written to."""
    return products.repartitionByRange("id").sortWithinPartitions("id")


def write_json(products: DataFrame, path: str) -> None:
    """JSON Lines parts; their names follow the order of ids."""
    export_columns(_by_id(products), True).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _json_text(name: str) -> Column:
    return F.to_json(F.col(name))


def export_store(store: Store, folder: str) -> None:
    """The whole store as ``folder/json`` and ``folder/csv``, in insertion order."""
    rows = materialize(store.ordered(), "export")
    write_json(rows, f"{folder}/json")
    write_csv(rows, f"{folder}/csv")


def csv_rows(products: DataFrame) -> DataFrame:
    """Flat rows without id, nested columns as JSON text."""
    return export_columns(products, False).withColumns({n: _json_text(n) for n in NESTED})


def write_csv(products: DataFrame, path: str) -> None:
    """CSV parts with a header, in order of ``id`` where there is one; null and empty text both print as nothing."""
    csv_rows(_by_id(products) if "id" in products.columns else products).write.mode("overwrite").options(header=True, escape='"', emptyValue="", nullValue="").csv(path)
