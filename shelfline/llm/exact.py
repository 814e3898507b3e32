"""Exact deduplication with skew-safe combining.

Rows are deduplicated where they lie (the partial aggregate keeps one row per distinct text of a task), the survivors
meet in salted digest groups, and the winners of the salts meet once more without the salt. The whole normalised text
is part of the grouping key at every stage, so a digest alone never decides. Once the groups are known, rows find theirs by
two unrelated digests and the length. A hot text reaches the first shuffle as one
row per task, is spread there over the salts, and leaves at most ``SALTS`` rows for the last stage.

Defined cases: null text counts as empty, and empty texts are equal to each other; a null id is smaller than any other;
of rows that share both text and the kept id, exactly one is kept; an empty table gives an empty result; other columns
of the input are not looked at and cannot clash, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import lower_ascii

SALTS = 16
#: What stands for a text once its group is known: two digests that have nothing in common, and its length.
MARKS = ["text_sha256", "second", "n_bytes"]


def normalised(text: Column) -> Column:
    """The text that decides equality: null as empty, A-Z lower-cased."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def marks(content: Column) -> list[Column]:
    return [F.sha2(content.cast("binary"), 256).alias("text_sha256"), F.xxhash64(content).alias("second"), F.octet_length(content).alias("n_bytes")]


def _salt(doc_id: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int")


def winners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: MARKS, keep_id, group_size."""
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("content"))
    rows = norm.select("doc_id", "content", F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256"), _salt("doc_id", salts).alias("salt"))
    salted = rows.groupBy("text_sha256", "salt", "content").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    final = salted.groupBy("text_sha256", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return final.select(*marks(F.col("content")), "keep_id", "group_size")


def _copies(docs: DataFrame, doc_id: str, text: str, salts: int) -> DataFrame:
    """Groups of two or more, once for each salt."""
    return winners(docs, doc_id, text, salts).filter("group_size > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are counted per id and text and expanded again at the end, so repeated rows stay apart. Only groups of two
    or more are joined, and their rows are dealt over salts on both sides.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *marks(normalised(F.col(text)))).groupBy("doc_id", *MARKS).agg(F.count(F.lit(1)).cast("int").alias("n"))
    joined = rows.withColumn("salt", _salt("doc_id", salts)).join(_copies(docs, doc_id, text, salts), [*MARKS, "salt"], "left")
    single = F.col("group_size").isNull()
    out = joined.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), "text_sha256", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns; of rows that share id and text, the first by text and hash of the columns.

    The groups are written as narrow rows before the documents are shuffled, once, to meet them. Rows of one text and id
    have one salt, so the last choice among them needs no further shuffle.
    """
    copies = materialize(_copies(docs, doc_id, text, salts).select(*MARKS, "salt", "keep_id"), "copies")
    row, hashable = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = docs.select(row.alias("row"), F.col(doc_id).alias("doc_id"), F.xxhash64(*hashable).alias("tie"), *marks(normalised(F.col(text)))).withColumn("salt", _salt("doc_id", salts))
    joined = rows.join(copies.withColumn("met", F.lit(True)), [*MARKS, "salt"], "left")
    winning = joined.filter(F.col("met").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    same = Window.partitionBy(*MARKS, "salt", "doc_id").orderBy(F.col(f"row.`{text}`"), "tie")
    return winning.withColumn("rank", F.row_number().over(same)).filter("rank = 1").select("row.*")
