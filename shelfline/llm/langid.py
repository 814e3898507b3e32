"""Language identification by compression.

Per language, raw text becomes a zstandard content dictionary. A text, lower-cased and with everything but letters as
blanks, is cut into fixed chunks, each compressed with every dictionary; the language whose dictionary gives the fewest
bytes in total wins, and a draw is settled by the strongest compression level. A narrow margin between the two best makes
the answer rejected.

Training reads only texts and labels of documents that are not held out: a bounded sample per language (``SAMPLE_ROWS``
rows with the smallest hashes, one excerpt of at most ``EXCERPT`` characters of each, ``DICTIONARY`` bytes in all), so what reaches
the driver is bounded by the number of languages. Excerpts are cut, and most of a large table is left out, before rows move. Prediction reads the whole text and nothing else.

Defined cases: null text and text without a letter give ``und`` with score 0 and are rejected; without any label
everything is ``und``; equal sizes go to the language first in alphabetical order; repeated rows get equal answers; a
null id is not held out; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import is_small, materialize
from .common import held_out, kind, slices

SAMPLE_ROWS, EXCERPT, DICTIONARY, SPARE = 400, 1_000, 112 << 10, 8
LEVEL, STRONGEST, CHUNK = 5, 19, 2048
#: A text is rejected when the best language saves less than this share of the second best one's bytes.
MARGIN = 0.004
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> bytes:
    """What is compressed: lower-case words and blanks, in UTF-8."""
    return OTHER.sub(" ", text.lower()).encode()


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language -> dictionary bytes, from labelled documents that are not held out."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = known.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    h = F.xxhash64("doc_id", "text")
    at = F.pmod(h, F.greatest(F.char_length("text") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    excerpts = rows.select("lang", h.alias("h"), F.substring("text", at, F.lit(EXCERPT)).alias("text"))
    # A bound on the hash, from the number of rows of the language, leaves SPARE times the sample at any size of the table.
    counts = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    share = F.least(F.lit(1.0), F.lit(float(SPARE * SAMPLE_ROWS)) / F.col("n"))
    near = excerpts.join(F.broadcast(counts), "lang").filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)) if is_small(counts) else excerpts
    order = Window.partitionBy("lang").orderBy("h", "text")
    chosen = near.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE_ROWS).select("lang", "k", "text")
    found: dict[str, list[tuple[int, str]]] = {}
    for row in chosen.collect():
        found.setdefault(row["lang"], []).append((row["k"], row["text"]))
    return {name: letters("\n".join(x for _, x in sorted(parts)))[-DICTIONARY:] for name, parts in sorted(found.items())}


class Sizes:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        parameters = zstandard.ZstdCompressionParameters.from_level(level, dict_size=DICTIONARY, source_size=CHUNK, write_content_size=0, write_dict_id=0)
        self.dictionaries, self.level, self.packers, self.stronger = dictionaries, level, [], None
        for content in dictionaries.values():
            ready = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ready.precompute_compress(compression_params=parameters)
            self.packers.append(zstandard.ZstdCompressor(dict_data=ready, compression_params=parameters))

    def __call__(self, text: str) -> np.ndarray:
        content = letters(text)
        chunks = [content[i : i + CHUNK] for i in range(0, len(content), CHUNK)]
        got = np.array([sum(len(packer.compress(chunk)) for chunk in chunks) for packer in self.packers], dtype=np.float64)
        if self.level != STRONGEST and len(got) > 1 and np.count_nonzero(got == got.min()) > 1:
            self.stronger = self.stronger or Sizes(self.dictionaries, STRONGEST)
            return self.stronger(text)
        return got


def lead(sizes: np.ndarray) -> float:
    """Share of the second best size that the best one saves."""
    if len(sizes) < 2:
        return 1.0
    best, second = np.partition(sizes, 1)[:2]
    return 1 - best / second


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes = list(dictionaries), Sizes(dictionaries)
        for batch in slices(batches, "text"):
            best, score, rejected = [], [], []
            for value in batch.column("text").to_pylist():
                if not names or not LETTER.search(value):
                    best.append(UNKNOWN)
                    score.append(0.0)
                    rejected.append(True)
                    continue
                got = sizes(value)
                best.append(names[int(got.argmin())])
                score.append(min(1.0, 0.5 + 5 * lead(got)))
                rejected.append(lead(got) < margin)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array([bool(x) for x in rejected], pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(predict, f"doc_id {kind(rows, 'doc_id')}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The documents whose language is clear, with all their columns; rows never leave their task."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(dictionaries)
        for batch in slices(batches, text):
            clear = [is_clear(value, sizes, margin) for value in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(clear, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def is_clear(value: str | None, sizes: Sizes, margin: float = MARGIN) -> bool:
    if value is None or not sizes.packers or not LETTER.search(value):
        return False
    return lead(sizes(value)) >= margin
