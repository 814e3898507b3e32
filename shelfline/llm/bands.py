"""Compression bands: zstandard ratios of whole documents and of fixed chunks, against limits by length.

Text that compresses far better than prose repeats itself; text that hardly compresses carries no language. Limits
grow with length, as a compressor needs some text to learn from. Counts of words, symbols, repeated lines and repeated
3-word windows give the base rules.

Defined cases: null text has no words and fails the base rules; a text shorter than the first class, or a last chunk
shorter than ``LEAST_CHUNK``, is too short for a band and passes it; a long text is read whole, chunk by chunk; repeated
rows get equal answers; a null id is carried; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind, slices

LEVEL, CHUNK, LEAST_CHUNK = 3, 4096, 1024
#: (shortest length in bytes, lowest and highest ratio of the whole text); prose lies well inside.
WHOLE = ((256, 1.1, 3.2), (512, 1.3, 3.2), (1024, 1.45, 3.4), (4096, 1.6, 3.8), (16384, 1.6, 4.5))
#: Lowest and highest ratio of a chunk.
PART = (1.4, 3.8)
# Fixed values of the base rules: blanks, symbols, fewest words, largest percentage of words in repeated windows.
BLANKS, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
FEWEST_WORDS, MOST_REPEATED = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), dtype=np.int64, count=len(words))
    if len(seen) == len(ids):
        return 0
    if len(seen) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        _, inverse, counts = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1), axis=0, return_inverse=True, return_counts=True)
    again = (counts > 1)[inverse.ravel()]
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= again
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """The values of ``COUNTS`` for one text."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(raw.count(x) for x in BLANKS),
        sum(raw.count(x) for x in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < FEWEST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def ratios(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, float | None, float | None]:
    """Ratio of the whole text, and the lowest and highest ratio of its chunks; None where too short for a band."""
    if len(raw) < WHOLE[0][0]:
        return None, None, None
    whole = len(raw) / len(packer.compress(raw))
    if len(raw) <= CHUNK:
        return (whole, None, None) if len(raw) < LEAST_CHUNK else (whole, whole, whole)
    chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
    each = [len(x) / len(packer.compress(x)) for x in chunks if len(x) >= LEAST_CHUNK]
    return whole, min(each), max(each)


def in_bands(size: int, whole: float | None, lowest: float | None, highest: float | None) -> bool:
    for least, low, high in reversed(WHOLE):
        if size >= least:
            if not low <= whole <= high:
                return False
            break
    return lowest is None or (lowest >= PART[0] and highest <= PART[1])


def quality_bands(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, whole, lowest and highest ratio, kept."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            counts = [base_counts(text) for text in texts]
            failed = [base_failed(c[0], c[4]) for c in counts]
            found = [ratios(text.encode(), packer) for text in texts]
            kept = [not bad and in_bands(len(text.encode()), *r) for text, bad, r in zip(texts, failed, found, strict=True)]
            columns = [pa.array(x, pa.int64()) for x in zip(*counts, strict=True)]
            bands = [pa.array(x, pa.float64()) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(failed), *bands, pa.array(kept)],
                names=["doc_id", *COUNTS, "base_failed", "ratio", "chunk_lowest", "chunk_highest", "kept"],
            )

    return rows.mapInArrow(judge, f"doc_id {kind(rows, 'doc_id')}, {', '.join(f'{x} bigint' for x in COUNTS)}, base_failed boolean, ratio double, chunk_lowest double, chunk_highest double, kept boolean")
