"""Product codes of vectors, with codebooks found by integer Lloyd rounds and nearest entries found by LAESA.

Every component becomes ``floor(256 * x)``, vectors are cut into equal parts, and each part position has a codebook that
starts as that part of the smallest ids. Pivots of a part are a few of its first entries, far from each other, and stay
fixed: the distances from all parts to them are computed once and written with the parts. In a round, the distances
from the entries to the pivots give a lower bound of each distance between a part and an entry (the largest difference
over the pivots); entries are evaluated in integers in the order of these bounds, and those whose bound lies above
the best distance are never evaluated. Bounds are rounded so that they can only be too low, so results are exact.

Per round, each task sends one count and sum per part and entry; the new codebook is the only thing that reaches the
driver (entries times dimensions). The written parts are read once per round.

Defined cases: which rows count is said in ``vectors``; a dimension that the parts do not divide is filled up with zeros; with fewer rows than
entries the codebook has as many entries as rows; of equal ids the smaller vector comes first, null ids come last; an
entry without parts stays; repeated rows are coded alike, each for itself; components beyond ``BOUND`` count as it; an
error sum beyond a long is null; null labels form one group; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import is_small, materialize
from .common import binaries
from .vectors import blocks, floors, is_whole

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 16, 64, 2, 256, 3
#: A component's integer is at most this far from 0, so that squared distances of 1,024 dimensions fit a long.
BOUND = 1 << 25
#: Entries that are evaluated one after the other, by rising bound, before the rest that is left is evaluated at once.
PROBES = 2
SALTS = 16


def split(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows x parts x width, filled up with zeros."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    d = a - b
    return np.einsum("...w,...w->...", d, d)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Indices of ``count`` entries of a part: the first, then always the one farthest from the chosen in total."""
    chosen, total = [0], np.zeros(len(entries))
    while len(chosen) < min(count, len(entries)):
        total += np.sqrt(squares(entries, entries[chosen[-1]]))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance, exact evaluations) for the parts ``x`` of one position.

    ``to_pivots`` holds float32 distances from the parts to the pivots, ``entry_pivots`` those from the entries.
    """
    bound = np.abs(to_pivots[:, None, 0] - entry_pivots[None, :, 0])
    for p in range(1, to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, None, p] - entry_pivots[None, :, p]), out=bound)
    # Both distances carry a rounding error of float32; a bound must never lie above the distance.
    bound -= (to_pivots.max(axis=1, initial=0)[:, None] + entry_pivots.max(initial=0)) * np.float32(4e-7)
    rows, exact = np.arange(len(x)), np.full(bound.shape, np.iinfo(np.int64).max)
    best, evaluated = np.full(len(x), np.inf, dtype=np.float32), 0
    for _ in range(PROBES):
        open_ = rows[bound.min(axis=1) <= best]
        first = bound[open_].argmin(axis=1)
        exact[open_, first] = found = squares(x[open_], entries[first])
        bound[open_, first] = np.inf
        best[open_] = np.minimum(best[open_], np.sqrt(found).astype(np.float32) * np.float32(1 + 4e-7))
        evaluated += len(open_)
    row, entry = np.nonzero(bound <= best[:, None])
    exact[row, entry] = squares(x[row], entries[entry])
    index = exact.argmin(axis=1)  # of equal distances the first
    return index, exact[rows, index], evaluated + len(row)


class Codebook:
    """The entries of all positions in a round, and their distances to the pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots
        self.entry_pivots = np.sqrt(squares(entries[:, :, None, :], pivots[:, None, :, :])).astype(np.float32)

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry indices and squared distances, rows x parts."""
        found = [nearest(x[:, j], to_pivots[:, j], self.entries[j], self.entry_pivots[j])[:2] for j in range(x.shape[1])]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def book_hash(entries: np.ndarray) -> str:
    """Hash of all entries' components as text, by part, entry and place in the part."""
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, dtype: type, parts: int) -> np.ndarray:
    """Rows x parts x width of a column of equal binaries."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), parts, -1)


def _prepared(rows: DataFrame, size: int, pivots: np.ndarray, parts: int, scale: int) -> DataFrame:
    """Written table: vec_id, label, the parts as 32-bit integers, and their distances to the pivots."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            x = split(floors(batch.column("v"), scale, BOUND), parts)
            far = np.sqrt(squares(x[:, :, None, :], pivots[None])).astype(np.float32)
            cells = [binaries(a.reshape(-1), np.full(len(x), a[0].size)) for a in (x.astype(np.int32), far)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *cells], names=["vec_id", "label", "x", "far"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    whole = rows.filter(F.size("v") == size)
    return materialize(whole.mapInArrow(prepare, f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, far binary"), "parts")


def _update(prepared: DataFrame, book: Codebook) -> np.ndarray:
    """The entries after one round: the floor of the mean of their parts, or as before without any."""
    parts, entries, width = book.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in blocks(batches):
            x, far = _matrix(batch.column("x"), np.int32, parts).astype(np.int64), _matrix(batch.column("far"), np.float32, parts)
            codes, _ = book.assign(x, far)
            for j in range(parts):
                counts[j] += np.bincount(codes[:, j], minlength=entries)
                for w in range(width):  # exact: a block's sum is far below 2 ** 53
                    sums[j, :, w] += np.bincount(codes[:, j], weights=x[:, j, w], minlength=entries).astype(np.int64)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), *(pa.array(sums[part, entry, w]) for w in range(width))],
            names=["part", "entry", "n", *(f"s{w}" for w in range(width))],
        )

    columns = ["n", *(f"s{w}" for w in range(width))]
    partial = prepared.select("x", "far").mapInArrow(add, f"part bigint, entry bigint, {', '.join(f'{c} bigint' for c in columns)}")
    after = book.entries.copy()
    for row in partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in columns]).collect():
        after[row["part"], row["entry"]] = [row[f"s{w}"] // row["n"] for w in range(width)]
    return after


def _coded(prepared: DataFrame, book: Codebook) -> DataFrame:
    """Written table: vec_id, label, codes (one byte per part), error."""
    parts = book.entries.shape[0]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            codes, found = book.assign(_matrix(batch.column("x"), np.int32, parts).astype(np.int64), _matrix(batch.column("far"), np.float32, parts))
            cells = binaries(codes.astype(np.uint8).reshape(-1), np.full(len(codes), parts))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), cells, pa.array(found.sum(axis=1))], names=["vec_id", "label", "codes", "error"])

    kinds = ", ".join(f"{c} {prepared.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return materialize(prepared.mapInArrow(code, f"{kinds}, codes binary, error bigint"), "codes")


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together.

    Few labels are broadcast; many are joined, with the rows of each dealt over salts.
    """
    sums = materialize(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    if is_small(sums):
        right = F.broadcast(sums.withColumnRenamed("label", "_label"))
        return coded.join(right, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    right = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    left = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    return left.join(right, F.col("label").eqNullSafe(F.col("_label")) & (F.col("salt") == F.col("_salt"))).drop("salt", "_salt", "_label")


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """(one row per vector: vec_id, label, codes, error, label_error; the codebooks as parts x entries x width)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte, so a codebook has 1 to 256 entries")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")).filter(is_whole("v"))
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), F.size("v"), "v").limit(1).collect()
    size = len(first[0]["v"]) if first else 0
    start = rows.filter(F.size("v") == size).select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not start:
        none = rows.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"))
        return none.limit(0), np.zeros((parts, 0, 0), dtype=np.int64)
    found = split(floors(pa.array([r["v"] for r in start]), scale, BOUND), parts).transpose(1, 0, 2).copy()
    fixed = np.stack([choose_pivots(one, pivots) for one in found])
    prepared = _prepared(rows, size, fixed, parts, scale)
    for _ in range(rounds):
        found = _update(prepared, Codebook(found, fixed))
    return label_errors(_coded(prepared, Codebook(found, fixed))), found
