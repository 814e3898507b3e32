"""Packing documents into sequences: first-fit decreasing with a tournament tree of bin capacities.

Each document becomes its token ids and an end id, cut into pieces of at most one sequence. Pieces are dealt into random
groups by a seeded hash of document and start; the groups are packed independently, so packing needs one shuffle and
no state beyond a group. Piece order, and so the packing, depends on the rows alone.

Defined cases: null text counts as empty (one piece with only the end id); a long text gives many pieces, dealt over all
groups; repeated rows are packed each; a null id is an id like any other; an empty table gives an empty result; other
columns are not carried and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, bytes_of, kind, slices
from .tokens import encoder

LENGTH = 2048
END = 1
#: Bytes of text for which one group of pieces is made.
GROUP_BYTES = 16 << 20
SEED = 20


class Tournament:
    """Bins in a tree whose nodes hold the largest free capacity below them; all bins start empty."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room: (bin, its free capacity before)."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        before = free[at]
        free[at] = before - size
        leaf = at - self.leaves
        while at > 1:
            at //= 2
            most = max(free[2 * at], free[2 * at + 1])
            if free[at] == most:
                break
            free[at] = most
        return leaf, before


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of items sorted from large to small; item i never needs a bin beyond i."""
    tree = Tournament(len(sizes), capacity)
    placed = [tree.place(size) for size in sizes.tolist()]
    bins = np.array([b for b, _ in placed], dtype=np.int64)
    return bins, np.array([capacity - before for _, before in placed], dtype=np.int64)


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (binary, little-endian unsigned 32 bit)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in slices(batches, "text"):
            ids, counts = encode(batch.column("text"))
            totals = counts + 1
            flat = np.full(int(totals.sum()), end, dtype="<u4")
            inside = np.ones(len(flat), dtype=bool)
            inside[np.cumsum(totals) - 1] = False
            flat[inside] = ids
            pieces = -(-totals // length)
            owner = np.repeat(np.arange(len(totals)), pieces)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            sizes = np.minimum(totals[owner] - start, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(sizes), pa.array(totals[owner]), binaries(flat, sizes)],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return rows.mapInArrow(cut, f"doc_id {kind(rows, 'doc_id')}, start bigint, length bigint, doc_tokens bigint, ids binary")


def pack(pieces: DataFrame, groups: int, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Pieces with sequence_id and offset; each group of pieces is packed by itself."""
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", F.lit(seed)), F.lit(groups)))

    def fill(group: pa.Table) -> pa.Table:
        # Rows stay where they are: only their order is sorted, as the ids of a group are most of a worker's memory.
        pa.default_memory_pool().release_unused()
        order = np.asarray(pc.sort_indices(group, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]))
        bins, offsets = np.empty((2, len(order)), dtype=np.int64)
        bins[order], offsets[order] = first_fit_decreasing(np.asarray(group["length"])[order], length)
        first = group["pack_group"][0].as_py() << 32
        return group.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("pack_group").applyInArrow(fill, f"doc_id {kind(pieces, 'doc_id')}, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Tokenise and pack: one row per piece with its ids and its place."""
    groups = max(1, -(-bytes_of(docs, text) // group_bytes))
    return pack(token_pieces(docs, tokenizer, doc_id, text, length, end), groups, length)
