"""Near-duplicate groups by MinHash signatures in an inverted join on their coordinates.

The shingle hashes of a document are dealt over ``BINS`` bins by their leading bits, and the smallest of each bin is one
coordinate of its signature (one-permutation MinHash). Bins are many, so a short document keeps nearly every shingle and
a long one is bounded. How many coordinates a document shares with a partner at 0.75 or more is bounded from below by
``needed`` (a miss is rarer than one in a million, at the very threshold).

1. Documents with equal shingle sets become one node.
2. Coordinates are ordered by how common they are (rare first; a sketch of fixed size, filled from all nodes, tells), and
   each node posts only a prefix, so long that two signatures with enough matches share one of its entries. Long lists
   of common coordinates are thereby hardly posted to.
3. Stars: each list has a centre (the node with the fewest entries before it). A node is compared with the centre it
   collides with most often, on the full shingle sets, and the links give first components.
4. Skip: lists whose nodes are all in one component are done. In the others, a pair across components is skipped when what
   follows its places in both prefixes cannot hold enough matches. A short list gives its remaining pairs at once. A long
   one is dealt out in blocks with the nodes' sets in few bits, and a task counts the common shingles of its pairs, so
   that only pairs above the threshold leave it. Both kinds are confirmed on the full shingle sets.
5. The links of both steps give the components.

Pairs inside a component are never made, so a group of n near copies costs about n comparisons. Nodes are named by 64 bits
of their set; of N distinct sets, two share a name with a chance of N * N / 2 ** 65.

Defined cases: null and empty text, or text of blanks, has no shingle and is linked with nothing; fewer than five words
are one shingle; a null id is smaller than no other and names no group unless all its members are null; repeated rows
share a group, and all rows that carry the group's id are kept; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bucketed, kind, parts, slices
from .graph import components
from .shingles import identity, shingle_sets

BINS, SIMILARITY, DEVIATIONS = 1 << 16, 75, 5.0
SHIFT = np.uint64(64 - BINS.bit_length() + 1)
#: Nodes of a block, and the set size from which a mark has 32 bits, not 16.
BLOCK, WIDE = 1024, 1024
#: Entries up to which a list counts as short: then its pairs are at most half as many for each entry.
SHORT = 32
#: Entries of the table of common coordinates: a fixed size, whatever the corpus.
ENTRIES = 1 << 22
#: Repeats within tasks from which a coordinate counts as common.
COMMON = 8
SLICE = 1 << 20


def needed(n: np.ndarray, m: np.ndarray, common: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Coordinates that a set of n shingles with m coordinates shares with a linked one, from below.

    ``common``: shingles that both hold at least; ``other``: shingles of the partner that it lacks at most. A shingle that
    the partner lacks takes away one match at most. A shingle only the partner has takes one away if it comes first in
    a bin of this set, with a chance below m / BINS / 2 each. A full signature is bounded by sampling instead.
    """
    hit = other * m / (2 * BINS)
    exact = m - (n - common) - (hit + (DEVIATIONS + 0.5) * np.sqrt(hit) + 3)
    j = SIMILARITY / 100
    sampled = j * m - DEVIATIONS * np.sqrt(j * (1 - j) * m * (1 - j * m / np.maximum(n, 1)))
    return np.maximum(1, np.ceil(np.maximum(exact, sampled)))


def needed_alone(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The same for a partner of unknown size: it holds 3/4 of this set, or lacks nothing and is 4/3 as large."""
    return needed(n, m, np.ceil(n * SIMILARITY / 100), n * (100 / SIMILARITY - 1))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest shingle of each bin that has one; its leading bits name the coordinate."""
    return shingles[np.flatnonzero(np.diff(shingles >> SHIFT, prepend=np.uint64(1 << 63)))]


def marks(shingles: np.ndarray) -> bytes:
    """The set in few bits per shingle; common marks count common shingles from above."""
    return (shingles & np.uint64(0xFFFFFFFF)).astype("<u4" if len(shingles) >= WIDE else "<u2").tobytes()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets reach the similarity."""
    if 100 * min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def members(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, node (null without shingles), n_shingles."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text"))
            nodes = pa.array([identity(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), nodes, pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "node", "n_shingles"])

    return rows.mapInArrow(read, f"doc_id {kind(rows, 'doc_id')}, node bigint, n_shingles bigint")


def nodes(docs: DataFrame, text: str) -> DataFrame:
    """One row per distinct shingle set, stored in buckets by node: node, marks, text."""
    rows = docs.select(F.coalesce(text, F.lit("")).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text"))
            real = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([identity(sets[i]) for i in real], pa.int64()), pa.array([marks(sets[i]) for i in real], pa.binary()), batch.column("text").take(pa.array(real, pa.int64()))],
                names=["node", "marks", "text"],
            )

    found = rows.mapInArrow(read, "node bigint, marks binary, text string").dropDuplicates(["node"])
    # Buckets let every later join by node leave the texts where they are.
    return bucketed(found, "nodes", "node")


def common_coordinates(found: DataFrame) -> np.ndarray:
    """Levels of ``ENTRIES`` hashed entries: the logarithm of how often their coordinates repeat within tasks, 0 for rare."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            again = n > 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(entry(keys[again])), pa.array(n[again])], names=["entry", "n"])

        for batch in slices(batches, "text", SLICE):
            held += [signature(s) for s in shingle_sets(batch.column("text"))]
            if sum(map(len, held)) > 1 << 21:
                yield flush()
        if held:
            yield flush()

    repeated = found.select("text").mapInArrow(count, "entry bigint, n bigint").groupBy("entry").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)
    levels = np.zeros(ENTRIES, dtype=np.uint8)
    table = repeated.select(F.col("entry").cast("int").alias("entry"), F.floor(F.log2("n")).cast("byte").alias("level")).toArrow()  # at most ENTRIES rows
    levels[np.asarray(table["entry"])] = np.asarray(table["level"])
    return levels


def entry(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - ENTRIES.bit_length() + 1)).astype(np.int64)


def posts(found: DataFrame, levels: np.ndarray) -> DataFrame:
    """The prefix of each signature: key (a coordinate and its value), node, and packed place in the prefix, sizes of signature and set."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast(levels)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = shared.value
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text"))
            signatures = [signature(s) for s in sets]
            sizes, m = (np.array([len(x) for x in xs], dtype=np.int64) for xs in (sets, signatures))
            keys = np.concatenate(signatures) if signatures else np.zeros(0, dtype=np.uint64)
            owner = np.repeat(np.arange(len(m)), m)
            order = np.lexsort((keys, level_of[entry(keys)], owner))
            place = np.arange(len(keys)) - np.repeat(np.cumsum(m) - m, m)
            kept = place < (m - needed_alone(sizes, m) + 1)[owner]
            first, place, owner = order[kept], place[kept], owner[kept]
            # Place and sizes travel as one number, with the place in its leading bits.
            packed = (place << 46) | (m[owner] << 29) | np.minimum(sizes[owner], (1 << 29) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), batch.column("node").take(pa.array(owner)), pa.array(packed)], names=["key", "node", "packed"])

    return found.select("node", "text").mapInArrow(deal, "key bigint, node bigint, packed bigint")


def may_match(n_a, m_a, at_a, n_b, m_b, at_b, ceil=np.ceil, sqrt=np.sqrt, least=np.minimum, most=np.maximum):
    """Whether what follows a shared entry in both signatures can hold the matches of a linked pair (arrays or columns)."""
    common = ceil(SIMILARITY * (n_a + n_b) / (100 + SIMILARITY))
    rest = least(m_a - at_a, m_b - at_b)

    def bound(n, m, other):
        hit = most((other - common) * m, 0 * m) / (2 * BINS)
        return m - (n - common) - (hit + (DEVIATIONS + 0.5) * sqrt(hit) + 3)

    return (common <= n_a) & (common <= n_b) & (rest >= bound(n_a, m_a, n_b)) & (rest >= bound(n_b, m_b, n_a))


def short_pairs(lists: DataFrame, open_lists: DataFrame) -> DataFrame:
    """Pairs (a, b) across components of the short lists that may match."""
    rows = lists.join(open_lists.filter(F.col("entries") <= SHORT).select("key"), "key")
    x, y = rows.alias("x"), rows.alias("y")
    sizes = [F.col(f"{side}.{name}") for side in "xy" for name in ("n", "m", "place")]
    fits = may_match(*sizes, ceil=F.ceil, sqrt=F.sqrt, least=F.least, most=F.greatest)
    across = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & fits
    return x.join(y, across).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _alike_in(block: dict[str, np.ndarray], cells: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs across components in one block pair of a list whose common marks reach the similarity."""
    count, left, right = len(cells), [], []
    comp, n, m, place, side, node = (block[x] for x in ("component", "n", "m", "place", "side", "node"))
    if (comp == comp[0]).all():
        return left, right
    sets = [np.frombuffer(x, "<u4" if size >= WIDE else "<u2") & np.uint32(0xFFFF) for x, size in zip(cells, n.tolist(), strict=True)]
    flag = np.zeros(1 << 16, dtype=np.int32)
    crossing = block["low"][0] != block["high"][0]
    for i in range(count - 1):
        rest = slice(i + 1, None)
        wanted = (comp[rest] != comp[i]) & may_match(n[i], m[i], place[i], n[rest], m[rest], place[rest])
        if crossing:
            wanted &= side[rest] != side[i]
        found = np.flatnonzero(wanted) + i + 1
        if not len(found):
            continue
        np.add.at(flag, sets[i], 1)
        both = np.array([np.count_nonzero(flag[sets[j]]) for j in found.tolist()])
        flag[sets[i]] = 0
        # Marks that fall together make the count of common shingles at most too high.
        good = found[(100 + SIMILARITY) * np.minimum(both, np.minimum(n[i], n[found])) >= SIMILARITY * (n[i] + n[found])]
        left.append(np.full(len(good), node[i]))
        right.append(node[good])
    return left, right


def long_pairs(lists: DataFrame, open_lists: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) across components of the long lists, counted inside tasks; a list of any length is dealt in blocks."""
    rows = lists.join(open_lists.filter(F.col("entries") > SHORT).select("key", "entries"), "key").join(found.select("node", "marks"), "node")
    blocks = F.ceil(F.col("entries") / BLOCK).cast("int")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    group = ["key", "low", "high"]
    dealt = rows.select(*group, "node", "component", "side", "place", "m", "n", "marks").repartition(parts(lists.sparkSession), *group).sortWithinPartitions(*group)
    names = [*group, "node", "component", "side", "place", "m", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def done(table: pa.Table, until: int) -> pa.RecordBatch:
            columns = {x: np.asarray(table[x])[:until].astype(np.int64) for x in names}
            cells = table["marks"].slice(0, until).to_pylist()
            edge = np.flatnonzero(np.any([np.diff(columns[x], prepend=columns[x][0] - 1 if x == "key" else columns[x][0]) != 0 for x in group], axis=0))
            a, b = [], []
            for start, stop in zip(edge.tolist(), [*edge[1:].tolist(), until], strict=True):
                if stop - start > 1:
                    left, right = _alike_in({x: v[start:stop] for x, v in columns.items()}, cells[start:stop])
                    a += left
                    b += right
            none = np.zeros(0, dtype=np.int64)
            x, y = np.concatenate([none, *a]), np.concatenate([none, *b])
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            table = fresh if kept is None else pa.concat_tables([kept, fresh])
            last = [table[x][-1].as_py() for x in group]
            same = np.all([np.asarray(table[x]) == v for x, v in zip(group, last, strict=True)], axis=0)
            until = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if until:
                yield done(table, until)
            kept = table.slice(until).combine_chunks()
        if kept is not None and kept.num_rows:
            yield done(kept, kept.num_rows)

    return dealt.mapInArrow(count, "a bigint, b bigint")


def confirmed(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    text = lambda side: found.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
    full = pairs.select("a", "b").join(text("a"), "a").join(text("b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 1 << 20):
            centres = batch.column("text_b").dictionary_encode()
            right = shingle_sets(centres.dictionary)
            left = shingle_sets(batch.column("text_a"))
            good = [linked(s, right[i]) for s, i in zip(left, centres.indices.to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return full.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint")


def links(found: DataFrame) -> DataFrame:
    """Links between nodes whose components are those of all links: a, b."""
    posted = posts(found, common_coordinates(found))
    heads = posted.groupBy("key").agg(F.min_by("node", "packed").alias("centre"), F.count(F.lit(1)).alias("entries")).filter("entries > 1")
    shared = materialize(posted.join(heads.select("key", "centre"), "key"), "lists")
    counted = shared.filter("node <> centre").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("hits"))
    stars = counted.groupBy("node").agg(F.max_by("centre", "hits").alias("b")).withColumnRenamed("node", "a")
    first = materialize(confirmed(stars, found), "star-links")
    named = shared.drop("centre").join(components(first), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = [F.shiftright("packed", 46).alias("place"), F.shiftright("packed", 29).bitwiseAND(F.lit((1 << 17) - 1)).alias("m"), F.col("packed").bitwiseAND(F.lit((1 << 29) - 1)).alias("n")]
    named = materialize(named.select("key", "node", "component", *sizes), "named-lists")
    open_lists = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("entries")).filter("low <> high")
    open_lists = materialize(open_lists, "open-lists")
    pairs = short_pairs(named, open_lists).unionByName(long_pairs(named, open_lists, found)).distinct()
    second = confirmed(materialize(pairs, "pairs"), found)
    return first.unionByName(materialize(second, "cross-links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = materialize(members(docs, doc_id, text), "members")
    found = nodes(docs, text)
    named = rows.filter("node IS NOT NULL").join(components(links(found)), "node", "left")
    named = named.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    grouped = named.join(least, "component").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that name their group, with all their columns."""
    keep = near_duplicates(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_keep_id")).distinct()
    return docs.join(keep, docs[doc_id].eqNullSafe(keep["_keep_id"]), "left_semi")
