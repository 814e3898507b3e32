"""Token files compressed by a Re-Pair grammar per shard.

Documents are range-partitioned and sorted by id, tokenised, and cut into shards of consecutive documents. In a shard
the most frequent pairs of neighbouring ids are replaced by new symbols, round after round, until no pair is frequent; a
pair never spans two documents. A shard is one row of a Parquet table: the rules (two symbols each), the expansion
length of each rule, the remaining symbols, and per document its id and the ends of its symbols and tokens, so any
document is decoded alone, from its own symbols.

Defined cases: null text counts as empty (only the end id); a text longer than a shard makes a shard of its own; null ids
come first; repeated ids stay neighbours in an undefined but stored order; an empty table gives an empty folder; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binaries, kind, parts, ragged, slices
from .tokens import encoder

END = 2
#: Tokens of a shard, the vocabulary's size, and the count below which a pair stays.
SHARD_TOKENS, BASE, LEAST = 1 << 19, 49_408, 16
# A pair of symbols as one number: the left one in the upper half. No pair is NONE.
HALF, LOW, NONE = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFFFFFFFFFF)


def _frequent_pairs(key: np.ndarray, skipped: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of frequent pairs, their rules, keys of the rules by falling count) for pairs found ``least`` times or more.

    The pairs at the positions ``skipped`` do not count; they are sorted behind all others.
    Pairs are counted by sorting. Symbols take far less than 32 bits, so that as a rule a pair and its position fit into one
    number, and plain values are sorted; if they don't, as in a very long text, positions are sorted by their pairs.
    """
    n, left = len(key), len(key) - len(skipped)
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), key[:0]
    width, bits = int((key & LOW).max()).bit_length(), n.bit_length()
    if (int(key.max()) >> 32).bit_length() + width + bits <= 64:
        pairs = key >> HALF
        pairs <<= np.uint64(width)
        pairs |= key & LOW
        pairs <<= np.uint64(bits)
        pairs |= np.arange(n, dtype=np.uint64)
        pairs[skipped] = NONE
        pairs.sort()
        pairs = pairs[:left]
        at = pairs & np.uint64((1 << bits) - 1)
        at = at.view(np.int64)
        pairs >>= np.uint64(bits)
    else:
        pairs = key.copy()
        pairs[skipped] = NONE
        at = np.argsort(pairs, kind="stable")[:left]
        pairs = key[at]
    first = np.append(0, np.flatnonzero(pairs[1:] != pairs[:-1]) + 1)
    counts = np.diff(first, append=left)
    chosen = np.flatnonzero(counts >= least)
    chosen = chosen[np.argsort(-counts[chosen], kind="stable")]
    first, counts = first[chosen], counts[chosen]
    rule_at = np.zeros(n, dtype=np.int32)
    rule_at[at[ragged(first, counts)]] = np.repeat(np.arange(1, len(chosen) + 1, dtype=np.int32), counts)
    hit = np.flatnonzero(rule_at)
    return hit, rule_at.take(hit).astype(np.int64) - 1, key[at[first]]


def compress(ids: np.ndarray, ends: np.ndarray, base: int = BASE, rounds: int | None = None, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, their ends per document, rules of shape n x 2). Symbol ``base + i`` stands for rule i.

    Rounds go on until no pair is found ``least`` times (or for ``rounds``). The symbols are a linked list. From the second
    round on only pairs with a new symbol and those that were frequent before are counted, as no other count can have grown.
    """
    n, ends = len(ids), ends.astype(np.int64)
    symbols = np.append(ids.astype(np.uint32), np.uint32(0))
    # Neighbours inside a document; place n stands for none.
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[n] = before[n] = n
    after[ends[ends > 0] - 1] = n
    before[np.append(0, ends[ends < n])] = n
    live = np.ones(n, dtype=bool)
    rules = [np.zeros((0, 2), dtype=np.uint32)]
    made = 0
    counted, single = np.arange(n), ends[ends > 0] - 1
    while rounds is None or rounds > 0:
        rounds = None if rounds is None else rounds - 1
        following = after.take(counted)
        key = symbols.take(counted).astype(np.uint64) << HALF if made else symbols[:n].astype(np.uint64) << HALF
        key |= symbols.take(following) if made else symbols[1:]
        # In a run of one symbol every second pair overlaps the one before it and does not count.
        run = np.flatnonzero(key[1:] == key[:-1])
        run = run[following[run] == counted[run + 1]] + 1
        start = np.maximum.accumulate(np.where(np.diff(run, prepend=-1) > 1, run, 0))
        odd = run[(run - start) % 2 == 0]
        overlapping = counted[odd]
        # In the first round the last symbol of each document stands among the pairs, too.
        hit, rank, found = _frequent_pairs(key, odd if made else np.union1d(odd, single), least)
        place = frequent = counted[hit]
        # Of overlapping hits the more frequent pair goes first: a hit stays if none of its neighbours ranks higher.
        near = after.take(place[:-1]) == place[1:]
        lost = np.zeros(len(place), dtype=bool)
        lost[1:] |= near & (rank[:-1] < rank[1:])
        lost[:-1] |= near & (rank[1:] < rank[:-1])
        stay = np.flatnonzero(~lost)
        place, rank = place.take(stay), rank.take(stay)
        # A pair that keeps too few places waits; the most frequent one keeps all of its own, so each round gets on.
        used = np.bincount(rank, minlength=len(found)) >= least
        if not used.any():
            break
        stay = np.flatnonzero(used.take(rank))
        place, rank = place.take(stay), (np.cumsum(used) - 1).take(rank.take(stay))
        gone = after.take(place)
        symbols[place] = base + made + rank
        live[gone] = False
        after[place] = beyond = after.take(gone)
        before[beyond] = place
        found = found[used]
        rules.append(np.stack([found >> HALF, found & LOW], axis=1).astype(np.uint32))
        made += len(found)
        again = np.zeros(n + 1, dtype=bool)
        again[frequent] = again[overlapping] = again[place] = again[before.take(place)] = True
        again[gone] = again[n] = False
        counted = np.flatnonzero(again)
        counted = counted[after.take(counted) < n]
    return symbols[:n][live], np.concatenate([[0], np.cumsum(live)])[ends], np.concatenate(rules)


def expansion_lengths(rules: np.ndarray, base: int = BASE) -> np.ndarray:
    """Tokens that each rule stands for; a rule only uses earlier rules."""
    lengths = np.zeros(len(rules), dtype=np.uint32)
    left = rules.astype(np.int64) - base
    todo = np.arange(len(rules))
    while len(todo):
        sides = left[todo]
        known = np.where(sides < 0, 1, lengths[np.maximum(sides, 0)])
        ready = (known > 0).all(axis=1)
        lengths[todo[ready]] = known[ready].sum(axis=1)
        todo = todo[~ready]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, base: int = BASE, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for; each pass opens one level of the rules that are still closed.

    ``lengths`` are the rules' expansion lengths, if they are at hand.
    """
    symbols = symbols.astype(np.uint32)
    closed = np.flatnonzero(symbols >= base)
    if not len(closed):
        return symbols
    lengths = expansion_lengths(rules, base) if lengths is None else lengths
    sizes = np.ones(len(symbols), dtype=np.int64)
    sizes[closed] = lengths[symbols[closed] - base]
    place = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint32)
    out[place] = symbols
    place = place[closed]
    while len(place):
        left, right = rules[out[place] - base].T
        width = np.ones(len(place), dtype=np.int64)
        inner = left >= base
        width[inner] = lengths[left[inner] - base]
        out[place], out[place + width] = left, right
        place = np.concatenate([place[inner], (place + width)[right >= base]])
    return out


SHARD = "part int, shard int, first_token bigint, rules binary, rule_lengths binary, symbols binary, symbol_ends array<bigint>, token_ends array<bigint>"


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token ids of all documents below ``path``, in ascending order of ids."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id").withColumn("part", F.spark_partition_id())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        names, ids, totals, first, number, part = [], [], [], 0, 0, None

        def close() -> pa.RecordBatch:
            flat, counts = np.concatenate(ids), np.concatenate(totals)
            token_ends = np.cumsum(counts)
            symbols, symbol_ends, rules = compress(flat, token_ends)
            cells = [binaries(x.reshape(-1), np.array([x.size])) for x in (rules.astype("<u4"), expansion_lengths(rules).astype("<u4"), symbols.astype("<u4"))]
            ends = [pa.array([x], type=pa.list_(pa.int64())) for x in (symbol_ends, token_ends)]
            ids_of = pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays(names))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first]), *cells, *ends, ids_of], names=[x.split()[0] for x in SHARD.split(", ")] + ["doc_ids"])

        for batch in slices(batches, "text"):
            part = batch.column("part")[0].as_py()
            got, counts = encode(batch.column("text"))
            counts = counts + 1
            flat = np.full(int(counts.sum()), end, dtype=np.uint32)
            inside = np.ones(len(flat), dtype=bool)
            inside[np.cumsum(counts) - 1] = False
            flat[inside] = got
            # A shard ends with the document that fills it.
            ends = np.append(0, np.cumsum(counts))
            at = 0
            while at < len(counts):
                room = shard_tokens - sum(map(len, ids))
                stop = min(len(counts), int(np.searchsorted(ends, ends[at] + room)))
                names.append(batch.column("doc_id").slice(at, stop - at))
                ids.append(flat[ends[at] : ends[stop]])
                totals.append(counts[at:stop])
                at = stop
                if sum(map(len, ids)) >= shard_tokens:
                    yield close()
                    first, number = first + sum(map(len, ids)), number + 1
                    names, ids, totals = [], [], []
        if names:
            yield close()

    ordered.mapInArrow(shards, f"{SHARD}, doc_ids array<{kind(rows, 'doc_id')}>").write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids (binary, little-endian unsigned 32 bit)."""
    stored = spark.read.parquet(path)
    id_kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    ends = stored.select("part", "first_token", F.coalesce(F.element_at("token_ends", -1), F.lit(0)).alias("n"))
    # One row per range partition of the writer: as many as its shuffle had, whatever the data's size.
    totals = ends.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("doc_ids", "symbol_ends", "token_ends")}
                rules = np.frombuffer(batch.column("rules")[i].as_py(), dtype="<u4").reshape(-1, 2)
                symbols = np.frombuffer(batch.column("symbols")[i].as_py(), dtype="<u4")
                ids = expand(symbols, rules, lengths=np.frombuffer(batch.column("rule_lengths")[i].as_py(), dtype="<u4")).astype("<u4")
                counts = np.diff(np.asarray(row["token_ends"].values), prepend=0)
                start = batch.column("first_token")[i].as_py() + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), batch.column("part")[i].as_py(), dtype=np.int32)), row["doc_ids"].values, pa.array(start), pa.array(counts), binaries(ids, counts)],
                    names=["part", "doc_id", "in_part", "n_tokens", "ids"],
                )

    rows = stored.mapInArrow(decode, f"part int, doc_id {id_kind}, in_part bigint, n_tokens bigint, ids binary")
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("in_part") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def document(stored_row: dict, index: int, base: int = BASE) -> np.ndarray:
    """Random access: the ids of document ``index`` of a shard, from its own symbols only."""
    rules = np.frombuffer(stored_row["rules"], dtype="<u4").reshape(-1, 2)
    ends = stored_row["symbol_ends"]
    first = ends[index - 1] if index else 0
    symbols = np.frombuffer(stored_row["symbols"], dtype="<u4")[first : ends[index]]
    return expand(symbols, rules, base, np.frombuffer(stored_row["rule_lengths"], dtype="<u4"))


def token_at(stored_row: dict, position: int, base: int = BASE) -> int:
    """Random access: one token of a shard, found by descending through expansion lengths."""
    rules = np.frombuffer(stored_row["rules"], dtype="<u4").reshape(-1, 2)
    lengths = np.frombuffer(stored_row["rule_lengths"], dtype="<u4")
    index = int(np.searchsorted(np.asarray(stored_row["token_ends"]), position, side="right"))
    position -= stored_row["token_ends"][index - 1] if index else 0
    first = stored_row["symbol_ends"][index - 1] if index else 0
    symbols = np.frombuffer(stored_row["symbols"], dtype="<u4")[first : stored_row["symbol_ends"][index]].astype(np.int64)
    sizes = np.where(symbols < base, 1, lengths[np.maximum(symbols - base, 0)]) if len(lengths) else np.ones(len(symbols), dtype=np.int64)
    at = int(np.searchsorted(np.cumsum(sizes), position, side="right"))
    position -= int(sizes[:at].sum())
    symbol = int(symbols[at])
    while symbol >= base:
        left, right = (int(x) for x in rules[symbol - base])
        width = 1 if left < base else int(lengths[left - base])
        symbol, position = (left, position) if position < width else (right, position - width)
    return symbol
