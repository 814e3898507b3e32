"""Removal of repeated byte strings by a distributed merge sort of suffixes that never compares a known prefix twice.

A byte goes when some ``LENGTH`` bytes around it also start earlier in the corpus. Sorting every suffix is not needed to
know that: every string of ``LENGTH`` bytes has one anchor, its smallest hashed ``GRAM`` bytes, which is the same wherever
the string occurs. So only suffixes that start at anchors are sorted, each for the strings it anchors.

1. Equal texts are one text (the smallest id); later copies are covered whole.
2. Anchors of all texts are found; those whose bytes occur once in the corpus are dropped.
3. Each task sorts the suffixes at its remaining anchors into runs, one for each part of the hash space of what follows or
   precedes the anchor, merges equal ones, front-codes them (common prefix with the one before, and the rest), and the
   runs are exchanged.
4. A part is merged by a loser tree that keeps, at each node, the prefix its loser shares with the winner: a comparison
   looks at two lengths first and reads bytes only beyond the known prefix. From the merged order, the strings that
   share both sides of the anchor follow at every offset, and all but the earliest are marked.
5. Marks become spans of each text, and the text is cut.

Defined cases: null text counts as empty; texts shorter than ``LENGTH`` lose nothing; a null id comes before all others,
and different texts under one id are ordered by their hash; of repeated rows one is the first and the others are
copies; an empty table gives an empty result; other columns are not read. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bucketed, bytes_of, parts, ragged, slices
from .shingles import mixed

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
#: Offsets from here on are routed by the bytes before the anchor, smaller ones by those after it.
TURN = SPAN // 2
#: Bits of a window's minimum that hold the place, so that of equal grams the last one wins.
PLACE = np.uint64(28)
LOW = np.uint64((1 << 28) - 1)
#: Text bytes for which one part is made; bytes of suffixes that a task sorts at once.
PART_BYTES, RUN_BYTES = 16 << 20, 24 << 20
SLICE = 2 << 20
#: Text bytes hashed at once: the hashes, eight bytes each, and their minima stay in a core's cache.
BLOCK = 1 << 17
FIRST = -(1 << 63)
_table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of every ``GRAM`` bytes, by doubling the length."""
    hashes, size, factor = _table[raw], 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        size, factor = size * 2, factor * factor % (1 << 64)
    return mixed(hashes)


def anchors(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, least and largest offset of the strings it anchors) of texts that lie one after another in ``raw``."""
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return empty.view(np.uint64), empty, empty, empty
    hashes = gram_hashes(raw)
    least = LOW - np.arange(len(hashes), dtype=np.uint64)
    least |= hashes & ~LOW
    size = 1
    while size * 2 <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < SPAN:
        least = np.minimum(least[: -(SPAN - size)], least[SPAN - size :])
    # No string starts in the last bytes of a text; in a short one that reaches into the last bytes of the one before.
    outside = np.maximum(ends - LENGTH + 1, 0)
    inside = np.ones(len(raw), dtype=bool)
    inside[ragged(outside, ends - outside)] = False
    inside = inside[: len(least)]
    # A minimum holds its place, so it changes when the place does.
    edge = np.ones(len(least), dtype=bool)
    np.not_equal(least[1:], least[:-1], out=edge[1:])
    edge[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(least)) - 1
    kept = inside[first]
    first, last = first[kept], last[kept]
    found = (LOW - (least[first] & LOW)).astype(np.int64)
    return hashes[found], found, found - last, found - first


def bytes_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, one after another, and where each ends), without copies; texts hold no null."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, bounds[1:] - bounds[0]


def texts_of(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, sub, digest, n_bytes; texts: one row per distinct text, stored in buckets by id)."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(FIRST)).alias("doc_id"), F.sha2(content.cast("binary"), 256).alias("digest"), F.octet_length(content).cast("bigint").alias("n_bytes"), content.alias("text"))
    rows = materialize(base.groupBy("doc_id", "digest", "n_bytes").agg(F.count(F.lit(1)).cast("int").alias("n")), "repeat-rows")
    # Ids name one text each, as a rule; if not, the hash of the text orders the texts of an id.
    shared = not rows.groupBy("doc_id").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("sub", F.xxhash64("digest") if shared else F.lit(0).cast("bigint"))
    least = rows.groupBy("digest").agg(F.min(F.struct("doc_id", "sub")).alias("least"))
    least = least.select("digest", F.col("least.doc_id").alias("doc_id"), F.col("least.sub").alias("sub"))
    firsts = base.select("doc_id", "digest", "text").dropDuplicates(["doc_id", "digest"]) if rows.filter("n > 1").limit(1).count() else base.select("doc_id", "digest", "text")
    texts = firsts.join(least, ["doc_id", "digest"]).select("doc_id", "sub", "digest", "text")
    return rows, bucketed(texts.repartition(parts(spark), "doc_id"), "texts", "doc_id")


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """doc_id, sub, anchors: per text, its anchors that occur elsewhere too, packed as place, least and largest offset."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK):
            raw, ends = bytes_in(batch.column("text"))
            key, place, least, most = anchors(raw, ends)
            owner = np.searchsorted(ends, place, side="right")
            local = place - np.append(0, ends)[owner]
            packed = (local << 16) | (least << 8) | most
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("doc_id").take(pa.array(owner)), batch.column("sub").take(pa.array(owner)), pa.array(packed)], names=["key", "doc_id", "sub", "anchor"])

    found = texts.select("doc_id", "sub", "text").mapInArrow(find, "key bigint, doc_id bigint, sub bigint, anchor bigint")
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    # As many anchors as the text has at most: a text's own list.
    return found.join(again, "key").groupBy("doc_id", "sub").agg(F.collect_list("anchor").alias("anchors"))


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b)) - known
    if n <= 0:
        return known
    differ = int.from_bytes(a[known : known + n], "big") ^ int.from_bytes(b[known : known + n], "big")
    return known + n - (differ.bit_length() + 7) // 8


class Run:
    """Sorted suffixes, each known by its common prefix with the one before."""

    def __init__(self, strings: list[bytes], shared: list[int]):
        self.strings, self.shared = strings, shared


def merge(runs: list[Run]) -> tuple[list[int], list[int], list[int]]:
    """Loser-tree merge: (run, index in the run, common prefix with the suffix before) in sorted order.

    Every contestant carries the length of its common prefix with the last winner. The longer one is the smaller
    string; only equal lengths make bytes be read, from that length on.
    """
    runs_n = len(runs)
    leaves = 1 << max(0, runs_n - 1).bit_length()
    strings = [r.strings for r in runs] + [[]] * (leaves - runs_n)
    shared = [r.shared for r in runs] + [[]] * (leaves - runs_n)
    at = [0] * leaves
    current: list[bytes | None] = [s[0] if s else None for s in strings]
    known = [0] * leaves  # of each stream's current string, against the last winner or the one that beat it
    loser = [0] * leaves

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix is then against the winner."""
        a, b = current[x], current[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        length = common_prefix(a, b, known[x])
        if a[length : length + 1] <= b[length : length + 1]:
            known[y] = length
            return x, y
        known[x] = length
        return y, x

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if leaves > 1 else 0
    out_run, out_index, out_shared = [], [], []
    while current[winner] is not None:
        index = at[winner]
        out_run.append(winner)
        out_index.append(index)
        out_shared.append(known[winner])
        index += 1
        at[winner] = index
        own = strings[winner]
        if index < len(own):
            current[winner], known[winner] = own[index], shared[winner][index]
        else:
            current[winner] = None
        node = (winner + leaves) >> 1
        while node:
            other = loser[node]
            mine, theirs = current[winner], current[other]
            if theirs is None:
                pass
            elif mine is None or known[other] > known[winner]:
                loser[node], winner = winner, other
            elif known[other] == known[winner]:
                length = common_prefix(mine, theirs, known[winner])
                if mine[length : length + 1] <= theirs[length : length + 1]:
                    known[other] = length
                else:
                    known[winner] = length
                    loser[node], winner = winner, other
            node >>= 1
    return out_run, out_index, out_shared


RUN = "part bigint, ids binary, subs binary, places binary, least binary, most binary, shared binary, sizes binary, tails binary, before binary, covered binary"


def _pack_runs(records: list[tuple], part_count: int) -> Iterator[dict]:
    """Front-coded runs of records (part, suffix, before, id, sub, place, least, most)."""
    records.sort()
    start = 0
    while start < len(records):
        stop, part = start, records[start][0]
        while stop < len(records) and records[stop][0] == part:
            stop += 1
        kept, covered, before_suffix = [], [], None
        tails, shared, sizes = [], [], []
        last = None
        for record in records[start:stop]:
            _, suffix, before, doc, sub, place, least, most = record
            if last is not None and last[1] == suffix and last[2] == before and last[6] == least and last[7] == most:
                # The same strings in the same task: all but the earliest (records are sorted) are covered whole.
                covered += (doc, sub, place - most, place - least + LENGTH)
                continue
            length = common_prefix(before_suffix, suffix) if before_suffix is not None else 0
            tails.append(suffix[length:])
            shared.append(length)
            sizes.append(len(suffix) - length)
            kept.append(record)
            before_suffix, last = suffix, record
        columns = list(zip(*kept, strict=True))
        yield {
            "part": part, "ids": np.array(columns[3], "<i8").tobytes(), "subs": np.array(columns[4], "<i8").tobytes(), "places": np.array(columns[5], "<i8").tobytes(),
            "least": bytes(columns[6]), "most": bytes(columns[7]), "shared": bytes(shared), "sizes": bytes(sizes), "tails": b"".join(tails),
            "before": b"".join(columns[2]), "covered": np.array(covered, "<i8").tobytes(),
        }
        start = stop


def suffix_runs(texts: DataFrame, found: DataFrame, part_count: int) -> DataFrame:
    """The front-coded sorted runs of all tasks."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(list(_pack_runs(records, part_count)), schema=pa.schema([(x.split()[0], pa.int64() if x.endswith("bigint") else pa.binary()) for x in RUN.split(", ")]))
            records.clear()
            return out

        for batch in slices(batches, "text", SLICE):
            for doc, sub, text, packed in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "sub", "text", "anchors")), strict=True):
                raw = text.encode()
                for value in packed:
                    place, least, most = value >> 16, (value >> 8) & 255, value & 255
                    for low, high in ((least, min(most, TURN - 1)), (max(least, TURN), most)):
                        if low > high:
                            continue
                        known = raw[place - TURN : place + GRAM] if low >= TURN else raw[place : place + LENGTH - TURN + 1]
                        suffix, before = raw[place : place - low + LENGTH], raw[place - high : place]
                        # hash() of bytes differs between processes; routing must not.
                        part = xxhash.xxh3_64_intdigest(known) % part_count
                        records.append((part, suffix, before, doc, sub, place, low, high))
                        held += len(suffix) + len(before)
                if held >= RUN_BYTES:
                    yield flush()
                    held = 0
        if records:
            yield flush()

    return texts.select("doc_id", "sub", "text").join(found, ["doc_id", "sub"]).mapInArrow(sort, RUN)


def _suffix_of(tails: bytes, shared: bytes, sizes: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for length, size in zip(shared, sizes, strict=True):
        last = last[:length] + tails[at : at + size]
        at += size
        out.append(last)
    return out


def covered_strings(right: np.ndarray, before: np.ndarray, before_end: np.ndarray, least: np.ndarray, most: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order, whether the string at each offset also starts earlier: a matrix n x SPAN.

    ``right``: common prefix with the suffix before; ``before``: all bytes that precede the anchors, the i-th ending at
    ``before_end[i]``; ``rank``: the order of the anchors in the corpus.
    """
    order = np.argsort(rank, kind="stable")
    marks = np.zeros((len(rank), SPAN), dtype=bool)
    left = np.zeros(len(rank), dtype=np.uint64)
    for offset in range(SPAN):
        if offset:  # one more byte to the left
            reach = most >= offset
            left[reach] = mixed(left[reach] * np.uint64(257) + _table[before[before_end[reach] - offset]])
        same_right = np.cumsum(right < LENGTH - offset).astype(np.uint64)
        here = order[(least[order] <= offset) & (most[order] >= offset)]
        if len(here) < 2:
            continue
        key = mixed(left[here] ^ mixed(same_right[here] * np.uint64(0x9E3779B97F4A7C15)))
        by_key = np.argsort(key, kind="stable")
        ordered = key[by_key]
        marks[here[by_key[1:]], offset] = ordered[1:] == ordered[:-1]
    return marks


def spans(runs: DataFrame) -> DataFrame:
    """doc_id, sub, start, stop: bytes of strings that also start earlier."""

    def combine(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        ids, subs, places = (np.concatenate([np.frombuffer(r[x], dtype="<i8") for r in rows]) for x in ("ids", "subs", "places"))
        least, most = (np.frombuffer(b"".join(r[x] for r in rows), dtype=np.uint8).astype(np.int64) for x in ("least", "most"))
        out_run, out_index, out_shared = merge([Run(_suffix_of(r["tails"], r["shared"], r["sizes"]), list(r["shared"])) for r in rows])
        first = np.cumsum([0, *(len(r["shared"]) for r in rows)])
        at = first[np.array(out_run, dtype=np.int64)] + np.array(out_index, dtype=np.int64)
        before = np.frombuffer(b"".join(r["before"] for r in rows), dtype=np.uint8)
        rank = np.empty(len(at), dtype=np.int64)
        rank[np.lexsort((places[at], subs[at], ids[at]))] = np.arange(len(at))
        marks = covered_strings(np.array(out_shared, dtype=np.int64), before, np.cumsum(most)[at], least[at], most[at], rank)
        edges = np.diff(marks.astype(np.int8), axis=1, prepend=0, append=0)
        who, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1] - 1  # runs of marks alternate, row by row
        local = np.concatenate([np.frombuffer(r["covered"], dtype="<i8") for r in rows]).reshape(-1, 4)
        columns = [
            np.concatenate([ids[at][who], local[:, 0]]), np.concatenate([subs[at][who], local[:, 1]]),
            np.concatenate([places[at][who] - high, local[:, 2]]), np.concatenate([places[at][who] - low + LENGTH, local[:, 3]]),
        ]
        return pa.table([pa.array(x) for x in columns], names=["doc_id", "sub", "start", "stop"])

    return runs.groupBy("part").applyInArrow(combine, "doc_id bigint, sub bigint, start bigint, stop bigint")


def joined_spans(found: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping and touching spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((x["start"], x["stop"]) for x in found or []):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, texts, spans per text): what to cut, before anything is cut."""
    part_count = max(parts(docs.sparkSession), -(-bytes_of(docs, text) // PART_BYTES))
    rows, texts = texts_of(docs, doc_id, text)
    found = materialize(repeated_anchors(texts), "anchors")
    cuts = spans(suffix_runs(texts, found, part_count)).groupBy("doc_id", "sub").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows, texts, materialize(cuts, "spans")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary, the remaining bytes)."""
    rows, texts, cuts = repeated_spans(docs, doc_id, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            removed, counts, kept = [], [], []
            for value, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, gone = value.encode(), joined_spans(found)
                bounds = [0, *(x for pair in gone for x in pair), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
                removed.append(len(raw) - len(kept[-1]))
                counts.append(len(gone))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("sub"), batch.column("digest"), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())], names=["first_id", "first_sub", "digest", "n_removed", "n_spans", "kept"])

    done = texts.join(cuts, ["doc_id", "sub"], "left").select("doc_id", "sub", "digest", "text", "spans")
    done = done.mapInArrow(cut, "first_id bigint, first_sub bigint, digest string, n_removed bigint, n_spans bigint, kept binary")
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    is_first = (F.col("doc_id") == F.col("first_id")) & (F.col("sub") == F.col("first_sub")) & (F.col("copy") == 1)
    whole = ~is_first & (F.col("n_bytes") >= LENGTH)
    out = each.join(done, "digest")
    return out.select(
        F.when(F.col("doc_id") != FIRST, F.col("doc_id")).alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.col("n_spans")).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
