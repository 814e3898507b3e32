"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

The words of every document stream through the automaton, which tracks the longest match with any item. A match goes
when it is at least ``LENGTH`` words long, or covers at least the share ``COVERAGE`` of the words of an item (so an item
of fewer words than ``LENGTH`` counts when it is there whole). Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the
text with A-Z lower-cased.

Items are dealt into shards of a proven size (``SHARD_BYTES`` of text; long items are cut into overlapping pieces that
keep every window), one automaton is built per shard in a task, and one shard at a time is broadcast. With one shard a
document never leaves its task. With more, documents are written once with a row number, every shard's matches are found
in their own pass, and only rows with a match meet by that number.

Defined cases: null text has no words; null or empty items match nothing; an item without an id hits words but has no name
and is not counted; rows with one item id are one item; repeated documents each get their row; equal items share all
windows; an empty table of documents gives an empty result, an empty table of items hits nothing; extra columns of any
name pass through ``decontaminate`` untouched (``OWN`` are appended and take the place of namesakes).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .automaton import Automaton, Builder, words_of
from .common import slices

LENGTH, COVERAGE = 10, 1.0
#: Text of the items in one automaton, and words of a piece of a long item.
SHARD_BYTES, PIECE_WORDS = 1 << 21, 1 << 14
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = "array<struct<start:bigint,stop:bigint,longest:bigint>>"
OWN = ["n_words", "n_hit", "item_ids"]
FOUND = f"n_words bigint, n_hit bigint, spans {SPANS}, item_ids array<string>"
FOUND_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("longest", pa.int64())])), pa.list_(pa.string())]


def _pieces(items: DataFrame, item_id: str, text: str, length: int, coverage: float) -> DataFrame:
    """Distinct ``owner, window, words`` of all items; the words are joined by blanks."""
    rows = items.select(F.col(item_id).cast("string").alias("owner"), F.col(text).alias("text")).filter("text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owners, windows, pieces = [], [], []
            for owner, raw in zip(batch.column("owner").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(raw)
                if not words:
                    continue
                window = min(length, ceil(coverage * len(words)))
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS - window + 1):
                    owners.append(owner)
                    windows.append(window)
                    pieces.append(b" ".join(words[at : at + PIECE_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.string()), pa.array(windows, pa.int32()), pa.array(pieces, pa.binary())], names=["owner", "window", "words"])

    return rows.mapInArrow(cut, "owner string, window int, words binary").distinct()


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text", length: int = LENGTH, coverage: float = COVERAGE, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """Written table ``shard, packed`` of the items' automata, and their number."""
    if not 0 < coverage <= 1 or not 0 < length < PIECE_WORDS:
        raise ValueError("coverage is a share of an item, length a number of words below PIECE_WORDS")
    pieces = materialize(_pieces(items, item_id, text, length, coverage), "item-pieces")
    shards = (pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // shard_bytes + 1
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("owner", "window", "words"), F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        builder = Builder()
        for owner, window, words in sorted(zip(*(table.column(c).to_pylist() for c in ("owner", "window", "words")), strict=True), key=lambda r: (r[2], r[1], r[0] or "")):
            builder.add(words.split(b" "), window, owner)
        return pa.table({"shard": table.column("shard").slice(0, 1), "packed": pa.array([builder.pack()], pa.binary())})

    return materialize(dealt.groupBy("shard").applyInArrow(build, "shard int, packed binary"), "automata"), shards


def _broadcast(built: DataFrame, shard: int) -> tuple[str, Broadcast]:
    """A name and one shard's automaton for the tasks; its size is bounded by that of a shard."""
    row = built.filter(F.col("shard") == shard).first()
    return uuid.uuid4().hex, built.sparkSession.sparkContext.broadcast(bytes(row["packed"]) if row else Builder().pack())


_open: dict[str, Automaton] = {}


def _automaton(shared: tuple[str, Broadcast]) -> Automaton:
    """The broadcast automaton, unpacked once in this worker process; only the last one is kept."""
    name, packed = shared
    if name not in _open:
        _open.clear()
        _open[name] = Automaton(packed.value)
    return _open[name]


def _runs(hit: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def _found(automaton: Automaton, texts: list[bytes]) -> list[pa.Array]:
    """The columns of ``FOUND`` for a batch of texts."""
    hits = automaton.match(texts)
    starts = hits.ends - hits.n_words
    spans: list[list[dict]] = [[] for _ in texts]
    runs = _runs(hits.hit)
    for (start, stop), text in zip(runs.tolist(), np.searchsorted(hits.ends, runs[:, 0]).tolist(), strict=True):
        spans[text].append({"start": start - int(starts[text]), "stop": stop - int(starts[text]), "longest": int(hits.longest[start:stop].max())})
    n_hit = [sum(s["stop"] - s["start"] for s in one) for one in spans]
    names = [sorted(x for x in hits.owners.get(i, ()) if x is not None) for i in range(len(texts))]
    columns = [hits.n_words.tolist(), n_hit, spans, names]
    return [pa.array(c, t) for c, t in zip(columns, FOUND_TYPES, strict=True)]


def _pass(rows: DataFrame, shared: tuple[str, Broadcast], key: str, only_hits: bool = False) -> DataFrame:
    """``key`` and the columns of ``FOUND`` for all rows ``key, text``, by one automaton."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared)
        for batch in slices(batches, "text"):
            found = _found(automaton, batch.column("text").cast(pa.binary()).to_pylist())
            out = pa.RecordBatch.from_arrays([batch.column(key), *found], names=[key, "n_words", "n_hit", "spans", "item_ids"])
            yield out.filter(pa.array(np.asarray(found[1]) > 0)) if only_hits else out

    return rows.mapInArrow(match, f"{key} {rows.schema[key].dataType.simpleString()}, {FOUND}")


def _united(spans: list[dict]) -> list[dict]:
    """Sorted spans of several passes, overlapping and touching ones as one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if out and span["start"] <= out[-1]["stop"]:
            out[-1] = {"start": out[-1]["start"], "stop": max(out[-1]["stop"], span["stop"]), "longest": max(out[-1]["longest"], span["longest"])}
        else:
            out.append(span)
    return out


def _by_shards(rows: DataFrame, built: DataFrame, shards: int) -> DataFrame:
    """Matches of rows ``_at, text`` with every shard, united per row; only rows with a match. One pass for each shard."""
    found = None
    for shard in range(shards):
        part = materialize(_pass(rows, _broadcast(built, shard), "_at", only_hits=True), "shard-hits")
        found = part if found is None else found.unionByName(part)
    # At most one row per shard and document, so a group is bounded by the number of shards.
    met = found.groupBy("_at").agg(F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_united(s) for s in batch.column("spans").to_pylist()]
            n_hit = [sum(s["stop"] - s["start"] for s in one) for one in spans]
            yield pa.RecordBatch.from_arrays([batch.column("_at"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(spans, FOUND_TYPES[2]), batch.column("item_ids")], names=["_at", "n_words", "n_hit", "spans", "item_ids"])

    return met.mapInArrow(unite, f"_at bigint, {FOUND}")


def _count_words(rows: DataFrame, key: str) -> DataFrame:
    """``key, n_words`` of rows ``key, text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = [len(words_of(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(counts, pa.int64())], names=[key, "n_words"])

    return rows.mapInArrow(count, f"{key} bigint, n_words bigint")


def _joined(rows: DataFrame, texts: DataFrame, built: DataFrame, shards: int) -> DataFrame:
    """``rows`` with what all shards found in ``texts(_at, text)``, by the row number ``_at``."""
    found = rows.join(_count_words(texts, "_at"), "_at").join(_by_shards(texts, built, shards).drop("n_words"), "_at", "left")
    none = {"n_hit": F.lit(0), "spans": F.array().cast(SPANS), "item_ids": F.array().cast("array<string>")}
    return found.withColumns({c: F.coalesce(c, empty) for c, empty in none.items()})


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", *, item_id: str = "item_id", item_text: str = "text", length: int = LENGTH, coverage: float = COVERAGE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (word positions and longest match), item_ids."""
    built, shards = automata(items, item_id, item_text, length, coverage, shard_bytes)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    if shards == 1:
        return _pass(rows, _broadcast(built, 0), "doc_id")
    numbered = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    return _joined(numbered.select("_at", "doc_id"), numbered.select("_at", "text"), built, shards).select("doc_id", "n_words", "n_hit", "spans", "item_ids")


def cut_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text without its spans of words; what lies between two words of a span goes with them."""
    bounds = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for span in spans:
        out.append(text[at : bounds[span["start"]][0]])
        at = bounds[span["stop"] - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", *, item_id: str = "item_id", item_text: str = "text", length: int = LENGTH, coverage: float = COVERAGE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents with their columns, the matching spans cut out of the text; n_words, n_hit and item_ids appended."""
    built, shards = automata(items, item_id, item_text, length, coverage, shard_bytes)
    columns = [c for c in docs.columns if c not in OWN]
    at = columns.index(text)
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([*rows.schema.fields]).add("n_words", T.LongType()).add("n_hit", T.LongType()).add("item_ids", T.ArrayType(T.StringType()))
    if shards == 1:
        shared = _broadcast(built, 0)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shared)
            for batch in slices(batches, text):
                raw = batch.column(at).cast(pa.binary())
                n_words, n_hit, spans, names = _found(automaton, [t or b"" for t in raw.to_pylist()])
                yield _cut(batch, columns, at, raw, spans, [n_words, n_hit, names])

        return rows.mapInArrow(clean, schema)
    # By place, as the caller's names may be any.
    numbered = materialize(rows.toDF(*[f"c{i}" for i in range(len(columns))]).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    joined = _joined(numbered, numbered.select("_at", F.coalesce(f"c{at}", F.lit("")).alias("text")), built, shards)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cut(batch, columns, at, batch.column(at).cast(pa.binary()), batch.column("spans"), [batch.column(c) for c in OWN])

    return joined.select(*[f"c{i}" for i in range(len(columns))], "spans", *OWN).mapInArrow(cut, schema)


def _cut(batch: pa.RecordBatch, columns: list[str], at: int, raw: pa.Array, spans: pa.Array, own: list[pa.Array]) -> pa.RecordBatch:
    """``columns``, with the spans cut out of the one at ``at``, and ``own``."""
    kept = [cut_spans(t, s) if s else t for t, s in zip(raw.to_pylist(), spans.to_pylist(), strict=True)]
    arrays = [pa.array(kept, pa.binary()).cast(pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
    return pa.RecordBatch.from_arrays([*arrays, *own], names=[*columns, *OWN])
