"""Decontamination against a brute force over all windows."""

import random
import re
from collections import Counter
from math import ceil

import pytest

from shelfline.llm import decontaminate
from shelfline.llm.automaton import Automaton, Builder, words_of
from shelfline.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, length=10, coverage=1.0):
    """(words, positions inside a window, items with a window in the text)."""
    have, hit, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        k = min(length, ceil(coverage * len(w)))
        wanted = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(have) - k + 1):
            if k and tuple(have[i : i + k]) in wanted:
                hit |= set(range(i, i + k))
                names.add(name)
    return len(have), hit, sorted(str(n) for n in names if n is not None)


def phrase(rng, n, kinds=12):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


RNG = random.Random(5)
LONG = " ".join(f"u{i}" for i in range(60))
ITEMS = [
    (1, LONG), (2, LONG), (3, "Short, Item!"), (4, "solo"), (5, None), (6, " ... "), (None, "nameless item of five words"), (7, "w1 w2 w3"),
    (7, "a second text of item seven"), (8, "ÉTÉ été À l'été"), *((20 + i, phrase(RNG, 14, 3)) for i in range(6)), *((30 + i, phrase(RNG, 25)) for i in range(6)),
]
TEXTS = [
    None, "", "...", LONG.upper(), "before " + " ".join(LONG.split()[20:30]) + " after", " ".join(LONG.split()[20:29]), "short\titem", "short. A item", "Solo",
    "x nameless item of five words y", "w0 w1 w2 w3 w4", "ÉTÉ été à l'été", "ÉTÉ été À l'été", LONG + " " + LONG[:40], *(phrase(RNG, 40, 3) for _ in range(15)),
    "second text of item seven", "\x00u0\x00u1 u2-u3_u4'u5/u6 U7:u8;u9\x7f", "a " * 300_000 + "the short item " + "b " * 1000,
]


@pytest.fixture(scope="module")
def tables(spark):
    prepare(spark)
    rows = [(i if i % 7 else None, t, "shared", True) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([*rows, rows[4]], "doc_id bigint, text string, n_hit string, _at boolean").repartition(3)
    return docs.cache(), spark.createDataFrame(ITEMS, "item_id bigint, text string").cache()


@pytest.mark.parametrize(("length", "coverage"), [(10, 1.0), (4, 1.0), (10, 0.5)])
@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 300])
def test_matches(tables, length, coverage, shard_bytes):
    docs, items = tables
    got = decontaminate.matches(docs, items, length=length, coverage=coverage, shard_bytes=shard_bytes).collect()
    want = Counter()
    for r in docs.collect():
        n, hit, names = brute(r.text, ITEMS, length, coverage)
        want[(r.doc_id, n, tuple(sorted(hit)), tuple(names))] += 1
    assert Counter((r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.stop)), tuple(sorted(r.item_ids))) for r in got) == want
    assert all(r.n_hit == sum(s.stop - s.start for s in r.spans) for r in got)
    assert all(a.stop < b.start for r in got for a, b in zip(r.spans, r.spans[1:], strict=False))


@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 300])
def test_spans_are_cut_out(tables, shard_bytes):
    docs, items = tables
    out = decontaminate.decontaminate(docs, items, shard_bytes=shard_bytes)
    assert out.columns == ["doc_id", "text", "_at", "n_words", "n_hit", "item_ids"] and all(r._at for r in out.collect())
    want = Counter()
    for r in docs.collect():
        have, hit = words(r.text), brute(r.text, ITEMS)[1]
        want[(r.doc_id, r.text is None, " ".join(w for i, w in enumerate(have) if i not in hit))] += 1
    assert Counter((r.doc_id, r.text is None, " ".join(words(r.text))) for r in out.collect()) == want
    untouched = {r.text for r in out.collect() if r.n_hit == 0}
    assert {"short. A item", ""} <= untouched and {"before  after"} <= {r.text for r in out.collect()}


def test_long_items_keep_their_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 13)
    docs = spark.createDataFrame([(i, " ".join(LONG.split()[i : i + 10])) for i in range(51)], "doc_id bigint, text string")
    items = spark.createDataFrame([("a", LONG)], "item_id string, text string")
    assert all(r.n_hit == 10 and r.item_ids == ["a"] for r in decontaminate.matches(docs, items).collect())


def test_empty_tables(spark, tables):
    docs, items = tables
    assert decontaminate.matches(docs.limit(0), items).count() == decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert all(r.n_hit == 0 and r.n_words == len(words(t)) for r in decontaminate.matches(docs, items.limit(0)).collect() for t in [r.doc_id and TEXTS[r.doc_id]] if r.doc_id)


def test_longest_match_of_the_automaton():
    rng = random.Random(3)
    texts = [phrase(rng, rng.randrange(1, 30), 4) for _ in range(12)]
    builder = Builder()
    for i, text in enumerate(texts):
        builder.add(words_of(text.encode()), 1, i)
    stream = phrase(rng, 400, 5)
    hits, have = Automaton(builder.pack()).match([stream.encode()]), stream.split()
    for end in range(len(have)):
        best = max(n for n in range(end + 2) if any(f" {' '.join(have[end + 1 - n : end + 1])} " in f" {t} " for t in texts) or not n)
        assert hits.longest[end] == best
