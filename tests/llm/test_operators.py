"""Operators on small tables with odd rows, against brute force."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import bands, exact, html_text, langid, minhash, mixing, packing, repair, suffixes, toolcalls
from shelfline.llm.common import prepare

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
WORDS = [a + b for a in "ba ke li mo nu po ra si tu we".split() for b in "den fil gor has jin kal mer nop".split()]


def prose(seed, n):
    return " ".join(WORDS[(seed * 7919 + i * (seed + 31) + i * i) % len(WORDS)] for i in range(n))


LONG = prose(1, 400)
#: Nulls, empty and blank texts, copies, case, near copies, a repeated row, a repeated id, a long text.
ROWS = [
    (1, LONG), (2, LONG.upper()), (3, LONG + " end"), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "ONE"), (9, prose(2, 60)),
    (9, prose(2, 60)), (10, prose(3, 40)), (10, prose(4, 40)), (None, prose(5, 30)), (None, "one"), (11, "x " * 3000 + LONG),
    (12, "é" + prose(6, 50)), (13, prose(7, 20) + " " + LONG[:300] + " " + prose(8, 20)), (14, "a b c d e"), (15, "a b c d e f"),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "zz", "s1", 0, True, "q") for i, t in ROWS]
    # Extra columns with names that the operators use themselves.
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, node string").repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(docs):
    got = exact.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[fold(t)].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(dict.fromkeys({r.text_sha256 for r in got}, 1))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_kept_rows(docs, empty):
    rows = exact.deduplicated(docs).collect()
    assert sorted(fold(r.text) for r in rows) == sorted({fold(t) for _, t in ROWS})
    assert rows[0].asDict().keys() == docs.first().asDict().keys()
    assert exact.exact_dedup(empty).count() == exact.deduplicated(empty).count() == 0


def tokens(text, end):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_packing(docs, empty):
    rows = packing.pack_documents(docs, PATH, group_bytes=20_000).select("*", F.crc32("ids").alias("crc")).collect()
    pieces, places = Counter(), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.start, r.length, r.crc, r.doc_tokens)] += 1
        places[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for i, t in ROWS:
        ids = tokens(t, 1)
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            want[(i, start, len(part), crc(part), len(ids))] += 1
    assert pieces == want
    for sequence in places.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty, PATH).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    repair.write(docs, str(tmp_path / "ids"), PATH, shard_tokens=500)
    got = repair.read(spark, str(tmp_path / "ids")).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    got.sort(key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.crc) for r in got) == Counter((i, len(tokens(t, 2)), crc(tokens(t, 2))) for i, t in ROWS)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    repair.write(empty, str(tmp_path / "none"), PATH)
    assert not os.path.exists(tmp_path / "none" / "x")
    assert repair.read(spark, str(tmp_path / "none")).count() == 0


def test_bands(docs, empty):
    got = bands.quality_bands(docs).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len((t or "").encode().split())) for i, t in ROWS)
    assert {r.doc_id for r in got if r.kept} >= {9, 12}
    # Documents 1 to 3 repeat one cycle of words; 4 to 7 are too short; 11 is mostly one word.
    assert all(r.base_failed for r in got if r.doc_id in (1, 2, 3, 4, 5, 6, 7, 11))
    assert bands.quality_bands(empty).count() == 0


def test_language(spark, docs, empty):
    dictionaries = langid.train(docs)
    assert list(dictionaries) == ["zz"]
    got = langid.identify(docs, dictionaries).collect()
    assert Counter(r.lang_pred for r in got) == {"und": 3, "zz": len(ROWS) - 3}
    assert langid.accepted(docs, dictionaries).count() == len(ROWS) - 3
    assert langid.accepted(docs, dictionaries).columns == docs.columns
    assert langid.train(empty) == {}
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(empty, dictionaries).count() == 0


def near_groups(rows):
    sets = []
    for _, t in rows:
        words = fold(t).encode().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc) if x is not None]
        least[root(i)] = min(known) if known else None
    return sets, [least[root(i)] for i in range(len(rows))]


def test_near_duplicates(docs, empty):
    got = minhash.near_duplicates(docs).collect()
    sets, component = near_groups(ROWS)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((ROWS[i][0], len(sets[i]), component[i]) for i in range(len(ROWS)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicate_chain_and_family(spark):
    """Chains whose ends are far apart, and a family around a base with members on both sides of the threshold."""
    words = prose(40, 120).split()
    rows = [(i, " ".join(words[:i * 4] + [f"new{k}" for k in range(i * 4)] + words[i * 4:120 - i * 4])) for i in range(8)]
    base = prose(41, 90).split()
    for i in range(60):
        copy = list(base)
        for k in range(i % 12):
            copy[(i * 13 + k * 7) % 90] = f"edit{i}x{k}"
        rows.append((100 + i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    _, component = near_groups(rows)
    assert got == {i: c for (i, _), c in zip(rows, component, strict=True)}
    assert minhash.representatives(df).count() == len(set(component))


def cut_repeats(rows):
    """Bytes covered by a string that also starts earlier, by looking at every start."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((rows[i][0], len(raw), sum(gone), spans, kept))
    return out


def test_repeat_removal(spark, empty):
    rows = [r for r in ROWS if r[0] not in (10, None)] + [(None, prose(5, 30)), (20, LONG[50:400] * 3), (21, "é" * 120), (22, "ab" * 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df).collect()]
    assert Counter(got) == Counter(cut_repeats(rows))
    assert suffixes.remove_repeats(empty).count() == 0


def test_repeat_removal_with_a_shared_id(spark):
    rows = [(10, prose(3, 40)), (10, prose(3, 40)[20:] + prose(4, 40)), (11, prose(3, 40)), (11, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffixes.remove_repeats(df).collect()
    assert len(got) == 4
    assert sum(len(r.kept) for r in got) == min(sum(len(k) for *_, k in cut_repeats(order)) for order in (rows, [rows[1], rows[0], *rows[2:]]))


def test_mixing_budgets(spark, docs, empty):
    weights = spark.createDataFrame([("a", None, None, 3), ("b", None, None, 1)], "domain string, language string, origin string, weight bigint")
    texts = [(i, "w " * 10, "en", f"{d}{s}", None) for i, (d, s) in enumerate((d, s) for d in "ab" for s in range(2) for _ in range(20 if d == "a" else 60))]
    table = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, budget string")
    got = mixing.mix(table, weights, F.substring("source", 1, 1), epochs=2, share=0.5).collect()
    by = Counter()
    for r in got:
        by[r.domain, r.origin] += r.n_tokens
    # 1600 tokens, 800 to give: a's share of 600 fits its 800 of two passes, b gets 200.
    assert by == {("a", "a0"): 300, ("a", "a1"): 300, ("b", "b0"): 100, ("b", "b1"): 100}
    assert max(Counter((r.doc_id, r.epoch) for r in got).values()) == 1
    short = Counter()
    for r in mixing.mix(table, weights, F.substring("source", 1, 1), epochs=1, share=0.5).collect():
        short[r.domain] += r.n_tokens
    # In one pass a can give 400 only; what is short goes to its sibling.
    assert short == {"a": 400, "b": 400}
    assert mixing.mix(empty, weights, F.col("source")).count() == 0
    assert mixing.mixed_documents(docs, weights, F.col("source"), share=1.0).columns == docs.columns
    assert mixing.mixed_documents(docs, weights, F.col("source"), share=1.0).count() == sum(bool((t or "").split()) for _, t in ROWS)


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", None, "add", '{"y": 2, "x": 1}'), (1, "b", "a", "add", '{"x": 1.5, "y": 2}'), (1, "c", "b", "add", '{"x": 1}'), (1, "d", "c", "add", "{oops"),
            (1, "e", "d", "fly", "{}"), (1, "f", "zz", "add", '{"x":1,"y":2}'), (1, "g", "h", "add", '{"x":1,"y":2}'), (1, "h", "g", "add", '{"x":1,"y":2}'),
            (2, "a", None, "add", '{"x":1,"y":2,"z":3}'), (2, "a", None, "add", '{"x":1,"y":2,"z":3}'), (2, "b", None, "add", '{"y":2,"x":1}'), (2, None, None, "add", "{}"), (None, "a", None, "add", "{}"),
        ],
        "conv_id bigint, call_id string, after string, name string, arguments string",
    )
    results = spark.createDataFrame([(1, "a", "3"), (1, "b", None), (1, "c", "4"), (1, "g", ""), (3, "q", "stray")], "conv_id bigint, call_id string, content string")
    schemas = spark.createDataFrame([("add", "x", "integer", True), ("add", "y", "integer", True)], "name string, parameter string, type string, required boolean")
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link(calls, results, schemas).collect()}
    assert {k: (r.level, r.status) for k, r in got.items()} == {
        (1, "a"): (0, "ok"), (1, "b"): (1, "wrong argument type"), (1, "c"): (2, "missing argument"), (1, "d"): (3, "unreadable arguments"), (1, "e"): (4, "unknown tool"),
        (1, "f"): (0, "unknown call referred to"), (1, "g"): (None, "cycle"), (1, "h"): (None, "cycle"), (2, "a"): (0, "surplus argument"), (2, "b"): (0, "no result"), (3, "q"): (None, "result without a call"),
        (2, None): (None, "call without an identifier"), (None, "a"): (None, "call without an identifier"),
    }
    assert got[2, "a"].copies == 2
    assert got[1, "a"].record == '{"arguments":{"x":1,"y":2},"call_id":"a","name":"add","result":"3"}'
    assert toolcalls.link(calls.limit(0), results.limit(0), schemas).count() == 0


def test_tool_calls_lose_nothing_under_one_identifier(spark):
    kinds = "conv_id bigint, call_id string, after string, name string, arguments string"
    calls = [(1, "a", None, "add", '{"x":1}'), (1, "a", None, "add", '{"x":2}'), (1, "a", None, "add", '{"x":2}'), (1, "a", None, "add", None), (1, "b", "a", "add", '{"x":3}'),
             (None, None, None, None, None), (None, None, None, None, None), (1, "c", None, "add", '{"x":4}')]
    results = [(1, "b", "r"), (1, "b", "s"), (1, None, "lost"), (1, "c", "t"), (1, "c", "t")]
    schemas = spark.createDataFrame([("add", "x", "number", True)], "name string, parameter string, type string, required boolean")
    got = toolcalls.link(spark.createDataFrame(calls, kinds), spark.createDataFrame(results, "conv_id bigint, call_id string, content string"), schemas)
    record = '{"arguments":%s,"call_id":%s,"name":%s,"result":%s}'
    add = '"add"'
    want = Counter([
        (1, "a", 0, "conflicting calls", 1, record % ("null", '"a"', add, "null")), (1, "a", None, "conflicting calls", 1, record % ('{"x":1}', '"a"', add, "null")),
        (1, "a", None, "conflicting calls", 2, record % ('{"x":2}', '"a"', add, "null")), (1, "b", 1, "conflicting results", 1, record % ('{"x":3}', '"b"', add, '"r"')),
        (1, "b", None, "conflicting results", 1, record % ("null", '"b"', "null", '"s"')), (1, "c", 0, "ok", 1, record % ('{"x":4}', '"c"', add, '"t"')),
        (None, None, None, "call without an identifier", 2, record % ("null", "null", "null", "null")),
        (1, None, None, "result without an identifier", 1, record % ("null", "null", "null", '"lost"')),
    ])
    assert Counter((r.conv_id, r.call_id, r.level, r.status, r.copies, r.record) for r in got.collect()) == want


def test_canonical_numbers(spark):
    cases = {
        '{"x":100}': '{"x":100}', '{"x":1e2}': '{"x":100}', '{"x":1.0}': '{"x":1}', '{"x":-0.50}': '{"x":-0.5}', '{"x":-0.0}': '{"x":0}', '{"x":15E-1}': '{"x":1.5}',
        '{"b":[1.10,"1.10",{"c":2.0}],"a":"x 1.0 \\" 2e3"}': '{"a":"x 1.0 \\" 2e3","b":[1.1,"1.10",{"c":2}]}', '{"x":1e30}': '{"x":1E30}', '{"x":1.0E30}': '{"x":1E30}',
        '{"x":12345678901234567890}': '{"x":12345678901234567890}', '{"x":0.1234567890123456789}': '{"x":0.1234567890123456789}', "{}": "{}", '{"x":1e-7}': '{"x":0.0000001}',
    }
    rows = spark.createDataFrame([(k,) for k in cases], "j string")
    got = {r.j: r.c for r in rows.select("j", toolcalls.canonical(F.to_json(F.try_parse_json("j"))).alias("c")).collect()}
    assert got == cases


def test_long_chain_of_calls(spark):
    chain = spark.range(300).selectExpr("1L AS conv_id", "cast(id AS string) AS call_id", "if(id = 0, null, cast(id - 1 AS string)) AS after")
    assert {int(r.call_id): r.level for r in toolcalls.levels(chain).collect()} == {i: i for i in range(300)}


def test_html_table(spark):
    rows = [(1, "u", "<article><p>Hello to all of you</p></article>", "x"), (None, None, None, "y"), (2, "u", "", "z"), (1, "u", "<article><p>Hello to all of you</p></article>", "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == [(0, "", "", 0), (1, "u", "Hello to all of you", 19), (1, "u", "Hello to all of you", 19), (2, "u", "", 0)]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
