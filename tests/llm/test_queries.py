"""The registered queries over the smallest supplied tables: against their SQL, or against brute force."""

import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from shelfline.llm import registry
from shelfline.session import materialize

from ..conftest import DATA
from .test_operators import near_groups

FOLDER = f"{DATA}/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return sorted(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, FOLDER)
    want = duck.execute(SQL[name])
    names = sorted(got.columns)
    assert names == sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(n) for n in names]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, (tuple(r[i] for i in order) for r in want.fetchall())))


def test_all_are_registered():
    names = [n for n in entry_module.queries() if n == "pipeline" or n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_token_queries(spark, texts):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids for i, t in texts}
    at = 0
    for r in sorted(registry.queries()["op6_repair"](spark, FOLDER).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]) + 1, crc(ids[r.doc_id] + [2]))
        at += r.n_tokens
    rows = registry.queries()["op2_pack"](spark, FOLDER).collect()
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in ids.values())
    for r in rows:
        assert r.ids_crc32 == crc((ids[r.doc_id] + [1])[r.start : r.start + r.length])
    used = len({r.sequence_id for r in rows}) * 2048
    assert sum(r.length for r in rows) > 0.97 * used


def test_near_duplicate_query(spark, texts):
    sets, component = near_groups(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in registry.queries()["op8_minhash"](spark, FOLDER).collect()}
    assert got == {i: (len(s), c, i == c) for (i, _), s, c in zip(texts, sets, component, strict=True)}


def test_repeat_query(spark, texts):
    seen, want = set(), {}
    for i, t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        want[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = registry.queries()["op9_suffixes"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_language_query_on_held_out_documents(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in registry.queries()["op7_language"](spark, FOLDER).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.9 * len(rows)


def test_bands_keep_good_and_drop_repeats(spark, duck):
    quality = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = registry.queries()["op4_compression_bands"](spark, FOLDER).collect()
    assert not [r.doc_id for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed and not r.kept]
    assert all(not r.kept for r in rows if r.n_words and r.n_repeat_words == r.n_words)


def test_pages_query(spark, duck):
    import html
    import re

    want = {}
    for i, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        want[i] = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())
    got = registry.queries()["op1_html_text"](spark, FOLDER).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_pipeline_stages_against_brute_force(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = {i: t or "" for i, t in texts}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, FOLDER), "stage")
        rows = out.collect()
        if name == "language":
            assert len(rows) >= 0.95 * len(before)
        elif name == "exact copies":
            last = {}
            for i, t in sorted(before.items()):
                last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)] = i
            assert sorted(r.doc_id for r in rows) == sorted(last.values())
        elif name == "near copies":
            kept = sorted(before.items())
            assert sorted(r.doc_id for r in rows) == sorted({c for c in near_groups(kept)[1]})
        elif name == "mixture":
            share = sum(len(r.text.split()) for r in rows) / sum(len(t.split()) for t in before.values())
            assert share <= corpus_pipeline.SHARE + 1e-9
            assert len({r.doc_id for r in rows}) == len(rows)
        if name == "sequences":
            assert {r.doc_id for r in rows} == set(before)
        else:
            assert out.columns == columns
            assert {r.doc_id for r in rows} <= set(before)
            before = {r.doc_id: r.text or "" for r in rows}
        docs = out
