"""Pieces that run without Spark, against plain brute force."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfline.llm import bands, html_text, langid, minhash, packing, repair, shingles, suffixes
from shelfline.llm.tokens import Encoder

ENCODER = Encoder(public_tokenizers.path("word_bpe_49k.json"))
LETTERS = st.text(alphabet="abcXYZ éßİſﬁ'.!1 \n\t\x0b\x1c\x85 ́日", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(LETTERS, max_size=6))
def test_encoder_equals_the_library(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    want = [ENCODER.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_encoder_nulls_special_strings_and_a_full_store():
    small = Encoder(public_tokenizers.path("word_bpe_49k.json"), kept=2)
    for texts in (["a b c", None, "<|endoftext|> don't"], ["a b", "", "xyz c they're"], ["c a"]):
        ids, counts = small.encode(pa.array(texts))
        want = [small.whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert (ids.tolist(), counts.tolist()) == ([i for x in want for i in x], [len(x) for x in want])


def test_encoder_opens_the_whole_tokenizer_only_for_odd_chunks():
    fresh = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    ids, _ = fresh.encode(pa.array(["plain words"]))
    assert "whole" not in vars(fresh)
    assert ids.tolist() == ENCODER.whole.encode("plain words", add_special_tokens=False).ids
    assert fresh.encode(pa.array(["\u65e5"]))[0].tolist() == ENCODER.whole.encode("\u65e5", add_special_tokens=False).ids
    assert "whole" in vars(fresh)


def test_encoder_equals_an_untouched_library_on_special_strings():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "hello", "x", " ", "\n", "\t", "\u00a0", "<", "日", "don't"]
    rng = random.Random(4)
    texts = ["hello <|endoftext|> world <|startoftext|>x", *("".join(rng.choices(parts, k=8)) for _ in range(300))]
    ids, counts = ENCODER.encode(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [3306, 49407, 1002, 49406, 343]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=30), max_size=8))
def test_grammar_round_trip(documents):
    flat = np.array([x for d in documents for x in d], dtype=np.uint32)
    ends = np.cumsum([len(d) for d in documents])
    symbols, symbol_ends, rules = repair.compress(flat, ends, base=10, rounds=6, least=2)
    assert repair.expand(symbols, rules, 10).tolist() == flat.tolist()
    lengths = repair.expansion_lengths(rules, 10)
    row = {"rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(), "symbols": symbols.astype("<u4").tobytes(), "symbol_ends": symbol_ends.tolist(), "token_ends": ends.tolist()}
    for i, d in enumerate(documents):
        assert repair.document(row, i, 10).tolist() == d
    for i, x in enumerate(flat.tolist()):
        assert repair.token_at(row, i, 10) == x


def test_grammar_shrinks_repeats():
    flat = np.tile(np.array([3, 4, 5, 6], dtype=np.uint32), 200)
    symbols, _, rules = repair.compress(flat, np.array([800]))
    assert len(symbols) < 250
    assert len(rules)


def _often(symbols, ends):
    """The most places, none overlapping, that one pair has inside documents."""
    counts, first = {}, 0
    for end in ends.tolist():
        last = {}
        for i in range(first, end - 1):
            pair = (int(symbols[i]), int(symbols[i + 1]))
            if last.get(pair) != i - 1:
                counts[pair] = counts.get(pair, 0) + 1
                last[pair] = i
        first = end
    return max(counts.values(), default=0)


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 49_000, 300)
    # More distinct pairs than buckets, between copies of a passage, and runs of one token.
    documents = [x for _ in range(40) for x in (passage, rng.integers(0, 49_000, 9000), np.full(int(rng.integers(1, 90)), 7))]
    flat, ends = np.concatenate(documents).astype(np.uint32), np.cumsum([len(d) for d in documents])
    symbols, symbol_ends, rules = repair.compress(flat, ends)
    assert repair.expand(symbols, rules).tolist() == flat.tolist()
    assert _often(symbols, symbol_ends) < repair.LEAST
    assert repair.expansion_lengths(rules).max() == 300


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=40), max_size=6), st.integers(2, 4))
def test_grammar_leaves_no_frequent_pair_in_small_texts(documents, least):
    flat, ends = np.array([x for d in documents for x in d], dtype=np.uint32), np.cumsum([len(d) for d in documents])
    symbols, symbol_ends, rules = repair.compress(flat, ends, base=10, least=least)
    assert repair.expand(symbols, rules, 10).tolist() == flat.tolist()
    assert _often(symbols, symbol_ends) < least


@given(st.lists(st.integers(1, 50), max_size=80))
def test_first_fit_decreasing_against_a_scan(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, dtype=np.int64), 50)
    free: list[int] = []
    for size, got, offset in zip(sizes, bins.tolist(), offsets.tolist(), strict=True):
        at = next((i for i, room in enumerate(free) if room >= size), len(free))
        if at == len(free):
            free.append(50)
        assert (got, offset) == (at, 50 - free[at])
        free[at] -= size


def _words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abAB é\n\x0b\x1c ", max_size=30), max_size=6))
def test_shingle_sets(texts):
    sets = shingles.shingle_sets(pa.array(texts, pa.string()))
    plain = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := _words(t)) else set() for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for a, x in zip(sets, plain, strict=True):
        for b, y in zip(sets, plain, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_signatures_of_similar_sets_match_enough():
    rng = np.random.default_rng(5)
    for size in (3, 4, 8, 20, 60, 200, 1500):
        for _ in range(40):
            union = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
            common = -(-3 * size // 4)
            extra = rng.integers(0, 2, size - common).astype(bool)
            a, b = (np.unique(np.concatenate([union[:common], union[common:][side]])) for side in (extra, ~extra))
            if not minhash.linked(a, b):
                continue
            x, y = minhash.signature(a), minhash.signature(b)
            matches = len(np.intersect1d(x, y))
            for own, mine, other in ((a, x, b), (b, y, a)):
                n, m = np.array([len(own)]), np.array([len(mine)])
                assert matches >= minhash.needed_alone(n, m)[0]
                common = np.ceil(n * 0 + 3 * (len(a) + len(b)) / 7)
                assert matches >= minhash.needed(n, m, common, len(other) - common)[0] or matches >= minhash.needed_alone(n, m)[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda x: bytes(b % 3 for b in x)), max_size=8), min_size=1, max_size=9))
def test_loser_tree_merge(groups):
    runs = []
    for group in groups:
        ordered = sorted(group)
        runs.append(suffixes.Run(ordered, [suffixes.common_prefix(ordered[i - 1], s) if i else 0 for i, s in enumerate(ordered)]))
    run, index, shared = suffixes.merge(runs)
    got = [groups_sorted[i] for groups_sorted, i in ((runs[r].strings, i) for r, i in zip(run, index, strict=True))]
    assert got == sorted(x for g in groups for x in g)
    for i in range(1, len(got)):
        assert shared[i] == suffixes.common_prefix(got[i - 1], got[i])


def test_every_window_has_one_anchor_that_depends_on_it_alone():
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 100) for _ in range(700))
    raw = np.frombuffer(text + b"zz" + text[37:500], dtype=np.uint8)
    ends = np.array([len(text) + 2, len(raw)])
    key, place, least, most = suffixes.anchors(raw, ends)
    covered = sorted(p - o for p, low, high in zip(place, least, most, strict=True) for o in range(low, high + 1))
    assert covered == [*range(ends[0] - 99), *range(ends[0], ends[1] - 99)]
    owner = {p - o: (k, o) for k, p, low, high in zip(key.tolist(), place, least, most, strict=True) for o in range(low, high + 1)}
    assert all(owner[37 + i] == owner[ends[0] + i] for i in range(500 - 37 - 99))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab #\n\t", max_size=60))
def test_base_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t")]
    assert bands.base_counts(text) == (len(words), sum(len(w.decode()) for w in words), text.count("#"), len(lines) - len(set(lines)), len(repeated))


def test_bands_reject_repetition_and_noise_and_keep_prose():
    import zstandard

    rng = random.Random(1)
    packer = zstandard.ZstdCompressor(level=bands.LEVEL)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    prose = " ".join(rng.choice(words) for _ in range(6000))
    noise = "".join(chr(rng.randrange(33, 0x2FF)) for _ in range(9000))
    for text, kept in ((prose, True), (prose[:700], True), ("again and again " * 900, False), (prose[:9000] + "x " * 4000, False), (noise, False)):
        raw = text.encode()
        assert bands.in_bands(len(raw), *bands.ratios(raw, packer)) is kept
    assert bands.in_bands(10, *bands.ratios(b"short text", packer))


def test_html_blocks_and_main_text():
    page = """<html><head><title>T</title><style>x{}</style></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy this very good thing now please</div>
    <article><h1>One &amp; two</h1><p>Some <b>bold</b>ness&nbsp;here and
    more words to read<p>Short.</p><!-- <p>no</p> --><script>var a="</p>";</script><p>a&lt;b</p></article><div id="comments"><p>First comment of many readers!</p></div></body></html>"""
    assert html_text.main_text(page) == "One & two Some boldness here and more words to read Short. a<b"
    for odd in (None, "", "<", "<p", "<!-- never closed", "<script>x", "</p></div>", "<p class='", "<nav>only<b>menu</nav>"):
        assert html_text.main_text(odd) in ("", "<", "<p", "<p class='")


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar">{nav}{article}</body>', '<html class="no-touch nav-open"><body>{nav}{article}</body></html>',
    '{nav}<article class="post share-enabled">{text}</article>', '<div id="page-header-fixed">{nav}{article}<p class="ad">{other}</p></div>',
    '<form method="post">{nav}{article}</form>', '<form>{nav}<div>{text}</div></form>', '<main class="menu"><div class="widget">{text}</div></main>',
    '<div class="page comments-open">{nav}{article}</div>', '{article}<section id="comments"><article><p>{other}</p></article></section>',
    '{article}<div class="comments"><p>{other} {other} {other} {other} {other}</p></div>', '{article}<form><p>{other}</p></form>',
    '<div class="cookie"><p>{other} {other} {other} {other} {other}</p></div>{article}',
])
def test_html_wrappers_are_not_furniture(page):
    paragraph = "The miller kept his books in the old barn by the river, and nobody asked him why he did so."
    text, other = f"<p>{paragraph}</p><p>{paragraph}</p>", "Nobody had asked for any of these words, but here they are for all to read."
    nav = '<nav><a href="/">Home</a> <a href="/n">News</a></nav>'
    assert html_text.main_text(page.format(nav=nav, text=text, other=other, article=f"<article>{text}</article>")) == f"{paragraph} {paragraph}"


def test_html_tree_answers_its_own_table():
    tree = html_text.trained()
    for page in html_text.LABELLED:
        found = html_text.blocks(page)
        assert [html_text.decide(tree, r) for r in html_text.features(found)] == [b.marked for b in found]


STORY = "The miller kept his books in the old barn by the river, and nobody asked him why he did so. " * 2


@pytest.mark.parametrize(("page", "want"), [
    ('<header><svg class="logo"/></header><article><p>{s}</p></article>', "{s}"),
    ('<article><p>{s}</p><svg class="i" viewBox="0 0 1 1" /><p>Second.</p></article>', "{s} Second."),
    ('<article><p>{s}</p><svg><path d="M0"/><text>Chart label</text></svg><p>Second.</p></article>', "{s} Second."),
    ('<article><p>{s}</p><svg><text>Open drawing<p>Second.</p><p>Third.</p></article>', "{s} Second. Third."),
    ('<article><p>{s}</p><object data="x"><p>Shown instead.</p><p>Third.</p></article>', "{s} Shown instead. Third."),
    ('<article><p>{s}</p><noscript><p>No script.</p></noscript><template><p>Later.</p></template><p>Second.</p></article>', "{s} Second."),
    ('<div><p>{s}</p><p>"No," she said.</p><p>"Why?"</p><p>{s}</p></div>', '{s} "No," she said. "Why?" {s}'),
    ("<div><p>{s}</p><table><tr><td>Cell one</td><td>12</td></tr></table><p>{s}</p></div>", "{s} Cell one 12 {s}"),
    ("<article><p>12</p><h2>A</h2><ul><li><a href='/x'>y</a></li></ul><p>{s}</p><p>End</p></article>", "12 A y {s} End"),
    ('<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul><div>Menu</div><div><p>{s}</p><p>{s}</p></div><div>Menu</div><ul><li><a href="/c">Old</a></li></ul>', "{s} {s}"),
])
def test_html_blocks_by_their_neighbours(page, want):
    story = STORY.strip()
    assert html_text.main_text(page.replace("{s}", story)) == want.replace("{s}", story)


def test_html_tree_uses_neighbours():
    used = set()

    def walk(node):
        if node.left is not None:
            used.add(html_text.FEATURES[node.feature])
            walk(node.left)
            walk(node.right)

    walk(html_text.trained())
    assert used & {"words before", "words after", "link density before", "link density after"}


@pytest.mark.parametrize("text", ["<i>" * 20000 + "</b>" * 20000, "<i>" * 20000 + "<p>x</i>" * 20000, "<svg>" * 20000 + "<p>" * 20000, "<p>" * 20000, "<a href='" * 20000, "<!--" * 20000, "<div class=\"" + "x" * 100000])
def test_html_stays_linear_on_broken_pages(text):
    import time

    began = time.process_time()
    html_text.main_text(text)
    assert time.process_time() - began < 5


def test_language_sizes():
    first, second = "abra cadabra simsala bim " * 50, "otto pi muh kuh zaun baum haus " * 50
    sizes = langid.Sizes({"x": langid.letters(first), "y": langid.letters(second)})
    assert sizes("cadabra simsala").argmin() == 0
    assert sizes("baum haus zaun").argmin() == 1
    assert not langid.is_clear(None, sizes)
    assert not langid.is_clear("123 !!", sizes)
    assert langid.is_clear("cadabra simsala bim abra", sizes)
    assert not langid.is_clear("text", langid.Sizes({}))


def test_shingle_sets_are_sorted_without_hash_tables(monkeypatch):
    """np.unique builds a hash table for each text, which costs more than the rest of the set."""
    texts = ["", "One two", "a b c d e a b c d e a b c", " é x\ty  Z w v "]
    words = [bytes(ord(c) + 32 if "A" <= c <= "Z" else ord(c) for c in t).decode().split() if t.isascii() else t.replace("Z", "z").split() for t in texts]
    wanted = [len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0 for w in words]
    monkeypatch.delattr(shingles.np, "unique")
    sets = shingles.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == wanted
    assert all((s[1:] > s[:-1]).all() for s in sets)


def test_anchors_read_the_bytes_of_a_sliced_array_where_they_lie():
    rng = random.Random(8)
    cells = ["".join(rng.choices("ab\u00e9", k=n)) for n in (70, 0, 99, 30, 100, 1, 400, 130, 0)]
    raw, ends = suffixes.bytes_in(pa.array(["before", *cells, "after"]).slice(1, len(cells)))
    assert raw.tobytes() == "".join(cells).encode()
    assert ends.tolist() == np.cumsum([len(x.encode()) for x in cells]).tolist()
    _, place, least, most = suffixes.anchors(raw, ends)
    got = sorted(p - o for p, low, high in zip(place.tolist(), least.tolist(), most.tolist(), strict=True) for o in range(low, high + 1))
    starts = [0, *ends.tolist()]
    assert got == [i for a, b in zip(starts, starts[1:], strict=False) for i in range(a, b - suffixes.LENGTH + 1)]
    assert len(suffixes.bytes_in(pa.array([], pa.string()))[0]) == 0


@pytest.mark.parametrize("above", [0, 1 << 31])
def test_pairs_are_counted_exactly_however_wide_symbols_are(above):
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 9, 4000).astype(np.uint64) + np.uint64(above), rng.integers(0, 9, 4000).astype(np.uint64) + np.uint64(above)
    key = (left << np.uint64(32)) | right
    skipped = np.flatnonzero(rng.random(4000) < 0.2)
    hit, rank, found = repair._frequent_pairs(key, skipped, 40)
    counted = np.delete(key, skipped)
    values, counts = np.unique(counted, return_counts=True)
    assert sorted(found.tolist()) == values[counts >= 40].tolist()
    assert (found[rank] == key[hit]).all()
    assert hit.tolist() == [i for i in range(4000) if key[i] in found and i not in set(skipped.tolist())]
    sizes = np.bincount(rank)
    assert (np.diff(sizes) <= 0).all() and sizes.sum() == counts[counts >= 40].sum()


def test_a_pair_of_one_symbol_in_documents_of_two():
    # The last symbols stand among the pairs of the first round and must neither count nor push others out.
    flat, ends = np.full(64, 7, dtype=np.uint32), np.arange(2, 65, 2)
    symbols, symbol_ends, rules = repair.compress(flat, ends, base=10, least=32)
    assert (symbols.tolist(), symbol_ends.tolist(), rules.tolist()) == ([10] * 32, list(range(1, 33)), [[7, 7]])
