"""Word shingles of texts as 64-bit hashes, whole batches at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WORDS = 5
#: Bytes of the longest word that is hashed as a power sum.
LONG_WORD = 128
# Blanks between words, an odd multiplier for bytes, its inverse modulo 2 ** 64, multipliers for words.
BLANKS = np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8)
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
PLACES = np.array([(STEP * (2 * k + 3)) % (1 << 64) | 1 for k in range(WORDS)], dtype=np.uint64)

_fold = np.arange(256, dtype=np.uint8)
_fold[ord("A") : ord("Z") + 1] += 32
_blank = np.zeros(256, dtype=bool)
_blank[BLANKS] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> list[np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n``."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((STEP, BACK)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=np.uint64)
    return _powers


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of words of each text). A-Z count as a-z; texts hold no null."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    bounds = bounds - bounds[0]
    # One blank is set between neighbouring texts, so no word spans two.
    folded = np.insert(_fold[raw], bounds[1:], ord(" "))
    inside = ~_blank[folded]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, stop = edge[::2], edge[1::2]
    forward, back = _power_table(len(folded) + 1)
    sums = np.zeros(len(folded) + 1, dtype=np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * forward[: len(folded)], out=sums[1:])
    hashes = mixed((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64))
    # Power sums modulo 2 ** 64 are weak against long words of a regular build.
    for i in np.flatnonzero(stop - start > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(folded[start[i] : stop[i]].tobytes())
    text_ends = bounds[1:] + np.arange(1, len(texts) + 1)
    counts = np.diff(np.searchsorted(start, text_ends), prepend=0)
    return hashes, counts


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values of an array that is not empty; by sorting, as a hash table costs a short array several times more."""
    values = np.sort(values)
    first = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words than a shingle, one for the whole text."""
    words, counts = word_hashes(texts)
    n = max(0, len(words) - WORDS + 1)
    full = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        full += words[k : k + n] * PLACES[k]
    full = mixed(full)
    out, at = [], 0
    for count in counts.tolist():
        if count >= WORDS:
            out.append(distinct(full[at : at + count - WORDS + 1]))
        elif count:
            out.append(mixed((words[at : at + count] * PLACES[:count]).sum(keepdims=True) + np.uint64(count)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += count
    return out


def identity(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets have equal names."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
