"""Token ids of whole texts by the ``tokenizers`` library, with each distinct word encoded once per worker.

The vocabulary file drops white space and lower-cases, so its ids for a text are the ids of its blank-separated chunks in
order. A batch's distinct chunks of plain Latin letters, digits and signs are lower-cased and split by the file's own pattern; their words
are looked up in a store, and new words go to the library's merges. Any other chunk goes through the whole tokenizer of the file. Both give what the library gives for the whole text (tested).
"""

from __future__ import annotations

import os
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

# The letters and digits among the characters for which the file's normaliser is plain lower-casing (no combining
# marks, no special-token bracket), the blanks between words, and the file's split pattern for these characters
# (with the line feed that ends a chunk).
LETTERS = r"a-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u017F"
DIGITS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
WORDS = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\n{LETTERS}{DIGITS}]+")
ODD = re.compile(r"[^\n!-;=-~\xA1-\xAC\xAE-\u012F\u0131-\u017F]")
#: Distinct words kept between batches; beyond, the store starts anew.
KEPT = 600_000


class _Known(dict):
    """Strings met before, numbered as they come, and the ids of each."""

    def __init__(self, kept: int):
        super().__init__()
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, dtype=np.int32), np.zeros(1 << 14, dtype=np.int32)

    def __missing__(self, key: str) -> int:
        place = self[key] = len(self)
        self.new.append(key)
        return place

    def places(self, keys: list[str]) -> np.ndarray:
        """Numbers of the keys; those met for the first time are in ``new`` and wait for ``learn``."""
        if len(self) > self.kept:
            self.forget()
        return np.fromiter(map(self.__getitem__, keys), dtype=np.int64, count=len(keys))

    def learn(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of all keys in ``new``, in their order."""
        at = len(self) - len(self.new)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[at : len(self)] = self.used + np.cumsum(lengths) - lengths
        self.length[at : len(self)] = lengths
        self.used += len(ids)
        self.new = []

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[places].astype(np.int64)
        return self.flat[ragged(self.start[places], lengths)], lengths


class Encoder:
    """Ids of texts under one vocabulary file."""

    def __init__(self, path: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.words.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.known = _Known(kept)

    @cached_property
    def whole(self):
        """The tokenizer as the file has it, opened when the first chunk needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as uint32, number of ids of each text); null counts as empty. Arrow's scratch goes back to the system, as workers live on."""
        out = self._encode(texts)
        pa.default_memory_pool().release_unused()
        return out

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        first = np.asarray(chunks.offsets)[:-1]
        coded = chunks.flatten().dictionary_encode()
        ids, lengths = self._encode_chunks(coded.dictionary)
        start, places = np.cumsum(lengths) - lengths, np.asarray(coded.indices)
        return ids[ragged(start[places], lengths[places])], np.add.reduceat(lengths[places], first - first[0])

    def _encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), pa.scalar("\n", pa.large_string()))[0].as_py()
        strange = np.array([m.start() for m in ODD.finditer(joined)], dtype=np.int64)
        if not len(strange):
            return self._encode_plain(joined)
        ends = np.cumsum(np.asarray(pc.utf8_length(chunks)).astype(np.int64) + 1)
        odd = np.unique(np.searchsorted(ends, strange, side="right"))
        bounds = np.stack([np.append(0, ends)[odd], ends[odd] - 1], axis=1).tolist()
        plain, at = [], 0
        for start, stop in bounds:
            plain.append(joined[at:start])
            at = stop
        ids, lengths = self._encode_plain("".join([*plain, joined[at:]]))
        found = [x.ids for x in self.whole.encode_batch_fast([joined[start:stop] for start, stop in bounds], add_special_tokens=False)]
        lengths[odd] = [len(x) for x in found]
        is_odd = np.zeros(len(chunks), dtype=bool)
        is_odd[odd] = True
        out, owner = np.zeros(int(lengths.sum()), dtype=np.uint32), np.repeat(is_odd, lengths)
        out[~owner], out[owner] = ids, np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(owner.sum()))
        return out, lengths

    def _encode_plain(self, chunks: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain chunks, given with a line feed between two."""
        words = WORDS.findall(chunks.lower())
        words.append("\n")
        places = self.known.places(words)
        if self.known.new:
            ids, lengths = self._encode_words([w for w in self.known.new if w != "\n"])
            if "\n" in self.known.new:  # the end of a chunk has no ids
                lengths = np.insert(lengths, self.known.new.index("\n"), 0)
            self.known.learn(ids, lengths)
        ids, lengths = self.known.ids(places)
        ends = np.flatnonzero(places == self.known["\n"])
        return ids, np.diff(np.cumsum(lengths)[ends], prepend=0)

    def _encode_words(self, words: list[str], at_once: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by the library, many in one call; the token that ends a word is marked in the vocabulary."""
        out = [self.words.encode_batch_fast([" ".join(words[i : i + at_once])], add_special_tokens=False)[0].ids for i in range(0, len(words), at_once)]
        ids = np.concatenate([np.zeros(0, dtype=np.uint32), *(np.array(x, dtype=np.uint32) for x in out)])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not mark the end of each word")
        return ids, np.diff(ends, prepend=0)


_open: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, made once."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]
