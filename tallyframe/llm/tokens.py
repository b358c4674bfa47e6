"""Token ids of many texts with the word-end BPE tokenizer, one look-up for each distinct word.

The tokenizer drops white space, lower-cases, splits into runs of letters, single digits and runs of other characters (and
English contractions), and merges inside each of these units alone. So a text's ids are its units' ids in order, and a unit
needs to be encoded once. Units of ASCII and Latin-1 letters are cut with numpy and encoded by the tokenizer's model; a
stretch between white space with an apostrophe or any other character goes through the whole tokenizer unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from tokenizers import Tokenizer

from tallyframe.llm import textbytes as tb

_SPACE, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)


def _byte_classes() -> np.ndarray:
    c = np.full(256, _OTHER, np.uint8)
    c[~tb.NOT_SPACE] = _SPACE
    c[0x61:0x7B] = _LETTER
    c[0x30:0x3A] = _DIGIT
    return c


_CLASS = _byte_classes()


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code point from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(spare)) for b in range(256)}


class Vocabulary:
    """Ids by unit, remembered from batch to batch up to ``limit`` units; beyond it the memory starts afresh."""

    def __init__(self, path: str, limit: int = 1_500_000):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)  # of known[i] in ids
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _units(self, column: pa.Array) -> tuple[tb.Words, np.ndarray]:
        """Units in order, and which go through the whole tokenizer."""
        data, offsets = tb.raw(column)
        chunks = tb.words(column, lower=False)
        lead = data == 0xC3
        pair = np.zeros(len(data), bool)
        pair[1:] = lead[:-1] & (data[1:] >= 0x80)
        pair[offsets[:-1][offsets[:-1] < len(data)]] = False
        hard = ((data >= 0x80) & ~lead & ~pair) | (data == 0x27)
        out = tb.LOWER[data]
        out[pair & (data <= 0x9E) & (data != 0x97)] += 0x20
        kind = _CLASS[out]
        second = np.flatnonzero(pair)
        letter = np.where((out[second] != 0x97) & (out[second] != 0xB7), _LETTER, _OTHER).astype(np.uint8)
        kind[second] = letter
        kind[second - 1] = letter
        if hard.any():
            some = np.add.reduceat(hard.astype(np.int32), chunks.starts) > 0 if len(chunks.starts) else np.zeros(0, bool)
            a, n = chunks.starts[some], (chunks.ends - chunks.starts)[some]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - a, n)
            kind[inside] = _WHOLE
            out[inside] = data[inside]
        first = kind != _SPACE
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = kind[begins] != _SPACE
        starts = np.flatnonzero(first)
        # A unit ends where the next begins or where white space does.
        gap = np.flatnonzero(kind == _SPACE)
        after = np.append(starts[1:], len(data))
        ends = np.minimum(after, np.append(gap, len(data))[np.searchsorted(gap, starts)])
        return tb.Words(out, starts, ends, np.searchsorted(starts, offsets)), kind[starts] == _WHOLE

    def _learn(self, hashes: np.ndarray, units: list[bytes], whole: np.ndarray) -> None:
        ids: list = [None] * len(units)
        for i in np.flatnonzero(~whole).tolist():
            ids[i] = [t.id for t in self.model.tokenize(units[i].decode("latin-1").translate(self.letters))]
        rest = np.flatnonzero(whole).tolist()
        for i, e in zip(rest, self.whole.encode_batch_fast([units[i].decode() for i in rest], add_special_tokens=False), strict=True):
            ids[i] = e.ids
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for one in ids for x in one), np.uint32, int(length.sum()))
        at = len(self.ids) + np.cumsum(length) - length
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known, self.at, self.length = known[order], np.concatenate([self.at, at])[order], np.concatenate([self.length, length])[order]
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each followed by ``end``, and the n + 1 offsets."""
        units, whole = self._units(column)
        codes, distinct = pd.factorize(tb.hashes(units))
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if len(self.known) + len(distinct) > self.limit:
            self._clear()
        found = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = found < len(self.known)
        new[inside] = self.known[found[inside]] != distinct[inside]
        if new.any():
            data = units.data.tobytes()
            some = first[new]
            self._learn(distinct[new], [data[a:b] for a, b in zip(units.starts[some].tolist(), units.ends[some].tolist(), strict=True)], whole[some])
            found = np.searchsorted(self.known, distinct)
        length, at = self.length[found][codes], self.at[found][codes]
        documents = len(units.offsets) - 1
        total = np.concatenate([[0], np.cumsum(length)])
        offsets = total[units.offsets] + np.arange(documents + 1)
        out = np.full(int(offsets[-1]), end, np.uint32)
        place = total[:-1] + np.repeat(np.arange(documents), np.diff(units.offsets))  # one end id for each document before
        step = np.arange(int(total[-1])) - np.repeat(total[:-1], length)
        out[np.repeat(place, length) + step] = self.ids[np.repeat(at, length) + step]
        return out, offsets
