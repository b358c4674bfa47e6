"""Vectorised word splitting and hashing over Arrow string arrays.

The operators that need every word of a corpus (shingling, n-grams, phrase search, tokenising) work on the UTF-8 bytes of
a block of documents at once with numpy, so no Python object is made per word. All delimiters are ASCII, hence a byte
test is exact for UTF-8 text: the bytes of longer code points are all 0x80 or more.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
#: Words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text whose A-Z are lower-cased.
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: Lower-cases A-Z only.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_R = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    """Words of a block of documents: spans into ``data`` and, for each document, its range of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # document i has words offsets[i] to offsets[i + 1]


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
    return column.cast(pa.large_string())


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets, from 0; a null is an empty text."""
    column = as_strings(column)
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``block_bytes`` bytes; a longer text is a block of its own."""
    _, offsets = raw(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(column: pa.Array, is_word: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    data, offsets = raw(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), np.int64))
    inside = is_word[data]
    cut = np.zeros(n + 1, bool)  # a document begins here
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


#: Of eight bytes read as a little-endian integer, the first k.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every block and on every worker.

    Eight bytes at a time: all words take part in the first step, and those that are longer in the next ones.
    """
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(w.data) + 1, np.dtype("<u8"), padded, strides=(1,))  # from each byte on
    lengths = w.ends - w.starts
    out = mix((eight[w.starts] & _FIRST[np.minimum(lengths, 8)]) ^ (lengths.astype(np.uint64) * _R))
    done, more = 8, np.flatnonzero(lengths > 8)
    while len(more):
        out[more] = mix(out[more] * _R + (eight[w.starts[more] + done] & _FIRST[np.minimum(lengths[more] - done, 8)]))
        done += 8
        more = more[lengths[more] > done]
    return out


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive hashes; len(h) - width + 1 of them."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _R + h[k : k + n]
    return mix(out)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives the memory that it has freed back; idle workers would keep it beside the next steps."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole
