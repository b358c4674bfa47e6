"""Benchmark decontamination with an FM-index over each shard of the training documents.

A shard is one Arrow batch of documents. Its words are numbered by the benchmark's own vocabulary; runs of such words that
are long enough to hold a window are indexed (an occurrence of a window is always inside such a run, so nothing is lost),
every distinct window of the benchmark is searched backwards in the index, and its occurrences are located by sampled
suffix positions. Overlapping occurrences merge into removal spans. No shuffle: a document's result is made where it is
read. The benchmark is a stated query set: its size is checked against a bound before it is sent to the workers.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. A window is 13 consecutive words of an item; an item
with fewer words is one window. Defined results: null or wordless texts have no words and no hits; wordless items and
items without an id have no windows; repeated rows are judged one by one; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm import textbytes as tb
from tallyframe.llm.fm_index import FMIndex

WINDOW = 13
ADDED = "n_words long, n_hit long, spans array<struct<first_word:int,end_word:int>>, items array<string>"


#: Characters of benchmark text whose phrases are made at once.
BLOCK_TEXT = 8 << 20


class Phrases(NamedTuple):
    """Distinct windows by width, over the sorted word hashes of the benchmark, and the items that hold each window."""

    vocabulary: np.ndarray
    widths: list[int]
    patterns: list[np.ndarray]  # of word numbers, from 1
    holders: list[list[list[str]]]  # items of each pattern


def phrases(ids: list, texts: list, window: int = WINDOW) -> Phrases:
    w = tb.words(pa.array(texts, pa.large_string()), tb.ALNUM)
    h = tb.hashes(w)
    vocabulary = np.unique(h)
    number = np.searchsorted(vocabulary, h) + 1
    found: dict[tuple, set[str]] = {}
    for k, item in enumerate(ids):
        mine = number[w.offsets[k] : w.offsets[k + 1]].tolist()
        width = min(window, len(mine))
        for i in range(len(mine) - width + 1 if width and item is not None else 0):
            found.setdefault(tuple(mine[i : i + width]), set()).add(str(item))
    widths = sorted({len(p) for p in found})
    by = {n: [p for p in found if len(p) == n] for n in widths}
    return Phrases(vocabulary, widths, [np.array(by[n], np.int64) for n in widths], [[sorted(found[p]) for p in by[n]] for n in widths])


class Hits(NamedTuple):
    n_words: np.ndarray
    spans: list[list[tuple[int, int]]]
    items: list[list[str]]


def search(column: pa.Array, wanted: Phrases) -> Hits:
    """One shard: index, search, locate, merge."""
    numbers, lengths = [], []
    for lo, hi in tb.blocks(column):
        w = tb.words(column.slice(lo, hi - lo), tb.ALNUM)
        h = tb.hashes(w)
        at = np.searchsorted(wanted.vocabulary, h)
        known = wanted.vocabulary[np.minimum(at, len(wanted.vocabulary) - 1)] == h if len(wanted.vocabulary) else np.zeros(len(h), bool)
        numbers.append(np.where(known, at + 1, 0).astype(np.int32))
        lengths.append(np.diff(w.offsets))
    number = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
    n_words = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
    ends = np.cumsum(n_words)
    n = len(n_words)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[list[str]] = [[] for _ in range(n)]
    if not wanted.widths or not len(number):
        return Hits(n_words, spans, items)
    # Runs of benchmark words inside one document.
    known = number > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    cuts = ends[:-1][ends[:-1] < len(number)]
    begins[cuts] = known[cuts]
    lasts = known.copy()
    lasts[:-1] &= ~known[1:]
    cuts = cuts[cuts > 0] - 1
    lasts[cuts] = known[cuts]
    first, size = np.flatnonzero(begins), np.flatnonzero(lasts) + 1 - np.flatnonzero(begins)
    long_enough = size >= wanted.widths[0]
    first, size = first[long_enough], size[long_enough]
    if not len(first):
        return Hits(n_words, spans, items)
    # Each run and its separator; ``place`` maps the sequence back to the shard's words.
    total = int(size.sum()) + len(size)
    offset = np.cumsum(size + 1) - (size + 1)
    place = np.arange(total) - np.repeat(offset - first, size + 1)
    sequence = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[offset + size] = False
    sequence[inside] = number[place[inside]]
    present = np.unique(sequence)  # from the separator 0 on
    index = FMIndex(np.searchsorted(present, sequence), len(present))
    change = np.zeros(len(number) + 1, np.int32)
    hit_docs, hit_patterns = [], []
    base = 0
    for width, patterns in zip(wanted.widths, wanted.patterns, strict=True):
        at = np.minimum(np.searchsorted(present, patterns), len(present) - 1)
        usable = np.flatnonzero((present[at] == patterns).all(1))
        lo, hi = index.search(at[usable])
        count = np.maximum(hi - lo, 0)
        if count.sum():
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - lo, count)
            words = place[index.locate(rows)]
            np.add.at(change, words, 1)
            np.add.at(change, words + width, -1)
            hit_docs.append(np.searchsorted(ends, words, "right"))
            hit_patterns.append(base + np.repeat(usable, count))
        base += len(patterns)
    if not hit_docs:
        return Hits(n_words, spans, items)
    hit = np.cumsum(change[:-1]) > 0
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        while a < b:  # a span ends with its document
            doc = int(np.searchsorted(ends, a, "right"))
            stop = min(b, int(ends[doc]))
            start = int(ends[doc] - n_words[doc])
            spans[doc].append((a - start, stop - start))
            a = stop
    holders = [x for group in wanted.holders for x in group]
    pairs = np.unique(np.stack([np.concatenate(hit_docs), np.concatenate(hit_patterns)], 1), axis=0)
    for doc, pattern in pairs.tolist():
        items[doc] += holders[pattern]
    return Hits(n_words, spans, [sorted(set(x)) for x in items])


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", window: int = WINDOW, block_items: int = 20_000, max_bytes: int = 256 << 20) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (merged, in words) and items (ids, sorted as strings).

    The benchmark may have ``max_bytes`` of text at most, since it is sent to all workers; a larger one is refused, and is searched in
    several calls. It is searched in blocks of ``block_items`` items or BLOCK_TEXT characters.
    """
    benchmark = benchmark.select("item_id", "text")
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"the benchmark has {size} bytes; find() takes at most {max_bytes}")
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id")
    context, sent, group, held = docs.sparkSession.sparkContext, [], [], 0
    for r in itertools.chain(rows.toLocalIterator(), [None]):  # a group's phrases are the most that the driver holds
        if group and (r is None or len(group) == block_items or held > BLOCK_TEXT):
            sent.append(context.broadcast(phrases([g[0] for g in group], [g[1] for g in group], window)))
            group, held = [], 0
        if r is not None:
            group.append(r)
            held += len(r[1])
    added = StructType.fromDDL(ADDED)
    docs = docs.drop(*added.names)
    schema = StructType([*docs.schema, *added])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = tb.as_strings(batch.column(text))
            found = [search(column, b.value) for b in sent] or [search(column, Phrases(np.zeros(0, np.uint64), [], [], []))]
            n_words = found[0].n_words
            spans = [_merge([s for f in found for s in f.spans[i]]) for i in range(len(column))] if len(found) > 1 else found[0].spans
            items = [sorted({x for f in found for x in f.items[i]}) for i in range(len(column))] if len(found) > 1 else found[0].items
            n_hit = [sum(b - a for a, b in s) for s in spans]
            spans = [[{"first_word": a, "end_word": b} for a, b in s] for s in spans]
            columns = [
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, batch.schema.names + added.names)

    return docs.mapInArrow(tb.released(shards), schema)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of each span and what stands between them."""
    w = tb.words(pa.array([text], pa.large_string()), tb.ALNUM)
    data, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(data[at : w.starts[a]])
        at = int(w.ends[b - 1])
    return b"".join([*out, data[at:]]).decode()
