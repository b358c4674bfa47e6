"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of length n belongs to class k = capacity // n, and a bin of class k holds exactly k pieces: no search, no shared
state, so every worker fills the bins of its own rows. Documents may be cut anywhere: whole sequences first, then the
largest length of the form capacity // k that fits, until the rest is at most a 16th of the capacity. Pieces cut that way
fill their bins to within k tokens, and only the small rests leave padding.

What a worker can't complete (fewer than k pieces in each class) is handed on: groups of workers merge their rests and
fill bins again, level by level, and the last level packs the few remaining pieces first-fit by decreasing length.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; an empty table gives no rows.
Only the key and the text are read; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm import textbytes as tb
from tallyframe.llm.tokens import Vocabulary
from tallyframe.llm.work import Workspace

#: Rests up to capacity // SMALLEST stay whole.
SMALLEST = 16
FAN_IN = 16
_vocabularies: dict[str, Vocabulary] = {}


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of documents of these lengths, in order: the document's number and the piece's length."""
    docs = [np.repeat(np.arange(len(lengths)), lengths // capacity)]
    sizes = [np.full(len(docs[0]), capacity)]
    who, rest = np.arange(len(lengths)), lengths % capacity
    while len(who := who[rest > 0]):
        rest = rest[rest > 0]
        exact = capacity // -(-capacity // rest)
        size = np.where(rest > capacity // SMALLEST, exact, rest)
        docs.append(who)
        sizes.append(size)
        rest = rest - size
    doc, size = np.concatenate(docs), np.concatenate(sizes)
    order = np.argsort(doc, kind="stable")
    return doc[order], size[order]


def fill(pieces: pa.Table, capacity: int, next_bin: int) -> tuple[pa.Table, pa.Table, int]:
    """Complete bins of each class, numbered from ``next_bin``; the pieces left over; the next number."""
    length = pieces.column("length").to_numpy()
    kind = capacity // np.maximum(length, 1)
    order = np.argsort(kind, kind="stable")
    kind, length = kind[order], length[order]
    begin = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(kind)))
    ordinal = np.arange(len(kind)) - np.repeat(begin, count)
    whole = count // kind[begin]
    done = ordinal < np.repeat(whole * kind[begin], count)
    number = np.repeat(np.cumsum(whole) - whole, count) + ordinal // np.maximum(kind, 1)
    packed = pieces.take(pa.array(order[done]))
    return place(packed, next_bin + number[done]), pieces.take(pa.array(np.sort(order[~done]))), next_bin + int(whole.sum())


def place(pieces: pa.Table, number: np.ndarray) -> pa.Table:
    """``pieces``, in order of their bins, with sequence_id and offset."""
    length = pieces.column("length").to_numpy()
    before = np.cumsum(length) - length
    fresh = np.concatenate([[True], number[1:] != number[:-1]]) if len(number) else np.zeros(0, bool)
    offset = before - np.repeat(before[fresh], np.diff(np.append(np.flatnonzero(fresh), len(number))))
    pieces = pieces.drop_columns(["sequence_id", "offset"])
    return pieces.append_column("sequence_id", pa.array(number, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))


def first_fit(pieces: pa.Table, capacity: int, next_bin: int) -> pa.Table:
    length = pieces.column("length").to_numpy()
    order = np.argsort(-length, kind="stable")
    room: list[int] = []
    number = np.zeros(len(order), np.int64)
    for i, n in enumerate(length[order].tolist()):
        b = next((b for b, free in enumerate(room) if free >= n), len(room))
        if b == len(room):
            room.append(capacity)
        room[b] -= n
        number[i] = b
    again = np.argsort(number, kind="stable")
    return place(pieces.take(pa.array(order[again])), next_bin + number[again])


def _pieces(keys: pa.Array, column: pa.Array, vocabulary: Vocabulary, capacity: int, end: int) -> Iterator[pa.Table]:
    for lo, hi in tb.blocks(column):
        ids, offsets = vocabulary.encode(column.slice(lo, hi - lo), end)
        total = np.diff(offsets)
        doc, size = cut(total, capacity)
        stop = np.cumsum(size)
        start = stop - size - offsets[doc]
        bounds = pa.py_buffer((np.concatenate([[0], stop]) * 4).astype(np.int64))
        binary = pa.Array.from_buffers(pa.large_binary(), len(size), [None, bounds, pa.py_buffer(ids.astype("<u4").tobytes())])
        n = len(size)
        yield pa.table(
            {
                "doc_id": keys.take(pa.array(doc + lo)),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(size, pa.int64()),
                "ids": binary.cast(pa.binary()),
                "doc_tokens": pa.array(total[doc], pa.int64()),
                "sequence_id": pa.nulls(n, pa.int64()),
                "offset": pa.nulls(n, pa.int64()),
            }
        )


def pack(docs: DataFrame, work: Workspace, tokenizer: str, *, capacity: int = 2048, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Sequence ids are unique, not gapless: the high bits name the worker or group that filled the bin.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, worker long")])

    def workers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabularies.get(tokenizer) or _vocabularies.setdefault(tokenizer, Vocabulary(tokenizer))
        worker = TaskContext.get().partitionId()
        bins, rest = worker << 32, None
        for batch in batches:
            for pieces in _pieces(batch.column("doc_id"), tb.as_strings(batch.column("text")), vocabulary, capacity, end):
                packed, rest, bins = fill(pa.concat_tables([rest, pieces]) if rest is not None else pieces, capacity, bins)
                yield from _with(packed, worker)
        if rest is not None:
            yield from _with(rest, worker)

    done = []
    level = work.save(docs.mapInArrow(tb.released(workers), schema), "pieces0")
    base, depth = 1 << 62, 0
    while True:
        done.append(level.where("sequence_id IS NOT NULL"))
        left = level.where("sequence_id IS NULL").withColumn("worker", F.floor(F.col("worker") / FAN_IN).cast("long"))
        last = left.agg(F.max("worker")).first()[0]
        if last is None:
            break
        depth += 1
        level = work.save(left.groupBy("worker").applyInArrow(_merge(capacity, base + (depth << 56), final=last == 0), schema), f"pieces{depth}")
        if last == 0:
            done.append(level)
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.drop("worker")


def _with(pieces: pa.Table, worker: int) -> list[pa.RecordBatch]:
    return pieces.append_column("worker", pa.array(np.full(len(pieces), worker), pa.int64())).to_batches()


def _merge(capacity: int, base: int, final: bool):
    def run(group: pa.Table) -> pa.Table:
        worker = group.column("worker")[0].as_py()
        group = group.sort_by([("length", "ascending"), ("doc_id", "ascending"), ("start", "ascending")]).drop_columns(["worker"])
        packed, rest, bins = fill(group, capacity, base + (worker << 32))
        parts = [packed, first_fit(rest, capacity, bins) if final else rest]
        out = pa.concat_tables(parts)
        return out.append_column("worker", pa.array(np.full(len(out), worker), pa.int64()))

    return run
