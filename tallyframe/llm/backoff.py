"""Stupid-backoff scores of documents under n-gram counts of the same table, computed relationally.

score(w | context) is count(context w) / count(context) where the n-gram occurs ``least`` times or more, else 0.4 times the
score under the context without its first word; a single word has count(w) / words. A document's score is the sum of the
logarithms over its words.

With ``least`` 1 every n-gram of a document is in the tables, since the document was counted: nothing backs off and the
logarithms of counts and contexts cancel but for log count(n-gram) - log count(context). So each order asks only for
n-grams whose logarithms remain, and an order below those that only texts of its very length ask is left out where there is
no such text. Chunks of texts send their n-grams (64-bit hashes), how often each occurs and which texts ask for it, as runs
of numbers (``dealt``), to the place of their hash. There counts are added up and joined to what was asked, and a second deal
brings them back to the place of the chunk, where a text's logarithms are summed. Frequent n-grams send their hash once a
chunk. It is done in ``passes`` over parts of the hashes, and what each finds is written, so that only a pass's n-grams are
on disk at a time.

With a higher ``least`` the texts are exploded, order by order, into rows, which are added up by blocks before they are
shuffled by hash into the count table of that order. The tables hold what an n-gram that occurs often enough adds to the
score of backing off, which is found by joining the (fewer) frequent n-grams to the table of the order below, by prefix and by
suffix. The table is joined by hash to the n-grams of the documents, and what they find is summed per document, partially
before the shuffle.

Defined results: null, empty and wordless texts have 0 words, log_score 0 and a null mean; repeated rows are counted and
scored each; null keys are keys; an empty table gives no rows. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Extra
columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm import dealt
from tallyframe.llm import textbytes as tb
from tallyframe.llm.work import Workspace

BACKOFF = 0.4


class Block(NamedTuple):
    """The words of some texts: hashes, sizes of the texts, and each word's text, place in it and words from there on."""

    words: np.ndarray
    sizes: np.ndarray
    text: np.ndarray
    place: np.ndarray
    left: np.ndarray


def _blocks(column: pa.Array) -> Iterator[tuple[int, int, Block]]:
    for lo, hi in tb.blocks(column):
        w = tb.words(column.slice(lo, hi - lo))
        sizes = np.diff(w.offsets)
        text = np.repeat(np.arange(hi - lo), sizes)
        place = np.arange(len(text)) - w.offsets[:-1][text]
        yield lo, hi, Block(tb.hashes(w), sizes, text, place, sizes[text] - place)


def _part(grams: np.ndarray, passes: int) -> np.ndarray:
    return (grams >> np.uint64(32)) % np.uint64(passes)


def _grams(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie in a text, and the places in the block where they begin."""
    at = np.flatnonzero(block.left >= n)
    return tb.windows(block.words, n)[at], at


#: n-grams that a worker holds before it adds up equal ones and sends them.
HELD = 1 << 21


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], ["gram", "n", "prefix", "suffix"][: len(columns)])


def _counted(n: int, related: bool):
    """n-grams and how often they occur in some blocks; with the (n - 1)-grams that they begin and end with if ``related``."""

    def merged(held: list[list[np.ndarray]]) -> list[np.ndarray]:
        grams, times, *others = (np.concatenate(c) for c in zip(*held, strict=True))
        if not len(grams):
            return [grams, times, *others]
        order = np.argsort(grams)
        grams = grams[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        return [grams[first], np.add.reduceat(times[order], first), *(c[order[first]] for c in others)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, block in _blocks(tb.as_strings(batch.column("text"))):
                grams, at = _grams(block, n)
                if related:
                    types, first, times = np.unique(grams, return_index=True, return_counts=True)
                    lower = tb.windows(block.words, n - 1)
                    held.append([types, times, lower[at[first]], lower[at[first] + 1]])
                else:
                    held.append(list(np.unique(grams, return_counts=True)))
                size += len(held[-1][0])
                if size >= HELD:
                    yield _batch(merged(held))
                    held, size = [], 0
        if held:
            yield _batch(merged(held))

    return run


def _weights(block: Block, n: int, orders: int, at: np.ndarray) -> np.ndarray:
    """How often the logarithm of each n-gram's count remains: as a word's highest order, less as the context of the next."""
    place, m = block.place[at] + n - 1, block.sizes[block.text[at]]  # of the last word
    if n == orders:
        return np.ones(len(at), np.int64)
    context = (place + 1 < m) & ((n == orders - 1) | (place == n - 1))
    return (place == n - 1).astype(np.int64) - context


def _asked(n: int, part: int, passes: int):
    """(row, gram) of the texts' n-grams whose hashes are of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for lo, _, block in _blocks(tb.as_strings(batch.column("text"))):
                grams, at = _grams(block, n)
                keep = np.flatnonzero(_part(grams, passes) == part)
                columns = [rows[lo + block.text[at[keep]]], grams[keep].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "gram"])

    return run


#: n-grams and texts that a chunk has at about; its texts are numbered in 16 bits.
CHUNK, CHUNK_TEXTS = 1 << 20, 1 << 14
DEALT = "place int, chunk long, rows binary, gram binary, times binary, asked binary, text binary, weight binary"
FOUND = "place int, chunk long, rows binary, text binary, weight binary, low binary, high binary"


def _sent(orders: tuple[int, ...], most: int, part: int, passes: int, places: int):
    """The n-grams of one part by place and chunk, and the rows of each chunk's texts.

    gram, times and asked: the distinct n-grams, how often they occur and how often a text asks for them; text and weight: who
    asks, in the order of the n-grams.
    """
    names = [c.split()[0] for c in DEALT.split(", ")]
    empty = lambda size: dealt.runs(np.zeros(size + 1, np.int64), np.zeros(0, np.uint8))

    def sent(chunk: int, rows: list[np.ndarray], held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(rows)
        home = [pa.array([chunk % places], pa.int32()), pa.array([chunk]), dealt.runs(np.array([0, len(rows)]), rows)]
        yield pa.RecordBatch.from_arrays([*home, *[empty(1)] * 5], names)
        for columns in held.values():
            grams, text, weight = (np.concatenate(c) for c in zip(*columns, strict=True))
            if not len(grams):
                continue
            order = np.argsort(grams)
            grams, text, weight = grams[order], text[order], weight[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            wanted = weight != 0
            times, asked = np.diff(np.append(first, len(grams))).astype(np.int32), np.add.reduceat(wanted, first, dtype=np.int32)
            # The upper halves of sorted hashes rise, so a place's n-grams lie together.
            place = dealt.upper_bucket(grams[first], passes * places) - np.uint64(part * places)
            found, start = np.unique(place, return_index=True)
            bounds = np.append(start, len(first))
            asks = np.concatenate([[0], np.cumsum(asked, dtype=np.int64)])[bounds]
            one = [pa.array(found, pa.int32()), pa.array(np.full(len(found), chunk)), empty(len(found)), dealt.runs(bounds, grams[first]), dealt.runs(bounds, times), dealt.runs(bounds, asked)]
            yield pa.RecordBatch.from_arrays([*one, dealt.runs(asks, text[wanted]), dealt.runs(asks, weight[wanted])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        rows, held, size, texts = [], {n: [] for n in orders}, 0, 0
        for batch in batches:
            column, ids = tb.as_strings(batch.column("text")), batch.column("row").to_numpy()
            for start in range(0, len(column), CHUNK_TEXTS):
                for lo, hi, block in _blocks(column.slice(start, CHUNK_TEXTS)):
                    for n in orders:
                        grams, at = _grams(block, n)
                        bucket = dealt.upper_bucket(grams, passes * places)
                        keep = np.flatnonzero((bucket >= part * places) & (bucket < (part + 1) * places))
                        at = at[keep]
                        held[n].append([grams[keep], (texts + block.text[at]).astype(np.uint16), _weights(block, n, most, at).astype(np.int8)])
                        size += len(keep)
                    rows.append(ids[start + lo : start + hi])
                    texts += hi - lo
                    if size >= CHUNK or texts >= CHUNK_TEXTS:
                        yield from sent(chunk, rows, held)
                        chunk, rows, held, size, texts = chunk + 1, [], {n: [] for n in orders}, 0, 0
        if texts:
            yield from sent(chunk, rows, held)

    return run


def _joined(places: int):
    """What the texts asked for with the counts of the whole table, back by chunk; counts of 1, whose logarithm is 0, are left out."""
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ends, chunks = [], [], []
        for batch in batches:
            whole = np.diff(_ends(batch.column("rows"), 8)) > 0
            if whole.any():
                mine = batch.filter(pa.array(whole))
                place = pa.array(mine.column("chunk").to_numpy() % places, pa.int32())
                none = dealt.runs(np.zeros(len(mine) + 1, np.int64), np.zeros(0, np.uint8))
                yield pa.RecordBatch.from_arrays([place, mine.column("chunk"), mine.column("rows"), *[none] * 4], names)
            chunks.append(batch.column("chunk").to_numpy().copy())
            ends.append(np.diff(_ends(batch.column("text"), 2)))
            parts.append([dealt.values(batch.column(c), t).copy() for c, t in (("gram", "u8"), ("times", "i4"), ("asked", "i4"), ("text", "u2"), ("weight", "i1"))])
        if not parts:
            return
        gram, times, asked, text, weight = (np.concatenate(c) for c in zip(*parts, strict=True))
        if not len(gram):
            return
        order = np.argsort(gram)
        gram = gram[order]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        total = np.empty(len(gram), np.int64)
        total[order] = np.repeat(np.add.reduceat(times[order], first, dtype=np.int64), np.diff(np.append(first, len(gram))))
        total = np.repeat(total, asked)
        keep = total > 1
        bounds = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(np.concatenate(ends))])]
        several = np.flatnonzero(np.diff(bounds))
        chunk = np.concatenate(chunks)[several]
        bounds = np.append(bounds[several], bounds[-1])
        total = total[keep]
        columns = [text[keep], weight[keep], (total & 0xFFFF).astype(np.uint16), (total >> 16).astype(np.uint32)]
        none = dealt.runs(np.zeros(len(chunk) + 1, np.int64), np.zeros(0, np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(chunk % places, pa.int32()), pa.array(chunk), none, *(dealt.runs(bounds, c) for c in columns)], names)

    return run


def _ends(column: pa.Array, width: int) -> np.ndarray:
    """Where the rows of ``dealt.runs`` begin and end, in values of ``width`` bytes."""
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // width


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, found) of the texts of the chunks that came to a place."""
    home, sizes, rows, chunks, runs, parts = [], [], [], [], [], []
    for batch in batches:
        chunk, size = batch.column("chunk").to_numpy(), np.diff(_ends(batch.column("rows"), 8))
        home.append(chunk[size > 0])
        sizes.append(size[size > 0])
        rows.append(dealt.values(batch.column("rows"), "i8").copy())
        chunks.append(chunk.copy())
        runs.append(np.diff(_ends(batch.column("text"), 2)))
        parts.append([dealt.values(batch.column(c), t).copy() for c, t in (("text", "u2"), ("weight", "i1"), ("low", "u2"), ("high", "u4"))])
    if not home:
        return
    home, sizes, rows, chunks, runs = map(np.concatenate, (home, sizes, rows, chunks, runs))
    text, weight, low, high = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(home)
    start = (np.cumsum(sizes) - sizes)[order]
    base = start[np.searchsorted(home[order], chunks[runs > 0])]
    at = np.repeat(base, runs[runs > 0]) + text
    found = np.bincount(at, weight * np.log(low + high * 65536.0), len(rows)).astype(np.float64)  # of no numbers it makes integers
    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(found)], ["row", "found"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, sizes = tb.as_strings(batch.column("text")), []
        for lo, hi in tb.blocks(column):
            sizes.append(np.diff(tb.words(column.slice(lo, hi - lo)).offsets))
        sizes = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), sizes], ["doc_id", "row", "n_words"])


def _counts(texts: DataFrame, n: int, least: int, related: bool = False) -> DataFrame:
    """(gram, n), and prefix and suffix if ``related``, of all n-grams of the texts that occur ``least`` times."""
    schema = "gram long, n long" + ", prefix long, suffix long" * related
    more = [F.first(c).alias(c) for c in ("prefix", "suffix")] if related else []
    counted = texts.select("text").mapInArrow(_counted(n, related), schema).repartition("gram")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), *more).where(F.col("n") >= least)


def score(docs: DataFrame, work: Workspace, *, orders: int = 3, least: int = 1, passes: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score of every document."""
    docs = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")  # rows that agree in both have one score
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("row long, n_words long")])
    sizes = work.save(docs.withColumn("row", F.xxhash64("doc_id", "text")).mapInArrow(_sizes, schema), "sizes")
    total = sizes.agg(F.sum("n_words")).first()[0] or 0
    sums, below = [], None
    if least <= 1:
        lengths = sizes.agg(*[F.max((F.col("n_words") == n).cast("int")) for n in range(1, orders + 1)]).first()
        asking = tuple(n for n in range(1, orders + 1) if n >= orders - 1 or lengths[n - 1])
        places = dealt.places(work.spark)
        for part in range(passes):
            work.free_shuffles()
            sent = texts.mapInArrow(tb.released(_sent(asking, orders, part, passes, places)), DEALT)
            joined = dealt.deal(sent, places).mapInArrow(tb.released(_joined(places)), FOUND)
            sums.append(work.save(dealt.deal(joined, places).mapInArrow(tb.released(_summed), "row long, found double"), f"sums{part}"))
    for n in range(1, orders + 1) if least > 1 else ():
        table = _counts(texts, n, least, n > 1)
        if n == 1:  # a rare word counts as one that occurs once
            table = table.select("gram", "n", F.log(F.col("n") / total).alias("score"), F.log("n").alias("value"))
        else:
            table = table.join(below.select(F.col("gram").alias("prefix"), F.col("n").alias("context")), "prefix")
            table = table.join(below.select(F.col("gram").alias("suffix"), F.col("score").alias("shorter")), "suffix")
            table = table.select("gram", "n", F.log(F.col("n") / F.col("context")).alias("score"), "shorter")
            table = table.select("gram", "n", "score", (F.col("score") - F.col("shorter") - log(BACKOFF)).alias("value"))
        below = work.save(table, f"counts{n}")
        for part in range(passes):
            work.free_shuffles()
            asked = texts.mapInArrow(_asked(n, part, passes), "row long, gram long")
            mine = below.select("gram", "value").where(F.pmod(F.shiftrightunsigned("gram", 32), F.lit(passes)) == part)
            found = asked.join(mine.hint("shuffle_hash"), "gram").groupBy("row").agg(F.sum("value").alias("found"))
            sums.append(work.save(found, f"sums{n}_{part}"))
    m, found = F.col("n_words"), sizes.select("row", F.lit(0.0).alias("found"), F.lit(1).alias("rows"))
    for s in sums:
        found = found.unionAll(s.select("row", "found", F.lit(0).alias("rows")))
    found = found.groupBy("row").agg(F.sum("found").alias("found"), F.sum("rows").alias("rows"))
    score = F.col("found") / F.col("rows")  # repeated rows have asked once each
    if least <= 1:
        score = F.when(m > 0, score - log(max(total, 1))).otherwise(0.0)
    else:  # the score of backing off at every word
        shorter = sum((F.greatest(m - n + 1, F.lit(0)) for n in range(2, orders + 1)), F.lit(0))
        score = score + shorter * log(BACKOFF) - m * log(max(total, 1))
    out = sizes.join(found, "row").select("doc_id", "n_words", score.alias("log_score"))
    return out.withColumn("mean_log_score", F.col("log_score") / F.when(m > 0, m))
