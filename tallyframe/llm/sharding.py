"""Sharding by a two-pass external shuffle.

Pass one scatters the rows over buckets that fit in memory, by a seeded hash of the row. Pass two reads one bucket at a
time, applies a Fisher-Yates permutation drawn from the seed and the bucket's number, and writes it. The place of a row in
the whole permutation is its bucket's offset plus its place in the bucket; dealing places round robin gives shards whose
row counts differ by one at most, and gapless slots, without another shuffle: offsets are a row for each bucket and meet the
buckets by a broadcast while they are below a checked size.

Copies of a text are spread by their keys. Rows that agree in key and text are interchangeable; those beyond the first of a
heavy repetition (``heavy`` rows or more, found by a sum that is made map-side) are scattered by their place in the input.

Defined results: null texts have size 1, null keys are hashed like any value, repeated rows are kept, an empty table gives
no rows. Columns of the input that clash with size, text_crc32, shard or slot are replaced; names with a leading
"_shuffle_" are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyframe.llm.work import Workspace

ADDED = ("size", "text_crc32", "shard", "slot")


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text and one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _permute(seed: int):
    def run(bucket: pa.Table) -> pa.Table:
        order = bucket.column("_shuffle_hash").to_numpy().argsort(kind="stable")
        number = bucket.column("_shuffle_bucket")[0].as_py()
        order = order[np.random.Generator(np.random.PCG64([seed, number])).permutation(len(order))]
        bucket = bucket.take(pa.array(order))
        return bucket.append_column("_shuffle_place", pa.array(np.arange(len(order)), pa.int64()))

    return run


def _scatter(docs: DataFrame, seed: int, key: str, text: str, heavy: int) -> Column:
    """The seeded hash of each row."""
    row = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    twice = docs.groupBy(F.xxhash64(F.col(key)).alias("k")).agg(F.count("*").alias("n")).where(F.col("n") >= heavy)
    if twice.isEmpty():
        return row
    return F.xxhash64(row, F.monotonically_increasing_id())


def external_shuffle(
    docs: DataFrame, work: Workspace, *, shards: int = 16, seed: int = 20240229, bucket_bytes: int = 32 << 20, least_buckets: int = 16, heavy: int = 100_000,
    most_broadcast: int = 1_000_000, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in a seeded random order, with size, text_crc32, shard and slot; written under ``work``.

    A bucket holds ``bucket_bytes`` of text on average. The number of buckets follows the size of the table, so a task's
    memory does not. Offsets of up to ``most_broadcast`` buckets (16 bytes each) are broadcast, more are joined by a shuffle.
    """
    if clash := [c for c in docs.columns if c.startswith("_shuffle_")]:
        raise ValueError(f"reserved column names: {clash}")
    docs = docs.drop(*ADDED)
    total = docs.agg(F.sum(text_size(text))).first()[0] or 0
    buckets = max(least_buckets, -(-total // bucket_bytes))
    row = _scatter(docs, seed, key, text, heavy)
    scattered = docs.withColumn("_shuffle_hash", row).withColumn("_shuffle_bucket", F.pmod("_shuffle_hash", F.lit(buckets)).cast("int"))
    schema = StructType([*scattered.schema, StructField("_shuffle_place", LongType())])
    written = work.save(scattered.groupBy("_shuffle_bucket").applyInArrow(_permute(seed), schema), "buckets")
    counts = written.groupBy("_shuffle_bucket").agg(F.count("*").alias("_shuffle_rows"))
    before = Window.orderBy("_shuffle_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shuffle_bucket", F.coalesce(F.sum("_shuffle_rows").over(before), F.lit(0)).alias("_shuffle_offset"))
    place = F.col("_shuffle_offset") + F.col("_shuffle_place")
    out = written.join(F.broadcast(offsets) if buckets <= most_broadcast else offsets, "_shuffle_bucket")
    out = out.withColumns(
        {
            "size": text_size(text),
            "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
            "shard": (place % shards).cast("int"),
            "slot": F.floor(place / shards).cast("long") if shards & (shards - 1) else F.shiftright(place, shards.bit_length() - 1),
        }
    )
    return out.drop("_shuffle_hash", "_shuffle_bucket", "_shuffle_place", "_shuffle_offset")


def write_shards(shuffled: DataFrame, path: str, *, parts: int | None = None) -> None:
    """One folder for each shard; its files, ``parts`` in all, follow each other in order of slot."""
    dealt = shuffled.repartitionByRange(parts, "shard", "slot") if parts else shuffled.repartitionByRange("shard", "slot")
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
