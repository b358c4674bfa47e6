"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round is two shuffles of the links that are left, and a round's links are never more than the round's before plus the
nodes; the links end as stars around the smallest node of each component. Nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.work import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``links`` (u, v) as (node, root) for every node with a link; root is the component's smallest node."""
    sign = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
    now = work.save(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{name}0")
    before, step = sign(now), 0
    while before[0]:
        step += 1
        now = work.save(_small_star(_large_star(now)), f"{name}{step}")
        work.drop(f"{name}{step - 1}")
        after = sign(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
