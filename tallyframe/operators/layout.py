"""Report layouts as tables that any renderer can draw: rows in order of (section, ord) with label, indent and colour.

A section is one member of the first level, so sections are laid out independently and no window spans the report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.variance import MEASURES, money

#: The left margin of the first level and the step of each further one, in points.
MARGIN, STEP = 3, 11
GREEN, RED, GREY = "green", "red", "grey"


def colour(measure: Column, total: Column) -> Column:
    """Of a variance row, by the sign of its total; null for other measures."""
    return F.when(measure == "Variance", F.when(total > 0, GREEN).when(total < 0, RED).otherwise(GREY))


def _ordinal() -> Column:
    return F.array_position(F.array(*map(F.lit, MEASURES)), F.col("Measure")).cast("int")


def _numbers(labels: Sequence[str]) -> list[Column]:
    return [money(F.col(f"`{c}`")).alias(c) for c in (*labels, "TOTAL")]


def outline(stacked: DataFrame, levels: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Label rows for the levels at which a key differs from the one before it, then its measures one level deeper."""
    keys = [F.col(f"`{c}`") for c in levels]
    before = Window.partitionBy(keys[0]).orderBy(*keys[1:])
    key = stacked.select(*keys).distinct()
    last = F.lag(F.struct(*keys)).over(before)
    shared, same = F.lit(0), F.lit(True)
    for c in levels:
        same = same & F.coalesce(F.col("_last")[c].eqNullSafe(F.col(f"`{c}`")), F.lit(False)) & F.col("_last").isNotNull()
        shared = shared + same.cast("int")
    key = key.withColumn("_last", last).withColumn("_shared", shared)
    empty = [F.lit("").alias(c) for c in (*labels, "TOTAL")]
    named = F.inline(F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"`{c}`").cast("string").alias("label")) for k, c in enumerate(levels)]))
    heads = key.select(*keys, "_shared", named).where("level >= _shared").select(*keys, F.col("level").alias("seq"), "level", "label", *empty, F.lit(None).cast("string").alias("colour"))
    depth = len(levels)
    body = stacked.select(*keys, (F.lit(depth) + _ordinal()).alias("seq"), F.lit(depth).alias("level"), F.col("Measure").alias("label"), *_numbers(labels), colour(F.col("Measure"), F.col("TOTAL")).alias("colour"))
    rows = heads.unionByName(body)
    ordinal = F.row_number().over(Window.partitionBy(keys[0]).orderBy(*keys[1:], "seq"))
    return rows.select(keys[0].alias("section"), ordinal.alias("ord"), (F.lit(MARGIN) + F.col("level") * STEP).alias("indent"), "label", *[f"`{c}`" for c in (*labels, "TOTAL")], "colour", (F.col("level") == 0).alias("tinted"))


def columnar(stacked: DataFrame, levels: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """A column for each level, filled on the first of a key's three rows only. A projection: nothing is shuffled."""
    shown = [F.when(F.col("Measure") == MEASURES[0], F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).otherwise("").alias(f"label_{k}") for k, c in enumerate(levels)]
    return stacked.select(F.concat_ws("|", *[F.col(f"`{c}`") for c in levels]).alias("key"), _ordinal().alias("ord"), *shown, "Measure", *_numbers(labels), colour(F.col("Measure"), F.col("TOTAL")).alias("colour"))
