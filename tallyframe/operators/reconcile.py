"""Gates: findings that block a load. Each is an aggregation whose result is a handful of rows for each file or level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.members import member_key
from tallyframe.plans.report import HIGH, OK, OVERRIDDEN, findings

#: Fixed value: what a level holds that a report may lack.
OVERRIDDEN_VALUE = "NA - Overridden"


def totals_against_leaves(leaves: DataFrame, totals: DataFrame, period: str, value: str, tolerance: float) -> DataFrame:
    """Periods where a file's leaf sum and its own total differ by more than ``tolerance``, or one is missing.

    Rows with is_leaf false, the parents of an outline, aren't added: their leaves are.
    """
    if "is_leaf" in leaves.columns:
        leaves = leaves.where("is_leaf")
    sums = leaves.where(F.col(period).isNotNull()).groupBy("source_file", period).agg(F.sum(value).alias("leaf_sum"))
    both = sums.join(totals.select("source_file", period, "total"), ["source_file", period], "full_outer")
    off = F.col("leaf_sum").isNull() | F.col("total").isNull() | (F.abs(F.col("leaf_sum") - F.col("total")) > tolerance)
    return both.where(off).select("source_file", period, "leaf_sum", "total", F.lit("reconciliation_mismatch").alias("method"), F.lit("HIGH").alias("review_priority"))


def null_levels(facts: DataFrame, levels: Sequence[str]) -> DataFrame:
    """(source_file, level, n_null): declared levels of a file that hold nulls, with how many. One pass."""
    counts = facts.groupBy("source_file").agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in levels])
    rows = counts.select("source_file", F.inline(F.array(*[F.struct(F.lit(c).alias("level"), F.col(f"`{c}`").alias("n_null")) for c in levels])))
    return rows.where("n_null > 0").withColumns({"method": F.lit("dimension_null"), "review_priority": F.lit("HIGH")})


def near_duplicates(members: DataFrame) -> DataFrame:
    """(level, folded, members): members of a level that differ in punctuation, case or form (NFKC) only."""
    distinct = members.where("member IS NOT NULL").select("level", "member").distinct().withColumn("folded", member_key(F.col("member"), True, True))
    groups = distinct.groupBy("level", "folded").agg(F.array_sort(F.collect_set("member")).alias("m"))
    return groups.where(F.size("m") > 1).select("level", "folded", F.array_join("m", ", ").alias("members"))


def metadata_gate(meta: DataFrame, sheets: DataFrame, declared: Sequence[str], required: Sequence[str], longest: int = 31) -> DataFrame:
    """Findings on metadata (source_file, label, value) against the declared fields; ``sheets`` has (source_file, sheet_name) for every file.

    The field 'Report' must be the sheet's name, compared as text, and at most ``longest`` characters.
    """
    norm = lambda c: F.lower(F.trim(c))
    fields = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(f.strip().lower()).alias("norm"), F.lit(f in required).alias("needed")) for f in declared]))
    grid = sheets.select("source_file", "sheet_name", fields)
    both = grid.join(meta.select("source_file", norm("label").alias("norm"), "value"), ["source_file", "norm"], "full_outer")
    value = F.col("value")
    missing = F.when(F.col("field").isNull(), "metadata_unexpected").when(value.isNull(), F.when(F.col("needed"), "metadata_missing").otherwise("metadata_absent")).when(value == "", "metadata_empty")
    report = (F.col("norm") == "report") & (F.coalesce(value, F.lit("")) != "")
    methods = F.array_compact(F.array(missing, F.when(report & (F.length("value") > longest), "report_name_too_long"), F.when(report & (value != F.col("sheet_name")), "report_name_mismatch")))
    rows = both.select("source_file", F.coalesce("field", "norm").alias("source_header"), F.col("field").alias("resolved_name"), F.coalesce("needed", F.lit(True)).alias("needed"), F.explode(methods).alias("method"))
    optional = F.col("method").isin("metadata_absent", "metadata_empty") & ~F.col("needed")
    return findings(rows, review_priority=F.when(optional, OK).otherwise(HIGH))


def structural_gate(present: DataFrame, levels: Sequence[str], permitted: DataFrame) -> DataFrame:
    """Findings on the dimensions (source_file, name) of each file against the declared levels.

    ``permitted`` (source_file, name) lists the levels that a file may lack. Extra dimensions block.
    """
    grid = present.select("source_file").distinct().select("source_file", F.explode(F.array(*map(F.lit, levels))).alias("name"))
    gone = grid.join(present, ["source_file", "name"], "left_anti").join(permitted.select("source_file", "name", F.lit(True).alias("allowed")), ["source_file", "name"], "left")
    allowed = F.col("allowed").isNotNull()
    lost = findings(gone, resolved_name=F.col("name"), method=F.when(allowed, "hierarchy_overridden").otherwise("hierarchy_missing"), review_priority=F.when(allowed, OVERRIDDEN).otherwise(HIGH))
    extra = present.where(~F.col("name").isin(*levels))
    return lost.unionByName(findings(extra, source_header=F.col("name"), resolved_name=F.col("name"), method=F.lit("hierarchy_unexpected"), review_priority=F.lit(HIGH)))


def apply_levels(rows: DataFrame, levels: Sequence[str], permitted: Sequence[str] = ()) -> DataFrame:
    """Declared levels first and in order: missing ones hold the sentinel where permitted, else null; nulled_levels names the permitted ones."""
    gone = [c for c in levels if c not in rows.columns]
    made = [F.col(f"`{c}`") if c in rows.columns else F.lit(OVERRIDDEN_VALUE if c in permitted else None).cast("string").alias(c) for c in levels]
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in levels]
    return rows.select(*made, F.lit(", ".join(sorted(c for c in gone if c in permitted))).alias("nulled_levels"), *rest)
