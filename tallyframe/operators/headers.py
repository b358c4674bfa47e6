"""Headers to declared names: exact, alias, fuzzy, or passed through; and what happens when two claim the same name.

Headers are (source_file, pos, header). They are few beside the rows; the declared names are the driver's.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.members import nearest
from tallyframe.functions.text import collapse, norm_header
from tallyframe.plans.report import HIGH, OK


def strip_prefix(header: Column, prefixes: Sequence[str]) -> Column:
    """The header without one leading aggregation prefix, its case kept."""
    return F.regexp_replace(collapse(header), "(?i)^(?:" + "|".join(map(re.escape, prefixes)) + ") ", "") if prefixes else collapse(header)


def alias_pool(aliases: Mapping[str, Sequence[str]]) -> list[tuple[str, str, str]]:
    """(normalised name, canonical, method): canonical names, then aliases; the first claim to a name holds. Levels without aliases don't take part."""
    norm = lambda s: " ".join(s.lower().split())
    pool: dict[str, tuple[str, str]] = {}
    for c, names in aliases.items():
        if names:
            pool.setdefault(norm(c), (c, "canonical_exact"))
    for c, names in aliases.items():
        for n in names:
            pool.setdefault(norm(n), (c, "alias_exact"))
    return [(n, c, how) for n, (c, how) in pool.items()]


def resolve_headers(headers: DataFrame, aliases: Mapping[str, Sequence[str]], *, fuzzy: bool = True, accept: float = 0.85, review: float = 0.6, near: float = 0.4, prefixes: Sequence[str] = ()) -> DataFrame:
    """``headers`` with resolved_name, method, matched_against, confidence, review_priority and note, before collisions."""
    pool = alias_pool(aliases)
    rows = headers.withColumn("_n", norm_header(F.col("header"), prefixes))
    names = rows.sparkSession.createDataFrame(pool, "_n string, _canonical string, _how string")
    distinct = rows.select("_n").distinct().join(names, "_n", "left")
    if fuzzy and pool:
        known = F.create_map(*[F.lit(x) for n, c, _ in pool for x in (n, c)])
        distinct = distinct.withColumn("_near", nearest(F.col("_n"), [n for n, _, _ in pool]))
        distinct = distinct.select("_n", "_canonical", "_how", F.col("_near.name").alias("_near"), F.col("_near.ratio").alias("_ratio"), F.try_element_at(known, F.col("_near.name")).alias("_nearest"))
    else:
        distinct = distinct.withColumns({"_near": F.lit(None).cast("string"), "_ratio": F.lit(None).cast("double"), "_nearest": F.lit(None).cast("string")})
    exact, sure, unsure = F.col("_how").isNotNull(), F.col("_ratio") >= accept, F.col("_ratio") >= review
    method = F.when(exact, F.col("_how")).when(sure, "fuzzy").when(unsure, "fuzzy_low_confidence").otherwise("passthrough")
    found = method != "passthrough"
    out = rows.join(distinct, "_n", "left").withColumns(
        {
            "resolved_name": F.when(exact, F.col("_canonical")).when(unsure, F.col("_nearest")).otherwise(strip_prefix(F.col("header"), prefixes)),
            "method": method,
            "matched_against": F.when(F.col("_how") == "canonical_exact", F.col("_canonical")).when(exact, F.col("_n")).when(found, F.col("_near")),
            "confidence": F.when(exact, 1.0).when(found, F.col("_ratio")),
            "review_priority": F.when(method == "fuzzy_low_confidence", HIGH).otherwise(OK),
            "note": F.when(~found & (F.col("_ratio") >= near), F.concat(F.lit("closest is "), "_nearest")).when(method == "fuzzy_low_confidence", "low confidence"),
        }
    )
    return out.drop("_n", "_canonical", "_how", "_near", "_ratio", "_nearest")


def header_collisions(resolved: DataFrame) -> DataFrame:
    """Of headers of a file with the same name the surest keeps it, the leftmost of equals; the others go back to their own header for review."""
    rank = F.row_number().over(Window.partitionBy("source_file", "resolved_name").orderBy(F.coalesce("confidence", F.lit(0.0)).desc(), "pos"))
    lost = F.col("_rank") > 1
    keep = lambda name, other: F.when(lost, other).otherwise(F.col(name))
    out = resolved.withColumn("_rank", rank).withColumns(
        {
            "note": keep("note", F.concat(F.lit("collision on "), "resolved_name")),
            "resolved_name": keep("resolved_name", F.trim("header")),
            "method": keep("method", F.lit("collision_reverted")),
            "matched_against": keep("matched_against", F.lit(None)),
            "confidence": keep("confidence", F.lit(None)),
            "review_priority": keep("review_priority", F.lit(HIGH)),
        }
    )
    return out.drop("_rank")


def hierarchy_audit(report: DataFrame, levels: Sequence[str]) -> DataFrame:
    """(source_file, business_level, canonical, source_header, status): the leftmost header that filled each level of each file.

    ``report`` has source_file, resolved_name, source_header and pos. The grid is an explode of the declared levels.
    """
    hits = report.where(F.col("resolved_name").isin(*levels) & F.col("source_header").isNotNull()).groupBy("source_file", "resolved_name").agg(F.min_by("source_header", "pos").alias("source_header"))
    grid = report.select("source_file").distinct().select("source_file", F.posexplode(F.array(*map(F.lit, levels))).alias("_k", "canonical"))
    out = grid.join(hits.withColumnRenamed("resolved_name", "canonical"), ["source_file", "canonical"], "left")
    status = F.when(F.col("source_header").isNull(), "MISSING").otherwise("mapped")
    return out.select("source_file", (F.col("_k") + 1).alias("business_level"), "canonical", "source_header", status.alias("status"))
