"""Findings: one row for each header, member or check that a gate has something to say about. All gates return this schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The priorities of a finding; HIGH blocks a load.
OK, HIGH, OVERRIDDEN = "OK", "HIGH", "OVERRIDDEN"
COLUMNS = {
    "source_file": "string", "source_header": "string", "resolved_name": "string", "method": "string", "matched_against": "string", "confidence": "double",
    "review_priority": "string", "note": "string",
}


def findings(rows: DataFrame, **values: Column) -> DataFrame:
    """``rows`` as findings: a column is taken from ``values``, else from the column of that name, else null."""
    have = set(rows.columns)
    cell = {c: values.get(c, F.col(c) if c in have else F.lit(None)) for c in COLUMNS}
    return rows.select(*[cell[c].cast(kind).alias(c) for c, kind in COLUMNS.items()])


def full_report(*reports: DataFrame) -> DataFrame:
    """The findings of all gates in one table."""
    return reduce(DataFrame.unionByName, reports)


def review_items(report: DataFrame, priority: str = HIGH) -> DataFrame:
    return report.where(F.col("review_priority") == priority)


def findings_by_method(report: DataFrame) -> DataFrame:
    return report.groupBy("method", "review_priority").agg(F.count("*").alias("n"))


class LoadBlocked(ValueError):
    """A batch has findings that must be settled before it loads."""


def load_gate(report: DataFrame, raise_on_fail: bool = True) -> tuple[bool, DataFrame]:
    """Whether the batch may load, and its blocking findings. One small aggregation; what is collected is a count a method."""
    high = review_items(report)
    counts = {r["method"]: r["n"] for r in findings_by_method(high).orderBy("method").collect()}
    if counts and raise_on_fail:
        raise LoadBlocked("Load blocked: " + ", ".join(f"{m} x{n}" for m, n in counts.items()))
    return not counts, high
