"""Budget against cost at the comparison key: compiled and stacked variance, one-sided keys, headline totals.

Everything is a conditional sum over the tagged union of both streams, so a key is shuffled once, after map-side partial
sums, and a stream with most of the rows of a key is no more than one partial row for each task. One-sided keys keep their
full amount (the missing side counts as zero) in both shapes. Keys with a null level are left out of sums and are listed
by ``seam_check``, which treats nulls as equal. Sums keep the kind of the values: whole numbers, decimals or doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.plans.staged import KEY, PERIOD, STREAM, VALUE, real_periods

MEASURES = ("Budget", "Cost", "Variance")
GRAND_TOTAL = "GRAND TOTAL"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _whole_keys(facts: DataFrame) -> DataFrame:
    return facts.dropna(subset=list(KEY))


def _side(measure: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(STREAM) == measure, F.col(VALUE))), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Half-even to one place; null where the whole is zero."""
    return F.when(whole != 0, F.bround(part * 100.0 / whole, 1))


def status(variance: Column) -> Column:
    return F.when(variance > 0, "surplus").when(variance < 0, "deficit").otherwise("on-budget")


def compiled(facts: DataFrame) -> DataFrame:
    """One row for each key with Budget, Cost, Variance, VarPct and Status, and one grand total row."""
    first = F.when(F.grouping(F.col(KEY[0])) == 1, GRAND_TOTAL).otherwise(F.col(KEY[0]))
    rest = [F.when(F.grouping(c) == 1, "").otherwise(c).alias(n) for n, c in zip(KEY[1:], _cols(KEY[1:]), strict=True)]
    grain = _whole_keys(real_periods(facts)).groupBy(*_cols(KEY)).agg(_side("Budget").alias("b"), _side("Cost").alias("c"))
    both = grain.groupingSets([_cols(KEY), []], *_cols(KEY)).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("Budget"), F.coalesce(F.sum("c"), F.lit(0)).alias("Cost"), first.alias("_first"), *[c.alias(f"_{k}") for k, c in enumerate(rest)]
    )
    variance = F.col("Budget") - F.col("Cost")
    return both.select(
        F.col("_first").alias(KEY[0]),
        *[F.col(f"_{k}").alias(n) for k, n in enumerate(KEY[1:])],
        "Budget",
        "Cost",
        variance.alias("Variance"),
        percent(variance, F.col("Cost")).alias("VarPct"),
        status(variance).alias("Status"),
    )


def period_order(facts: DataFrame) -> DataFrame:
    """(FiscalYear, ord): real periods by the number in their label."""
    digits = F.regexp_replace(PERIOD, "[^0-9]", "").try_cast("int")
    return real_periods(facts).select(PERIOD).distinct().select(PERIOD, digits.alias("ord"))


def periods(facts: DataFrame, most: int = 1000) -> list[str]:
    """Labels in order, for pivots. A pivot has a column for each, so more than ``most`` is an error."""
    rows = period_order(facts).orderBy("ord", PERIOD).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} periods")
    if bad := [r[0] for r in rows if r["ord"] is None]:
        raise ValueError(f"periods without a number: {bad}")
    return [r[0] for r in rows]


def stacked(facts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Three rows for each key (Budget, Cost, Variance) with a column for each label and TOTAL; absent amounts are 0."""
    facts = _whole_keys(real_periods(facts)).where(F.col(PERIOD).isin(*labels))
    sums = [F.coalesce(F.sum(F.when((F.col(STREAM) == m) & (F.col(PERIOD) == p), F.col(VALUE))), F.lit(0)).alias(f"{m}|{p}") for m in MEASURES[:2] for p in labels]
    wide = facts.groupBy(*_cols(KEY)).agg(*sums) if sums else facts.select(*_cols(KEY)).distinct()

    def amounts(measure: str) -> list[Column]:
        if measure == "Variance":
            return [F.col(f"`Budget|{p}`") - F.col(f"`Cost|{p}`") for p in labels]
        return [F.col(f"`{measure}|{p}`") for p in labels]

    rows = []
    for m in MEASURES:
        cells = amounts(m)
        total = sum(cells[1:], cells[0]) if cells else F.lit(0)
        rows.append(F.struct(F.lit(m).alias("Measure"), *[c.alias(p) for p, c in zip(labels, cells, strict=True)], total.alias("TOTAL")))
    return wide.select(*_cols(KEY), F.inline(F.array(*rows)))


def in_order(stacked_rows: DataFrame) -> DataFrame:
    """Stacked rows by key, Budget before Cost before Variance: a range sort, for output."""
    return stacked_rows.orderBy(*_cols(KEY), "Measure")


def strict(facts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``stacked`` as the two pivots would be aligned: a one-sided key has no row for the absent stream, null variances and 0 as their TOTAL."""
    rows = stacked(facts, labels).join(seam_check(_whole_keys(real_periods(facts))), list(KEY), "left")
    one = F.col("present_in").isNotNull()
    absent = one & F.col("Measure").isin("Budget", "Cost") & ~F.col("present_in").startswith(F.col("Measure"))
    rows = rows.where(~absent)
    gone = one & (F.col("Measure") == "Variance")
    cells = [F.when(~gone, F.col(f"`{p}`")).alias(p) for p in labels]
    return rows.select(*_cols(KEY), "Measure", *cells, F.when(gone, 0).otherwise(F.col("TOTAL")).alias("TOTAL"))


def headline_text(totals: DataFrame) -> DataFrame:
    """The headline as text: Budget, Cost, Variance and the percentage with its sign."""
    share = F.concat(F.when(F.col("VarPct") >= 0, "+").otherwise(""), F.format_number("VarPct", 1), F.lit("%"))
    shown = F.concat(*[x for m in MEASURES for x in (F.lit(("" if m == "Budget" else "  ") + f"{m} "), money(F.col(m)))], F.lit(" ("), share, F.lit(")"))
    return totals.select(shown.alias("headline"))


def seam_check(facts: DataFrame) -> DataFrame:
    """Keys that only one stream has, with that stream as present_in; nulls are equal to each other."""
    sides = facts.where(F.col(STREAM).isin("Cost", "Budget")).groupBy(*_cols(KEY)).agg(F.min(STREAM).alias("a"), F.max(STREAM).alias("b"))
    return sides.where("a = b").select(*_cols(KEY), F.concat("a", F.lit(" only")).alias("present_in"))


def headline_totals(facts: DataFrame) -> DataFrame:
    """Budget, Cost, Variance and the percentage of cost over everything; 0 percent where cost is 0."""
    sums = _whole_keys(real_periods(facts)).agg(_side("Budget").alias("Budget"), _side("Cost").alias("Cost"))
    variance = F.col("Budget") - F.col("Cost")
    return sums.select("Budget", "Cost", variance.alias("Variance"), F.coalesce(percent(variance, F.col("Cost")), F.lit(0.0)).alias("VarPct"))


def money(value: Column) -> Column:
    """Whole units, thousands separated, negatives in brackets; null is 0."""
    whole = F.bround(F.coalesce(value, F.lit(0)).cast("double"), 0)
    text = F.format_number(F.abs(whole), 0)
    return F.when(whole < 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)
