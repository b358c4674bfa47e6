"""Row-order operators over outlines: rows (source_file, r, label, sub_level) of one sheet, in order of r.

A window holds one sheet, which its format bounds; files are dealt over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.text import is_blank
from tallyframe.plans.report import HIGH, OK, findings


def _sheet():
    return Window.partitionBy("source_file").orderBy("r")


def parent_leaf(rows: DataFrame) -> DataFrame:
    """Adds is_parent (the next row is deeper) and is_leaf; a sheet's last row is a leaf."""
    deeper = F.coalesce(F.lead("sub_level").over(_sheet()) > F.col("sub_level"), F.lit(False))
    return rows.withColumn("is_parent", deeper).withColumn("is_leaf", ~F.col("is_parent"))


def lineage(rows: DataFrame, depth: int) -> DataFrame:
    """Adds parent_label and path; ``depth`` is the number of levels. A deeper row is an error, so that no level is lost.

    The latest row of each level above counts unless a shallower row came after it, which ended its branch.
    """

    def latest(level: int) -> Column:
        return F.last(F.when(F.col("sub_level") == level, F.struct("r", "label")), ignorenulls=True).over(_sheet().rowsBetween(Window.unboundedPreceding, Window.currentRow))

    out = rows.withColumns({f"_at{k}": latest(k) for k in range(depth)})
    ancestors = []
    for k in range(depth):
        alive = F.col("sub_level") > k
        for shallower in range(k):
            alive &= F.coalesce(F.col(f"_at{shallower}.r") < F.col(f"_at{k}.r"), F.lit(True))
        ancestors.append(F.when(alive, F.col(f"_at{k}.label")))
    out = out.withColumn("_up", F.array_compact(F.array(*ancestors)))
    too_deep = F.raise_error(F.concat(F.lit(f"an outline is deeper than {depth} levels: "), F.col("sub_level").cast("string")))
    out = out.withColumn("_up", F.when(F.col("sub_level") >= depth, too_deep.cast("array<string>")).otherwise(F.col("_up")))
    out = out.withColumns({"parent_label": F.try_element_at("_up", F.lit(-1)), "path": F.concat_ws(" > ", "_up", "label")})
    return out.drop("_up", *[f"_at{k}" for k in range(depth)])


def fill_blanks(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``rows`` with blank dimensions filled where they are suppressed repeats, and filled and missing, the names of those.

    Blanks repeat what stands above if they are all to the left of a row's labels: the first dimension the last label of the
    same sub_level, others the last one in their column. A blank right of a label is a hole and stays null, as does one with
    nothing above it.
    """
    blank = {c: is_blank(F.col(f"`{c}`")) for c in dims}
    n = sum((b.cast("int") for b in blank.values()), F.lit(0))
    prefix = F.lit(True)
    for k, c in enumerate(dims):
        prefix = prefix & (blank[c] == (F.lit(k) < n))
    above = Window.unboundedPreceding, -1
    levels = Window.partitionBy("source_file", "sub_level").orderBy("r").rowsBetween(*above)
    sheet = _sheet().rowsBetween(*above)
    last = {c: F.last(F.when(~blank[c], F.col(f"`{c}`")), ignorenulls=True).over(levels if k == 0 else sheet) for k, c in enumerate(dims)}
    out = rows.withColumn("_prefix", prefix).withColumns({f"_last{k}": last[c] for k, c in enumerate(dims)})
    use = {c: F.col("_prefix") & F.col(f"_last{k}").isNotNull() for k, c in enumerate(dims)}
    names = lambda test: F.array_compact(F.array(*[F.when(blank[c] & test(c), F.lit(c)) for c in dims]))
    out = out.withColumns({"filled": names(lambda c: use[c]), "missing": names(lambda c: ~use[c])})
    out = out.withColumns({c: F.when(~blank[c], F.col(f"`{c}`")).otherwise(F.when(use[c], F.col(f"_last{k}"))) for k, c in enumerate(dims)})
    return out.drop("_prefix", *[f"_last{k}" for k in range(len(dims))])


def blank_findings(filled: DataFrame) -> DataFrame:
    """Findings on each file's dimensions: how many repeats were filled, and how many values are missing."""
    one = lambda column, method, priority, what: findings(
        filled.select("source_file", F.explode(column).alias("dim")).groupBy("source_file", "dim").agg(F.count("*").alias("n")),
        source_header=F.col("dim"), resolved_name=F.col("dim"), method=F.lit(method), review_priority=F.lit(priority), note=F.concat(F.col("n").cast("string"), F.lit(what)),
    )
    return one("filled", "label_repeat_filled", OK, " suppressed labels filled").unionByName(one("missing", "dim_missing_value", HIGH, " values missing"))
