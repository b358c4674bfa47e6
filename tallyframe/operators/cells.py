"""From cells to tidy facts: header row, metadata block, column kinds, total rows, indents, routing.

Cells are (source_file, sheet_name, r, c, kind, str, num, indent), one for each that is not empty. A sheet is bounded by its
format, so windows go by file and row or by file; files are dealt over the cluster.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.text import is_blank, to_number

FILE = "source_file"
#: What rows that the format lacks look like.
FLAT = {"sub_level": ("int", "0"), "is_parent": ("boolean", "false"), "is_leaf": ("boolean", "true"), "parent_label": ("string", "null")}


def value(cells: DataFrame) -> DataFrame:
    """``cells`` with v, the number that a cell shows, or null."""
    return cells.withColumn("v", F.when(F.col("kind") == "boolean", None).otherwise(F.coalesce("num", to_number(F.col("str")))))


def header_row(cells: DataFrame) -> DataFrame:
    """(source_file, header): the nearest row with two cells or more and few numbers above the first two rows in a run with a number."""
    rows = value(cells).groupBy(FILE, "r").agg(F.count("*").alias("n"), F.count("v").alias("numbers"))
    last = Window.partitionBy(FILE)
    order = last.orderBy("r")
    rows = rows.withColumns({"next": F.lead("numbers").over(order), "end": F.max("r").over(last)})
    starts = F.when((F.col("numbers") > 0) & ((F.col("next") > 0) | (F.col("r") == F.col("end"))), F.col("r"))
    rows = rows.withColumn("first", F.min(starts).over(last))
    return rows.where((F.col("r") < F.col("first")) & (F.col("n") >= 2) & (F.col("numbers") < 0.5 * F.col("n"))).groupBy(FILE).agg(F.max("r").alias("header"))


def metadata_block(cells: DataFrame, headers: DataFrame, scan_rows: int = 12) -> DataFrame:
    """(source_file, label, value): labels ending in a colon above the header with the cell beside; the topmost of equal labels."""
    kept = cells.select(FILE, "c").distinct().withColumn("k", F.row_number().over(Window.partitionBy(FILE).orderBy("c")))
    above = cells.join(headers, FILE).where((F.col("r") < F.col("header")) & (F.col("r") >= F.col("header") - scan_rows)).join(kept, [FILE, "c"])
    text = F.trim("str")
    labels = above.where(text.endswith(":")).groupBy(FILE, "r").agg(F.min_by(F.struct(F.expr("trim(str)").alias("label"), "k"), "k").alias("x")).select(FILE, "r", "x.label", (F.col("x.k") + 1).alias("k"))
    widest = kept.groupBy(FILE).agg(F.max("k").alias("widest"))
    beside = labels.join(widest, FILE).where("k <= widest").join(above.select(FILE, "r", "k", F.trim("str").alias("value")), [FILE, "r", "k"], "left")
    label = F.trim(F.regexp_replace("label", ":$", ""))
    return beside.groupBy(FILE, label.alias("label")).agg(F.min_by(F.coalesce("value", F.lit("")), "r").alias("value"))


def meta_column(label: Column) -> Column:
    return F.concat(F.lit("meta_"), F.regexp_replace(F.lower(F.trim(F.regexp_replace(label, ":$", ""))), "[^a-z0-9]+", "_"))


def total_pattern(labels: Sequence[str]) -> str:
    return r"(?i)(?U)\b(?:" + "|".join(r"\s+".join(map(re.escape, x.split())) for x in labels) + r")\b"


def classify_columns(cells: DataFrame, headers: DataFrame, labels: Sequence[str], threshold: float = 0.6) -> DataFrame:
    """(source_file, c, header_text, kind, share): value columns are those with ``threshold`` or more numbers below the header, rows with a total word apart."""
    below = value(cells).join(headers, FILE)
    named = below.where("r = header").select(FILE, "c", F.trim("str").alias("header_text"))
    body = below.where("r > header")
    totals = body.where(F.col("str").rlike(total_pattern(labels))).select(FILE, "r").distinct()
    shares = body.join(totals, [FILE, "r"], "left_anti").groupBy(FILE, "c").agg(F.avg(F.col("v").isNotNull().cast("double")).alias("share"))
    out = named.join(shares, [FILE, "c"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return out.select(FILE, "c", "header_text", F.when(F.col("share") >= threshold, "value").otherwise("dimension").alias("kind"), "share")


def is_total(outline: Column, others: Sequence[Column], labels: Sequence[str]) -> Column:
    """A total word in the outline column with every other dimension blank."""
    out = F.coalesce(outline.rlike(total_pattern(labels)), F.lit(False))
    for o in others:
        out = out & is_blank(o)
    return out


def total_row(rows: DataFrame, period: str, amount: str) -> DataFrame:
    """(source_file, period, total) of the last total row of each file; ``rows`` is (source_file, r, is_total, period, amount)."""
    totals = rows.where("is_total").withColumn("_last", F.max("r").over(Window.partitionBy(FILE)))
    return totals.where("r = _last").where(F.col(amount).isNotNull()).select(FILE, period, F.col(amount).alias("total"))


def body_filter(rows: DataFrame, dims: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows with a dimension and a value. A projection: no shuffle."""
    return rows.dropna(how="all", subset=list(dims)).dropna(how="all", subset=list(values))


def indent_levels(rows: DataFrame, label: str = "label", indent: str = "indent") -> DataFrame:
    """``rows`` with sub_level: the rank of a row's width, by indent attributes if the file has any, else by leading spaces."""
    spaces = F.length(F.regexp_extract(F.coalesce(F.col(label), F.lit("")), r"^(\s*)", 1))
    by_file = Window.partitionBy(FILE)
    width = F.when(F.max(indent).over(by_file) > 0, F.col(indent)).otherwise(spaces)
    return rows.withColumn("_w", width).withColumn("sub_level", F.dense_rank().over(by_file.orderBy("_w")) - 1).drop("_w")


def route_sheets(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """(source_file, hierarchical): whether the first column below the header has an indent or leading space."""
    first = cells.join(headers, FILE).where("r > header").groupBy(FILE, "c").agg(F.bool_or((F.col("indent") > 0) | ((F.col("kind") == "string") & F.col("str").rlike(r"^\s"))).alias("h"))
    return first.groupBy(FILE).agg(F.min_by("h", "c").alias("hierarchical"))


def harmonize(rows: DataFrame, first: str) -> DataFrame:
    """Flat rows take the hierarchy's columns: level 0, a leaf, its own path."""
    out = rows
    for name, (kind, default) in FLAT.items():
        have = F.col(name) if name in rows.columns else F.lit(None)
        out = out.withColumn(name, F.coalesce(have.cast(kind), F.expr(default).cast(kind)))
    return out.withColumn("path", F.coalesce(F.col("path") if "path" in rows.columns else F.lit(None), F.col(f"`{first}`").cast("string")))


def path_to_levels(rows: DataFrame, depth: int, prefix: str = "Level_", path: str = "path") -> DataFrame:
    """A column for each step of the path up to ``depth``; missing steps are null."""
    steps = F.split(F.col(path), " > ")
    return rows.withColumns({f"{prefix}{k}": F.try_element_at(steps, F.lit(k)) for k in range(1, depth + 1)})


def provenance(rows: DataFrame, file: Column, digest: Column, ingested_at: str) -> DataFrame:
    """The three columns of origin before all others; one stamp for the batch."""
    rest = [c for c in rows.columns if c not in (FILE, "source_sha256", "ingested_at")]
    return rows.select(file.alias(FILE), digest.alias("source_sha256"), F.lit(ingested_at).alias("ingested_at"), *[f"`{c}`" for c in rest])
