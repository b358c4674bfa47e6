"""From a folder of workbooks to tidy facts and findings: every operator of the report side as one plan over all files.

Everything stays long, by (source_file, r), until the declared levels are gathered by conditional aggregation, so files with
different columns go through one plan and nothing loops over files. A file that can't be read is a finding and stops no other.
Windows hold one sheet. ``ingest`` saves the register before it asks the gate, so members seen by a blocked batch can be
approved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.functions.text import is_blank, row_key
from tallyframe.operators import cells as ops
from tallyframe.operators import headers, members, outline, reconcile
from tallyframe.plans import report as rep
from tallyframe.plans.config import CLOSED, OBSERVED, REGISTRY, Declaration
from tallyframe.sources import xlsx

#: A sheet's indents have fewer levels than this.
DEPTH = 8
REGISTER = "level string, member string, approved boolean, approved_by string, approved_at string, first_seen string, parents map<string,bigint>"
_ABSENT = "\0"


def _file_errors(cells: DataFrame) -> DataFrame:
    return rep.findings(cells.where("kind = 'error'"), method=F.lit("file_error"), review_priority=F.lit(rep.HIGH), note=F.col("str"))


def _permitted(sheets: DataFrame, d: Declaration) -> DataFrame:
    """(source_file, name): levels that a file may lack, by its sheet's name or else by its own."""
    lists = [(k, list(v)) for k, v in d.allow_missing.items()]
    known = sheets.sparkSession.createDataFrame(lists, "k string, names array<string>")
    own = F.element_at(F.split("source_file", "/"), -1)
    by = lambda key, name: sheets.select("source_file", key.alias("k")).join(known, "k").select("source_file", F.col("names").alias(name))
    both = by(F.col("sheet_name"), "a").join(by(own, "b"), "source_file", "full_outer")
    return both.select("source_file", F.explode(F.coalesce("a", "b")).alias("name"))


def _judged(rows: DataFrame, d: Declaration, register: DataFrame) -> DataFrame:
    out = None
    for v in d.levels:
        seen = members.distinct_members(rows, [v.canonical])
        known = rows.sparkSession.createDataFrame([(v.canonical, x) for x in v.vocabulary], "level string, member string") if v.mode == CLOSED else members.approved_members(register, v.canonical)
        one = members.judge(seen, known, mode=v.mode, punctuation=v.punctuation, case=v.case, bootstrap=v.bootstrap, blank=d.blank_member, near=d.near_miss)
        out = one if out is None else out.unionByName(one)
    return out


def parse(cells: DataFrame, d: Declaration, register: DataFrame | None = None, ingested_at: str = "", keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, findings, judged members) of the cells of any number of files.

    ``keep`` may write a step's table and read it back; what several gates read is then computed once.
    """
    spark, levels = cells.sparkSession, list(d.names)
    register = register if register is not None else spark.createDataFrame([], REGISTER)
    cells = keep(cells, "cells")
    good = cells.where("kind <> 'error'")
    sheets = good.select("source_file", "source_sha256", "sheet_name").distinct()
    top = keep(ops.header_row(good), "top")
    columns = ops.classify_columns(good, top, d.total_labels, d.value_threshold).withColumnRenamed("kind", "column_kind")
    resolved = headers.resolve_headers(
        columns.select("source_file", F.col("c").alias("pos"), F.col("header_text").alias("header")), {v.canonical: v.aliases for v in d.levels},
        fuzzy=d.fuzzy, accept=d.accept, review=d.review, near=d.near_miss, prefixes=d.prefixes,
    )
    resolved = keep(headers.header_collisions(resolved), "resolved")
    named = columns.join(resolved.select("source_file", F.col("pos").alias("c"), "resolved_name"), ["source_file", "c"])
    first = Window.partitionBy("source_file")
    named = named.withColumn("outline_c", F.min(F.when(F.col("column_kind") == "dimension", F.col("c"))).over(first))
    named = keep(named, "named")
    body = ops.value(good).join(top, "source_file").where("r > header").join(named, ["source_file", "c"])

    dims = body.where("column_kind = 'dimension'")
    is_outline, text = F.col("c") == F.col("outline_c"), F.col("str")
    rows = dims.groupBy("source_file", "r").agg(
        *[F.max(F.when(F.col("resolved_name") == v, F.when(is_outline, F.trim(text)).otherwise(text))).alias(v) for v in levels],
        F.max(F.when(is_outline, text)).alias("_label"),
        F.coalesce(F.max(F.when(is_outline, F.col("indent"))), F.lit(0)).alias("_indent"),
        F.count_if(~is_outline & ~is_blank(text)).alias("_others"),
    )
    rows = ops.indent_levels(rows, "_label", "_indent").withColumn("is_total", ops.is_total(F.col("_label"), [], d.total_labels) & (F.col("_others") == 0))
    rows = keep(rows, "rows")
    amounts = body.where("column_kind = 'value' AND v IS NOT NULL").select("source_file", "r", F.col("resolved_name").alias(d.var_name), F.col("v").alias(d.value_name))
    amounts = keep(amounts, "amounts")
    totals = ops.total_row(amounts.join(rows.where("is_total").select("source_file", "r", "is_total"), ["source_file", "r"]), d.var_name, d.value_name)
    rows = rows.where("NOT is_total").join(amounts.select("source_file", "r").distinct(), ["source_file", "r"], "left_semi")

    judged = keep(_judged(rows, d, register), "judged")
    rows = members.write_back(rows, judged, levels)
    # A level that a file lacks is no blank of its rows.
    present = named.where("column_kind = 'dimension'").select("source_file", F.col("resolved_name").alias("name"))
    have = present.groupBy("source_file").agg(F.collect_set("name").alias("_have"))
    rows = rows.join(have, "source_file")
    rows = rows.withColumns({v: F.when(F.array_contains("_have", v), F.col(f"`{v}`")).otherwise(_ABSENT) for v in levels})
    rows = keep(outline.fill_blanks(rows, levels), "filled")
    blanks = outline.blank_findings(rows)
    permitted = _permitted(sheets, d)
    allowed = permitted.groupBy("source_file").agg(F.collect_set("name").alias("_allowed"))
    rows = rows.join(allowed, "source_file", "left")
    may = lambda v: F.coalesce(F.array_contains("_allowed", v), F.lit(False))
    nulled = F.array_join(F.array_compact(F.array(*[F.when((F.col(f"`{v}`") == _ABSENT) & may(v), F.lit(v)) for v in levels])), ", ")
    rows = rows.withColumn("nulled_levels", nulled)
    rows = rows.withColumns({v: F.when(F.col(f"`{v}`") != _ABSENT, F.col(f"`{v}`")).when((F.col(f"`{v}`") == _ABSENT) & may(v), reconcile.OVERRIDDEN_VALUE) for v in levels})
    rows = rows.withColumn("label", F.coalesce(F.col(f"`{levels[0]}`"), F.trim("_label")))
    rows = outline.lineage(keep(outline.parent_leaf(rows), "leaves"), DEPTH)

    meta = ops.metadata_block(good, top, d.scan_rows)
    fields = [F.max(F.when(F.lower(F.trim("label")) == f.strip().rstrip(":").lower(), F.col("value"))).alias("meta_" + "_".join(f.strip().rstrip(":").lower().split())) for f in d.declared_fields]
    origin = sheets.select("source_file", "source_sha256", F.lit(ingested_at).alias("ingested_at"))
    if fields:
        origin = origin.join(meta.groupBy("source_file").agg(*fields), "source_file", "left")
    facts = rows.select("source_file", "r", *[F.col(f"`{v}`") for v in levels], "nulled_levels", "sub_level", "is_parent", "is_leaf", "parent_label", "path").join(amounts, ["source_file", "r"])
    facts = origin.join(facts, "source_file").drop("r")
    facts = keep(facts.withColumn("row_key", row_key("source_sha256", *levels, d.var_name)), "facts")

    gates = [
        _file_errors(cells),
        rep.findings(resolved, source_header=F.col("header")),
        reconcile.metadata_gate(meta, sheets, d.declared_fields, d.required_fields) if d.declared_fields else None,
        members.member_findings(judged),
        blanks,
        reconcile.structural_gate(present, levels, permitted),
        rep.findings(reconcile.null_levels(facts, levels), source_header=F.col("level"), resolved_name=F.col("level"), note=F.concat(F.col("n_null").cast("string"), F.lit(" null values"))),
    ]
    for v in d.levels:
        if v.mode == OBSERVED:
            near = reconcile.near_duplicates(judged.where(F.col("level") == v.canonical).select("level", F.col("value").alias("member")))
            gates.append(rep.findings(near, source_header=F.col("level"), resolved_name=F.col("folded"), method=F.lit("member_near_duplicate"), review_priority=F.lit(rep.HIGH), note=F.col("members")))
    if d.validate_totals:
        none = sheets.select("source_file").join(totals.select("source_file").distinct(), "source_file", "left_anti")
        gates.append(rep.findings(none, method=F.lit("reconciliation_no_total"), review_priority=F.lit(rep.HIGH)))
        with_totals = facts.join(totals.select("source_file").distinct(), "source_file", "left_semi")
        off = reconcile.totals_against_leaves(with_totals, totals, d.var_name, d.value_name, d.tolerance)
        gates.append(rep.findings(off, resolved_name=F.col(d.var_name), note=F.concat_ws(" against ", F.col("leaf_sum").cast("string"), F.col("total").cast("string"))))
    return facts, rep.full_report(*[g for g in gates if g is not None]), judged


def load_register(spark: SparkSession, path: str | None) -> DataFrame:
    """The register saved at ``path``; an empty one if there is none."""
    if path is None:
        return spark.createDataFrame([], REGISTER)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], REGISTER)
    return spark.read.schema(REGISTER).parquet(path)


def save_register(register: DataFrame, path: str) -> None:
    """Written beside the old register and put in its place when it is whole; it may be read from ``path`` itself."""
    spark = register.sparkSession
    register.coalesce(1).write.mode("overwrite").parquet(f"{path}.new")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p(path), True)
    if not fs.rename(p(f"{path}.new"), p(path)):
        raise OSError(f"the register could not be put in place at {path}")


def ingest(
    spark: SparkSession, path: str, d: Declaration, *, ingested_at: str, out: str | None = None, register_path: str | None = None, raise_on_fail: bool = True,
    sheet: str | None = None, parser: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(facts, findings) of the workbooks in a folder; raises LoadBlocked if a finding blocks.

    ``out`` gets ingested_data and audit_report as Parquet and review_high.csv, also for a blocked batch, and the steps between. ``parser`` replaces
    ``parse``: from cells to facts and findings.
    """
    cells = xlsx.scan_cells(spark, path, sheet)
    if parser:
        facts, report = parser(cells)
        judged = None
    else:
        register = load_register(spark, register_path)

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{out}/steps/{name}")
            return spark.read.schema(df.schema).parquet(f"{out}/steps/{name}")

        facts, report, judged = parse(cells, d, register, ingested_at, *([keep] if out else []))
    if judged is not None and register_path and any(v.mode == REGISTRY for v in d.levels):
        save_register(members.registry_after(register, judged, ingested_at).select(*register.columns), register_path)
    if out:
        facts.write.mode("overwrite").parquet(f"{out}/ingested_data")
        report.write.mode("overwrite").parquet(f"{out}/audit_report")
        facts, report = spark.read.schema(facts.schema).parquet(f"{out}/ingested_data"), spark.read.schema(report.schema).parquet(f"{out}/audit_report")
        rep.review_items(report).write.mode("overwrite").option("header", True).csv(f"{out}/review_high.csv")
    rep.load_gate(report, raise_on_fail)
    return facts, report


def write_variance(out: str, **tables: DataFrame) -> None:
    """Each table under its name (variance_stacked, variance_compiled, seam_check), as Parquet."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
