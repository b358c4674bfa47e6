"""Queries over the star tables, one for each operator, and the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import text as fn
from tallyframe.operators import outline, reconcile, variance
from tallyframe.plans import staged
from tallyframe.plans.staged import KEY, PERIOD, STREAM, VALUE

#: Fixed window of the report.
WINDOW = ("FY1995", "FY1996", "FY1997", "FY1998")
#: All periods of the star tables, for the SQL.
YEARS = (*WINDOW, "FY1999", "FY2000", "FY2001")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged.check_contract(staged.star_facts(spark, sf_dir))


def variance_compiled(spark, sf_dir):
    return variance.compiled(_facts(spark, sf_dir))


def variance_stacked(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    # The labels are asked of the orders alone: the join can't add one.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.lit("FY"), F.year("o_orderdate")).alias(PERIOD))
    return variance.stacked(facts, variance.periods(orders))


def variance_window(spark, sf_dir):
    return variance.stacked(_facts(spark, sf_dir), WINDOW)


def seam_check(spark, sf_dir):
    return variance.seam_check(_facts(spark, sf_dir))


def headline_totals(spark, sf_dir):
    return variance.headline_totals(_facts(spark, sf_dir))


def real_periods(spark, sf_dir):
    rows = staged.real_periods(staged.with_row_totals(_facts(spark, sf_dir)))
    return rows.groupBy(PERIOD, STREAM).agg(F.sum(VALUE).alias(VALUE), F.count("*").alias("n"))


def staged_contract(spark, sf_dir):
    return staged.contract_report(_facts(spark, sf_dir))


def identify_streams(spark, sf_dir):
    facts = _facts(spark, sf_dir).withColumn("source_file", F.concat(F.lower(STREAM), F.lit(".parquet")))
    return staged.identify_streams(facts)


def fy_order(spark, sf_dir):
    return variance.period_order(_facts(spark, sf_dir))


def row_key(spark, sf_dir):
    grain = _facts(spark, sf_dir).groupBy(*KEY, PERIOD, STREAM).agg(F.sum(VALUE).alias(VALUE))
    return grain.select(fn.row_key(STREAM, *KEY, PERIOD).alias("row_key"), VALUE)


def money_format(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", variance.money(F.when(F.col("c_custkey") % 7 != 0, F.round("c_acctbal"))).alias("shown"))


def to_number(spark, sf_dir):
    cents = F.round(F.abs("c_acctbal") * 100).cast("long")
    shown = F.concat(F.format_number(F.floor(cents / 100), 0), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    kind = F.col("c_custkey") % 5
    cell = F.when(kind == 0, F.concat(F.lit("("), shown, F.lit(")"))).when(kind == 1, F.concat(F.lit("$"), shown)).when(kind == 2, F.concat(F.lit(" -"), shown)).when(kind == 3, F.lit("n/a")).otherwise(shown)
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.round(fn.to_number(cell) * 100).alias("cents"))


def norm_header(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", fn.norm_header(F.concat(F.lit("  Sum of  "), F.upper("p_name"), F.lit(" ")), ("sum of", "count of")).alias("header"))


def near_duplicates(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    dirty = F.when(F.col("p_partkey") % 3 == 0, F.replace("p_brand", F.lit("#"), F.lit("-#"))).otherwise(F.col("p_brand"))
    return reconcile.near_duplicates(parts.select(F.lit("Project").alias("level"), dirty.alias("member")))


def unpivot_drop_nulls(spark, sf_dir):
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.expr("nullif(l_quantity, 1.0D)").alias("qty"), F.expr("nullif(l_tax, 0.0D)").alias("tax"))
    return wide.unpivot(["l_orderkey", "l_linenumber"], ["qty", "tax"], "Period", "Value").where("Value IS NOT NULL").groupBy("l_orderkey", "Period").agg(F.count("*").alias("n"))


def recon_gate(spark, sf_dir):
    """Leaf sums against totals that lack one part in FY1996."""
    facts = _facts(spark, sf_dir)
    leaves = facts.select(F.col(STREAM).alias("source_file"), PERIOD, VALUE)
    totals = facts.groupBy(F.col(STREAM).alias("source_file"), PERIOD).agg(F.sum(VALUE).alias("total"))
    totals = totals.select("source_file", PERIOD, (F.col("total") - F.when(F.col(PERIOD) == "FY1996", 5).otherwise(0)).alias("total"))
    return reconcile.totals_against_leaves(leaves, totals, PERIOD, VALUE, tolerance=1)


def dimension_gate(spark, sf_dir):
    facts = _facts(spark, sf_dir).withColumns({"Project": F.expr("nullif(Project, 'Brand#11')"), "source_file": F.concat(F.lower(STREAM), F.lit(".parquet"))})
    return reconcile.null_levels(facts, KEY)


def _outline(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_regionkey", "n_nationkey", F.col("n_name").alias("label"))
    r = spark.read.parquet(f"{sf_dir}/region.parquet")
    rows = n.select("*", F.lit(1).alias("sub_level")).unionByName(r.select(F.col("r_regionkey").alias("n_regionkey"), F.lit(-1).alias("n_nationkey"), F.col("r_name").alias("label"), F.lit(0).alias("sub_level")))
    return rows.select(F.lit("outline").alias("source_file"), (F.col("n_regionkey") * 1000 + F.col("n_nationkey")).alias("r"), "label", "sub_level")


def parent_leaf(spark, sf_dir):
    return outline.parent_leaf(_outline(spark, sf_dir)).select("r", "label", "is_parent", "is_leaf")


def lineage(spark, sf_dir):
    return outline.lineage(_outline(spark, sf_dir), depth=2).select("r", "label", "parent_label", "path")


def blank_fill(spark, sf_dir):
    rows = _outline(spark, sf_dir)
    code = F.when(F.col("r") % 5 < 3, F.concat(F.lit("c"), F.col("r").cast("string"))).when(F.col("r") % 5 == 3, F.lit(" \u00a0"))
    rows = rows.withColumns({"code": code, "label": F.when(F.col("r") % 2 == 0, F.col("label"))})
    out = outline.fill_blanks(rows, ["label", "code"])
    return out.select("r", "label", "code", F.array_join("filled", ",").alias("filled"), F.array_join("missing", ",").alias("missing"))


QUERIES = (
    variance_compiled, variance_stacked, variance_window, seam_check, headline_totals, real_periods, staged_contract, identify_streams, fy_order, row_key,
    money_format, to_number, norm_header, near_duplicates, unpivot_drop_nulls, recon_gate, dimension_gate, parent_leaf, lineage, blank_fill,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


_KEY = ", ".join(f'"{c}"' for c in KEY)
_F = """WITH f AS (
  SELECT r_name AS "DEPT", c_mktsegment AS "Service", l_returnflag AS "Variant", n_name AS "DEPT DESCRIPTION", p_brand AS "Project",
         'FY' || year(o_orderdate) AS "FiscalYear", CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS "Value",
         CASE WHEN l_linestatus = 'F' THEN 'Cost' ELSE 'Budget' END AS meta_report_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)
"""
_B = "coalesce(sum(\"Value\") FILTER (meta_report_type = 'Budget'), 0)::BIGINT"
_C = _B.replace("Budget", "Cost")
_PCT = "CASE WHEN c <> 0 THEN round_even((b - c) * 100.0::DOUBLE / c, 1) + 0.0::DOUBLE END"  # no negative zero


def _stack(all_periods: bool) -> str:
    where = "" if all_periods else " WHERE \"FiscalYear\" IN (" + ", ".join(f"'{p}'" for p in WINDOW) + ")"
    out = []
    for m, one in (("Budget", _B), ("Cost", _C), ("Variance", f"({_B} - {_C})")):
        cells = [(one.replace("FILTER (", f"FILTER (\"FiscalYear\" = '{p}' AND ")) + f' AS "{p}"' for p in (YEARS if all_periods else WINDOW)]
        out.append(f"SELECT {_KEY}, '{m}' AS \"Measure\", {', '.join(cells)}, {one} AS \"TOTAL\" FROM f{where} GROUP BY {_KEY}")
    return _F + " UNION ALL ".join(out)


_OUTLINE = """WITH o AS (
  SELECT n_regionkey * 1000 + n_nationkey AS r, n_name AS label, 1 AS lv FROM nation
  UNION ALL SELECT r_regionkey * 1000 - 1, r_name, 0 FROM region)
"""


def oracle_sql() -> dict[str, str]:
    grain = f'SELECT {_KEY}, "FiscalYear", meta_report_type, sum("Value")::BIGINT AS "Value" FROM f GROUP BY ALL'
    columns = (*KEY, PERIOD, VALUE, STREAM)
    joined = " || '|' || ".join(f"coalesce(\"{c}\", '~')" for c in (STREAM, *KEY, PERIOD))
    return {
        "variance_compiled": _F + f""", k AS (SELECT {_KEY}, {_B} AS b, {_C} AS c FROM f GROUP BY ALL
  UNION ALL SELECT 'GRAND TOTAL', '', '', '', '', {_B}, {_C} FROM f)
SELECT {_KEY}, b AS "Budget", c AS "Cost", b - c AS "Variance", {_PCT} AS "VarPct",
       CASE WHEN b > c THEN 'surplus' WHEN b < c THEN 'deficit' ELSE 'on-budget' END AS "Status" FROM k""",
        "variance_stacked": _stack(True),
        "variance_window": _stack(False),
        "seam_check": _F + f"SELECT {_KEY}, min(meta_report_type) || ' only' AS present_in FROM f GROUP BY {_KEY} HAVING count(DISTINCT meta_report_type) = 1",
        "headline_totals": _F + f', k AS (SELECT {_B} AS b, {_C} AS c FROM f) SELECT b AS "Budget", c AS "Cost", b - c AS "Variance", coalesce({_PCT}, 0) AS "VarPct" FROM k',
        "real_periods": _F + f', g AS ({grain}) SELECT "FiscalYear", meta_report_type, sum("Value")::BIGINT AS "Value", count(*) AS n FROM g GROUP BY ALL',
        "staged_contract": _F + " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS present, count(*) - count(\"{c}\") AS n_null, count(*) AS n_rows FROM f" for c in columns),
        "identify_streams": _F + "SELECT lower(meta_report_type) || '.parquet' AS source_file, 1::INT AS n_types, meta_report_type AS stream FROM f GROUP BY meta_report_type",
        "fy_order": _F + "SELECT DISTINCT \"FiscalYear\", regexp_replace(\"FiscalYear\", '[^0-9]', '', 'g')::INT AS ord FROM f",
        "row_key": _F + f', g AS ({grain}) SELECT substr(sha256({joined}), 1, 16) AS row_key, "Value" FROM g',
        "money_format": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '0' WHEN round(c_acctbal) < 0 THEN format('({:,})', abs(round(c_acctbal))::BIGINT) ELSE format('{:,}', round(c_acctbal)::BIGINT) END AS shown FROM customer",
        "to_number": "SELECT c_custkey, CASE c_custkey % 5 WHEN 3 THEN NULL WHEN 0 THEN -1 WHEN 2 THEN -1 ELSE 1 END * round(abs(c_acctbal) * 100)::DOUBLE AS cents FROM customer",
        "norm_header": "SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS header FROM part",
        "near_duplicates": """WITH m AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN replace(p_brand, '#', '-#') ELSE p_brand END AS member FROM part)
SELECT 'Project' AS level, lower(replace(member, '-', '')) AS folded, string_agg(member, ', ' ORDER BY member) AS members FROM m GROUP BY folded HAVING count(*) > 1""",
        "unpivot_drop_nulls": """SELECT l_orderkey, 'qty' AS "Period", count(*) AS n FROM lineitem WHERE l_quantity <> 1 GROUP BY l_orderkey
UNION ALL SELECT l_orderkey, 'tax', count(*) FROM lineitem WHERE l_tax <> 0 GROUP BY l_orderkey""",
        "recon_gate": _F + """SELECT meta_report_type AS source_file, "FiscalYear", sum("Value")::BIGINT AS leaf_sum, (sum("Value") - 5)::BIGINT AS total, 'reconciliation_mismatch' AS method, 'HIGH' AS review_priority
FROM f WHERE "FiscalYear" = 'FY1996' GROUP BY ALL""",
        "dimension_gate": _F + "SELECT lower(meta_report_type) || '.parquet' AS source_file, 'Project' AS level, count(*) AS n_null, 'dimension_null' AS method, 'HIGH' AS review_priority FROM f WHERE \"Project\" = 'Brand#11' GROUP BY 1",
        "parent_leaf": _OUTLINE + "SELECT r, label, coalesce(lead(lv) OVER w > lv, false) AS is_parent, NOT coalesce(lead(lv) OVER w > lv, false) AS is_leaf FROM o WINDOW w AS (ORDER BY r)",
        "lineage": _OUTLINE + """, p AS (SELECT *, last_value(CASE WHEN lv = 0 THEN label END IGNORE NULLS) OVER (ORDER BY r) AS top FROM o)
SELECT r, label, CASE WHEN lv = 1 THEN top END AS parent_label, CASE WHEN lv = 1 THEN top || ' > ' || label ELSE label END AS path FROM p""",
        "blank_fill": _OUTLINE + """, b AS (
  SELECT r, lv, CASE WHEN r % 2 = 0 THEN label END AS l, CASE WHEN r % 5 < 3 THEN 'c' || r END AS c FROM o),
u AS (SELECT *, last_value(l IGNORE NULLS) OVER (PARTITION BY lv ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ul,
             last_value(c IGNORE NULLS) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS uc FROM b),
x AS (SELECT *, l IS NULL AS gl, l IS NULL AND c IS NULL AS gc FROM u)
SELECT r, CASE WHEN gl THEN ul ELSE l END AS label, CASE WHEN gc THEN uc ELSE c END AS code,
       concat_ws(',', CASE WHEN gl AND ul IS NOT NULL THEN 'label' END, CASE WHEN gc AND uc IS NOT NULL THEN 'code' END) AS filled,
       concat_ws(',', CASE WHEN l IS NULL AND ul IS NULL THEN 'label' END, CASE WHEN c IS NULL AND (NOT gc OR uc IS NULL) THEN 'code' END) AS missing
FROM x""",
    }
