"""Queries for headers, members, gates, cells and layouts over the star tables, and the SQL with the same rows."""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import functions as F

from tallyframe import queries as base
from tallyframe.functions import members as fm
from tallyframe.operators import cells, headers, layout, members, outline, reconcile
from tallyframe.plans import report as rep
from tallyframe.plans.staged import KEY, PERIOD, VALUE
from tallyframe.sources import xlsx

LICENCE = {"punctuation": True, "case": True}
TOTALS = ("total", "grand total", "totals")


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dirty(spark, sf_dir):
    """Segments with blanks, case, printed blanks and one unknown member."""
    k, s = F.col("c_custkey"), F.col("c_mktsegment")
    dirty = F.when(k % 7 == 0, F.concat(s, F.lit(" "))).when(k % 11 == 0, F.lower(s)).when(k % 13 == 0, "( Blank)").when(k % 17 == 0, "(Blank)").when(k % 19 == 0, "Zebra  farms").otherwise(s)
    return _t(spark, sf_dir, "customer").select(F.lit("f").alias("source_file"), dirty.alias("Service"))


def _known(spark, sf_dir):
    return _t(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'").select(F.lit("Service").alias("level"), F.col("c_mktsegment").alias("member")).distinct()


def _judged(spark, sf_dir, mode):
    rows = members.distinct_members(_dirty(spark, sf_dir), ["Service"])
    return members.judge(rows, _known(spark, sf_dir), mode=mode, **LICENCE)


def members_closed(spark, sf_dir):
    judged = _judged(spark, sf_dir, "closed")
    out = members.write_back(_dirty(spark, sf_dir).withColumn("raw", F.col("Service")), judged, ["Service"])
    return out.groupBy("raw", F.col("Service").alias("value")).agg(F.count("*").alias("n")).join(judged.select(F.col("member").alias("raw"), "method", "review_priority"), "raw")


def members_registry(spark, sf_dir):
    return _judged(spark, sf_dir, "registry").select("member", "value", "method", "review_priority")


def members_observed(spark, sf_dir):
    return _judged(spark, sf_dir, "observed").select("member", "value")


def nearest_member(spark, sf_dir):
    return members.member_findings(_judged(spark, sf_dir, "closed")).where("method = 'member_undeclared'")


def heal_universal(spark, sf_dir):
    names = _t(spark, sf_dir, "part").select("p_name").distinct()
    return names.select("p_name", fm.heal_universal(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("​ \t")), F.lit("﻿ "))).alias("healed"))


def heal_licensed(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_brand").distinct().select("p_brand", fm.member_key(F.replace("p_brand", F.lit("#"), F.lit("-_#.")), **LICENCE).alias("key"))


def fuzzy_ratio(spark, sf_dir):
    pairs = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return pairs.select("n_name", "r_name", fm.fuzzy_ratio(F.col("n_name"), F.col("r_name")).alias("ratio"))


def blank_literal(spark, sf_dir):
    return _dirty(spark, sf_dir).select(members.blank_literal(F.col("Service")).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def cardinality_drift(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    rows = members.distinct_members(part.select(F.lit("f").alias("source_file"), "p_brand", "p_type", "p_size"), ["p_brand", "p_type", "p_size"])
    return members.cardinality_drift(rows, spark.createDataFrame([("p_brand", 3), ("p_type", 0), ("p_size", 50)], "level string, cardinality long"))


def _register(spark, sf_dir):
    rows = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where("n_nationkey % 2 = 0")
    parent = F.when(F.col("n_nationkey") % 3 == 0, "ELSEWHERE").otherwise(F.col("r_name"))
    return rows.select(F.lit("Nation").alias("level"), F.col("n_name").alias("member"), (F.col("n_nationkey") < 12).alias("approved"), F.lit(None).cast("string").alias("approved_by"), F.create_map(parent, F.lit(1).cast("long")).alias("parents"))


def parent_change(spark, sf_dir):
    pairs = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.lit("Nation").alias("level"), F.col("n_name").alias("member"), F.col("r_name").alias("parent"))
    return members.parent_change(pairs, _register(spark, sf_dir))


def registry_pending(spark, sf_dir):
    return members.pending_members(_register(spark, sf_dir))


def registry_approve(spark, sf_dir):
    return members.approve_members(_register(spark, sf_dir), "Nation", approver="board").select("member", "approved", "approved_by")


def license_check(spark, sf_dir):
    brand = F.when(F.col("p_partkey") % 3 == 0, F.lower("p_brand")).otherwise(F.col("p_brand"))
    return members.license_check(_t(spark, sf_dir, "part").select(F.lit("Project").alias("level"), brand.alias("member")))


def resolve_headers(spark, sf_dir):
    raw = F.concat(F.lit("Sum of "), F.initcap("r_name"), F.when(F.col("r_regionkey") % 2 == 1, "s").otherwise(""))
    rows = _t(spark, sf_dir, "region").select(F.lit("f").alias("source_file"), F.col("r_regionkey").alias("pos"), raw.alias("header"))
    return headers.header_collisions(headers.resolve_headers(rows, {"Asia": ["Far East"], "Europe": ["EU"], "America": ["Americas"]}, prefixes=("sum of",)))


def header_collisions(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    rows = n.select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("n_nationkey").alias("pos"), F.col("n_name").alias("header"), F.substring("n_name", 1, 1).alias("resolved_name"), F.lit("fuzzy").alias("method"), F.lit("x").alias("matched_against"), (F.col("n_nationkey") % 3 / 4).alias("confidence"), F.lit("OK").alias("review_priority"), F.lit("").alias("note"))
    return headers.header_collisions(rows).select("source_file", "header", "resolved_name", "method", "review_priority")


def _present(spark, sf_dir):
    """Dimensions by file: a file for each region, with the levels that its nations' numbers name."""
    names = F.array(*map(F.lit, (*KEY, "Extra")))
    return _t(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("source_file"), F.element_at(names, (F.col("n_nationkey") % 6 + 1).cast("int")).alias("name"), "n_nationkey")


def _structure(spark, sf_dir):
    permitted = _t(spark, sf_dir, "region").where("r_regionkey < 2").select(F.col("r_regionkey").cast("string").alias("source_file"), F.explode(F.array(F.lit("Project"), F.lit("Variant"))).alias("name"))
    return reconcile.structural_gate(_present(spark, sf_dir).select("source_file", "name").distinct(), KEY, permitted)


def structural_gate(spark, sf_dir):
    return _structure(spark, sf_dir).select("source_file", "resolved_name", "method", "review_priority")


def overrides(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("Service"))
    return reconcile.apply_levels(rows, ("DEPT", "Service", "Variant"), permitted=("Variant",))


def hierarchy_audit(spark, sf_dir):
    rows = _present(spark, sf_dir).select("source_file", F.col("name").alias("resolved_name"), F.concat(F.lit("h"), F.col("n_nationkey").cast("string")).alias("source_header"), F.col("n_nationkey").alias("pos"))
    return headers.hierarchy_audit(rows, KEY)


def _report(spark, sf_dir):
    recon = base.recon_gate(spark, sf_dir)
    return rep.full_report(_structure(spark, sf_dir), rep.findings(recon, resolved_name=F.col(PERIOD)))


def full_report(spark, sf_dir):
    return _report(spark, sf_dir).select("source_file", "resolved_name", "method", "review_priority")


def findings_by_method(spark, sf_dir):
    return rep.findings_by_method(_report(spark, sf_dir))


def review_items(spark, sf_dir):
    return rep.review_items(_report(spark, sf_dir)).select("source_file", "resolved_name", "method")


def override_items(spark, sf_dir):
    return rep.review_items(_report(spark, sf_dir), rep.OVERRIDDEN).select("source_file", "resolved_name", "method")


def load_gate(spark, sf_dir):
    return rep.load_gate(_report(spark, sf_dir), raise_on_fail=False)[1].groupBy("source_file").agg(F.count("*").alias("n_high"))


def metadata_gate(spark, sf_dir):
    r = _t(spark, sf_dir, "region").withColumn("source_file", F.col("r_regionkey").cast("string"))
    k = F.col("r_regionkey")
    pair = lambda label, value: F.struct(F.lit(label).alias("label"), value.alias("value"))
    rows = r.select("source_file", F.inline(F.array(pair("report", F.when(k != 3, F.when(k % 2 == 0, F.col("r_name")).otherwise("other"))), pair("Team", F.when(k == 1, "")), pair("Odd", F.when(k == 2, "v")))))
    return reconcile.metadata_gate(rows.where("value IS NOT NULL"), r.select("source_file", F.col("r_name").alias("sheet_name")), ("Report", "Team"), ("Report",)).select("source_file", "source_header", "method", "review_priority")


def _books(spark, sf_dir):
    """Workbooks (path, digest, content), one for each region: metadata, header, nations and a total."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n_nationkey")
        rows = [["Report:", str(group["n_regionkey"].iloc[0])], [], ["Name", "Key", "Remark"]]
        rows += [[("  " if k % 2 else "") + name, int(k), "x"] for name, k in zip(group["n_name"], group["n_nationkey"], strict=True)]
        rows.append(["Grand total", int(group["n_nationkey"].sum())])
        out = io.BytesIO()
        xlsx.write_book(out, {"Sheet": rows})
        return pd.DataFrame({"path": [str(group["n_regionkey"].iloc[0])], "digest": ["-"], "content": [out.getvalue()]})

    return _t(spark, sf_dir, "nation").groupBy("n_regionkey").applyInPandas(build, "path string, digest string, content binary")


def _cells(spark, sf_dir):
    return _books(spark, sf_dir).mapInPandas(xlsx._parse_files(None), xlsx.CELLS)


def scan_cells(spark, sf_dir):
    return _cells(spark, sf_dir).groupBy("source_file", "kind").agg(F.count("*").alias("n"), F.sum("num").alias("total"))


def header_row(spark, sf_dir):
    return cells.header_row(_cells(spark, sf_dir))


def metadata_block(spark, sf_dir):
    c = _cells(spark, sf_dir)
    return cells.metadata_block(c, cells.header_row(c)).select("source_file", cells.meta_column(F.col("label")).alias("field"), "value")


def classify_columns(spark, sf_dir):
    c = _cells(spark, sf_dir)
    return cells.classify_columns(c, cells.header_row(c), TOTALS)


def route_sheets(spark, sf_dir):
    c = _cells(spark, sf_dir)
    return cells.route_sheets(c, cells.header_row(c))


def _labelled(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    label = F.when(F.col("n_nationkey") % 4 == 3, F.concat(F.lit("Sub Total "), "n_name")).when(F.col("n_nationkey") % 5 == 4, "Grand  Total").otherwise(F.col("n_name"))
    return n.select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("n_nationkey").alias("r"), label.alias("label"), F.when(F.col("n_nationkey") % 3 == 0, "x").alias("other"), F.lit("FY1").alias("period"), (F.col("n_nationkey") * 2).alias("amount"))


def total_rows(spark, sf_dir):
    return _labelled(spark, sf_dir).select("source_file", "r", cells.is_total(F.col("label"), [F.col("other")], TOTALS).alias("is_total"))


def total_row(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("is_total", cells.is_total(F.col("label"), [F.col("other")], TOTALS))
    return cells.total_row(rows, "period", "amount")


def indent_levels(spark, sf_dir):
    rows = base._outline(spark, sf_dir).select("source_file", "r", F.concat(F.repeat(F.lit(" "), F.col("sub_level") * 4), "label").alias("label"), F.lit(0).alias("indent"))
    return cells.indent_levels(rows).select("r", "sub_level")


def body_filter(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("d"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("v"))
    return cells.body_filter(rows, ["d"], ["v"]).select("c_custkey")


def harmonize(spark, sf_dir):
    return cells.harmonize(_t(spark, sf_dir, "nation").select("n_name", "n_nationkey"), "n_name")


def path_to_levels(spark, sf_dir):
    return cells.path_to_levels(outline.lineage(base._outline(spark, sf_dir), depth=2), 3).select("r", "Level_1", "Level_2", "Level_3")


def provenance(spark, sf_dir):
    rows = _t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("source_file"))
    return cells.provenance(rows, F.lit("a.xlsx"), F.substring(F.sha2("source_file", 256), 1, 16), "2024-01-01T00:00:00Z")


def batch_union(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    a, b = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), o.where("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey")
    return a.unionByName(b, allowMissingColumns=True).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("o_totalprice").alias("priced"))


def report_outline(spark, sf_dir):
    return layout.outline(base.variance_window(spark, sf_dir), KEY, base.WINDOW)


def report_columnar(spark, sf_dir):
    return layout.columnar(base.variance_window(spark, sf_dir), KEY, base.WINDOW)


QUERIES = (
    members_closed, members_registry, members_observed, nearest_member, heal_universal, heal_licensed, fuzzy_ratio, blank_literal, cardinality_drift, parent_change,
    registry_pending, registry_approve, license_check, resolve_headers, header_collisions, structural_gate, overrides, hierarchy_audit, full_report, findings_by_method,
    review_items, override_items, load_gate, metadata_gate, scan_cells, header_row, metadata_block, classify_columns, route_sheets, total_rows, total_row, indent_levels,
    body_filter, harmonize, path_to_levels, provenance, batch_union, report_outline, report_columnar,
)


def queries():
    return {q.__name__: q for q in QUERIES}


_DIRTY = """WITH d AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || ' ' WHEN c_custkey % 11 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 13 = 0 THEN '( Blank)'
  WHEN c_custkey % 17 = 0 THEN '(Blank)' WHEN c_custkey % 19 = 0 THEN 'Zebra  farms' ELSE c_mktsegment END AS raw FROM customer),
 h AS (SELECT raw, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS healed, count(*) AS n FROM d GROUP BY ALL),
 k AS (SELECT DISTINCT c_mktsegment AS canonical FROM customer WHERE c_mktsegment <> 'FURNITURE'),
 j AS (SELECT * FROM h LEFT JOIN k ON lower(healed) = lower(canonical))
"""
_METHOD = "CASE WHEN lower(healed) = '(blank)' THEN 'member_blank_literal' WHEN canonical IS NULL THEN '{new}' WHEN canonical <> raw THEN 'member_normalized' END AS method, CASE WHEN lower(healed) = '(blank)' THEN 'OK' WHEN canonical IS NULL THEN 'HIGH' WHEN canonical <> raw THEN 'OK' END AS review_priority"
_VALUE = "CASE WHEN lower(healed) = '(blank)' THEN 'NA - Not Provided' ELSE coalesce(canonical, {other}) END AS value"
_N = "nation JOIN region ON n_regionkey = r_regionkey"
_LEVELS = "(VALUES " + ", ".join(f"({k}, '{c}')" for k, c in enumerate(KEY)) + ") l(k, name)"
_P = f"""WITH p AS (SELECT n_regionkey::VARCHAR AS source_file, coalesce(l.name, 'Extra') AS name, n_nationkey FROM nation LEFT JOIN {_LEVELS} ON n_nationkey % 6 = l.k)"""
_S = f""", s AS (SELECT f.source_file, l.name AS resolved_name, CASE WHEN f.source_file < '2' AND l.name IN ('Project', 'Variant') THEN 'hierarchy_overridden' ELSE 'hierarchy_missing' END AS method,
   CASE WHEN f.source_file < '2' AND l.name IN ('Project', 'Variant') THEN 'OVERRIDDEN' ELSE 'HIGH' END AS review_priority
   FROM (SELECT DISTINCT source_file FROM p) f CROSS JOIN {_LEVELS} WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source_file = f.source_file AND p.name = l.name)
   UNION ALL SELECT DISTINCT source_file, 'Extra', 'hierarchy_unexpected', 'HIGH' FROM p WHERE name = 'Extra')"""
_R = _S + """, r AS (SELECT * FROM s UNION ALL SELECT kind, 'FY1996', 'reconciliation_mismatch', 'HIGH' FROM (
   SELECT DISTINCT CASE WHEN l_linestatus = 'F' THEN 'Cost' ELSE 'Budget' END AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1996))"""
_LABELLED = """WITH t AS (SELECT n_regionkey::VARCHAR AS source_file, n_nationkey AS r, (n_nationkey % 4 = 3 OR n_nationkey % 5 = 4) AND n_nationkey % 3 <> 0 AS is_total FROM nation)"""


def _money(c: str) -> str:
    return f"CASE WHEN \"{c}\" < 0 THEN format('({{:,}})', -\"{c}\") ELSE format('{{:,}}', \"{c}\") END AS \"{c}\""


def _layout_sql() -> tuple[str, str]:
    labels, keys = (*base.WINDOW, "TOTAL"), ", ".join(f'"{c}"' for c in KEY)
    start = base._stack(False).replace(base._F, base._F.rstrip() + ", st AS (", 1) + ")"
    shown = ", ".join(map(_money, labels))
    tint = "CASE WHEN \"Measure\" = 'Variance' THEN CASE WHEN \"TOTAL\" > 0 THEN 'green' WHEN \"TOTAL\" < 0 THEN 'red' ELSE 'grey' END END AS colour"
    ordinal = "CASE \"Measure\" WHEN 'Budget' THEN 1 WHEN 'Cost' THEN 2 ELSE 3 END"
    label_columns = ", ".join(f"CASE WHEN \"Measure\" = 'Budget' THEN \"{c}\" ELSE '' END AS label_{k}" for k, c in enumerate(KEY))
    columnar = start + " SELECT " + " || '|' || ".join(f'"{c}"' for c in KEY) + f' AS key, {ordinal} AS ord, {label_columns}, "Measure", {shown}, {tint} FROM st'
    lags = ", ".join(f'lag("{c}") OVER w AS p{k}' for k, c in enumerate(KEY))
    blanks = ", ".join(f"'' AS \"{c}\"" for c in labels)
    heads = " UNION ALL ".join(
        f"SELECT {keys}, {k} AS seq, {k} AS lv, \"{c}\" AS label, {blanks}, NULL AS colour FROM k WHERE NOT coalesce(" + " AND ".join(f'p{i} = "{d}"' for i, d in enumerate(KEY[: k + 1])) + ", false)" for k, c in enumerate(KEY)
    )
    out = start + f', k AS (SELECT {keys}, {lags} FROM (SELECT DISTINCT {keys} FROM st) WINDOW w AS (PARTITION BY "DEPT" ORDER BY {keys})), a AS ({heads} UNION ALL SELECT {keys}, 5 + {ordinal}, 5, "Measure", {shown}, {tint} FROM st)'
    out += f' SELECT "DEPT" AS section, (row_number() OVER (PARTITION BY "DEPT" ORDER BY {keys}, seq))::INT AS ord, 3 + lv * 11 AS indent, label, ' + ", ".join(f'"{c}"' for c in labels) + ", colour, lv = 0 AS tinted FROM a"
    return out, columnar


def oracle_sql() -> dict[str, str]:
    outlined, columnar = _layout_sql()
    pairs = f"SELECT n_name, n_nationkey, r_name FROM {_N}"
    name = "trim(regexp_replace(p_name, '\\s+', ' ', 'g'))"
    return {
        "members_closed": _DIRTY + f"SELECT raw, n, {_VALUE.format(other='raw')}, {_METHOD.format(new='member_undeclared')} FROM j",
        "members_registry": _DIRTY + f"SELECT raw AS member, {_VALUE.format(other='healed')}, {_METHOD.format(new='member_pending_approval')} FROM j",
        "members_observed": _DIRTY + "SELECT raw AS member, healed AS value FROM h",
        "heal_universal": f"SELECT DISTINCT p_name, {name} AS healed FROM part",
        "heal_licensed": "SELECT DISTINCT p_brand, lower(replace(p_brand, '-', '')) AS key FROM part",
        "blank_literal": _DIRTY + "SELECT CASE WHEN lower(healed) = '(blank)' THEN 'NA - Not Provided' ELSE raw END AS value, sum(n)::BIGINT AS n FROM h GROUP BY 1",
        "cardinality_drift": """WITH c AS (SELECT 'p_brand' AS level, 3::BIGINT AS cardinality, count(DISTINCT p_brand) AS n FROM part UNION ALL SELECT 'p_size', 50, count(DISTINCT p_size) FROM part)
SELECT level, cardinality, n, round_even(abs(n - cardinality)::DOUBLE / cardinality, 3) AS change, 'cardinality_drift' AS method, 'HIGH' AS review_priority FROM c WHERE abs(n - cardinality) > 0.25 * cardinality""",
        "parent_change": f"SELECT 'Nation' AS level, n_name AS member, r_name AS parent, 1::BIGINT AS n, 'member_parent_change' AS method, 'HIGH' AS review_priority FROM ({pairs}) WHERE n_nationkey % 6 = 0",
        "registry_pending": "SELECT 'Nation' AS level, n_name AS member FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey >= 12",
        "registry_approve": "SELECT n_name AS member, true AS approved, CASE WHEN n_nationkey >= 12 THEN 'board' END AS approved_by FROM nation WHERE n_nationkey % 2 = 0",
        "license_check": """WITH m AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) ELSE p_brand END AS member FROM part)
SELECT 'Project' AS level, lower(member) AS folded, string_agg(member, ', ' ORDER BY member) AS members, count(*) AS n FROM m GROUP BY 2 HAVING count(*) > 1""",
        "header_collisions": """WITH c AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey, substr(n_name, 1, 1) ORDER BY n_nationkey % 3 DESC, n_nationkey) AS k FROM nation)
SELECT n_regionkey::VARCHAR AS source_file, n_name AS header, CASE WHEN k = 1 THEN substr(n_name, 1, 1) ELSE n_name END AS resolved_name, CASE WHEN k = 1 THEN 'fuzzy' ELSE 'collision_reverted' END AS method, CASE WHEN k = 1 THEN 'OK' ELSE 'HIGH' END AS review_priority FROM c""",
        "structural_gate": _P + _S + " SELECT * FROM s",
        "overrides": "SELECT NULL::VARCHAR AS \"DEPT\", c_mktsegment AS \"Service\", 'NA - Overridden' AS \"Variant\", 'Variant' AS nulled_levels, c_custkey FROM customer",
        "hierarchy_audit": _P + f" SELECT f.source_file, (l.k + 1)::INT AS business_level, l.name AS canonical, 'h' || min(p.n_nationkey) AS source_header, CASE WHEN min(p.n_nationkey) IS NULL THEN 'MISSING' ELSE 'mapped' END AS status FROM (SELECT DISTINCT source_file FROM p) f CROSS JOIN {_LEVELS} LEFT JOIN p ON p.source_file = f.source_file AND p.name = l.name GROUP BY 1, 2, 3",
        "full_report": _P + _R + " SELECT * FROM r",
        "findings_by_method": _P + _R + " SELECT method, review_priority, count(*) AS n FROM r GROUP BY 1, 2",
        "review_items": _P + _R + " SELECT source_file, resolved_name, method FROM r WHERE review_priority = 'HIGH'",
        "override_items": _P + _R + " SELECT source_file, resolved_name, method FROM r WHERE review_priority = 'OVERRIDDEN'",
        "load_gate": _P + _R + " SELECT source_file, count(*) AS n_high FROM r WHERE review_priority = 'HIGH' GROUP BY 1",
        "metadata_gate": """SELECT r_regionkey::VARCHAR AS source_file, 'Report' AS source_header, CASE WHEN r_regionkey = 3 THEN 'metadata_missing' ELSE 'report_name_mismatch' END AS method, 'HIGH' AS review_priority FROM region WHERE r_regionkey % 2 = 1
UNION ALL SELECT r_regionkey::VARCHAR, 'Team', CASE WHEN r_regionkey = 1 THEN 'metadata_empty' ELSE 'metadata_absent' END, 'OK' FROM region
UNION ALL SELECT '2', 'odd', 'metadata_unexpected', 'HIGH' FROM region WHERE r_regionkey = 2""",
        "scan_cells": """SELECT n_regionkey::VARCHAR AS source_file, 'number' AS kind, count(*) + 1 AS n, 2.0 * sum(n_nationkey)::DOUBLE AS total FROM nation GROUP BY 1
UNION ALL SELECT n_regionkey::VARCHAR, 'string', 2 * count(*) + 6, NULL FROM nation GROUP BY 1""",
        "header_row": "SELECT DISTINCT n_regionkey::VARCHAR AS source_file, 2::INT AS header FROM nation",
        "metadata_block": "SELECT DISTINCT n_regionkey::VARCHAR AS source_file, 'meta_report' AS field, n_regionkey::VARCHAR AS value FROM nation",
        "classify_columns": "SELECT DISTINCT n_regionkey::VARCHAR AS source_file, c::INT AS c, h AS header_text, CASE WHEN c = 1 THEN 'value' ELSE 'dimension' END AS kind, CASE WHEN c = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS share FROM nation CROSS JOIN (VALUES (0, 'Name'), (1, 'Key'), (2, 'Remark')) v(c, h)",
        "route_sheets": "SELECT n_regionkey::VARCHAR AS source_file, bool_or(n_nationkey % 2 = 1) AS hierarchical FROM nation GROUP BY 1",
        "total_rows": _LABELLED + " SELECT * FROM t",
        "total_row": _LABELLED + " SELECT source_file, 'FY1' AS period, 2 * max(r) AS total FROM t WHERE is_total GROUP BY 1",
        "indent_levels": base._OUTLINE + "SELECT r, lv::INT AS sub_level FROM o",
        "body_filter": "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey % 5 <> 0",
        "harmonize": "SELECT n_name, n_nationkey, 0::INT AS sub_level, false AS is_parent, true AS is_leaf, NULL::VARCHAR AS parent_label, n_name AS path FROM nation",
        "path_to_levels": base._OUTLINE + ", p AS (SELECT *, last_value(CASE WHEN lv = 0 THEN label END IGNORE NULLS) OVER (ORDER BY r) AS top FROM o) SELECT r, top AS \"Level_1\", CASE WHEN lv = 1 THEN label END AS \"Level_2\", NULL::VARCHAR AS \"Level_3\" FROM p",
        "provenance": "SELECT 'a.xlsx' AS source_file, substr(sha256(s_name), 1, 16) AS source_sha256, '2024-01-01T00:00:00Z' AS ingested_at, s_suppkey FROM supplier",
        "batch_union": "SELECT nullif(o_orderstatus, 'F') AS o_orderstatus, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS priced FROM orders GROUP BY 1",
        "report_outline": outlined,
        "report_columnar": columnar,
    }
