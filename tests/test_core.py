"""The report operators on small tables made by hand."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tallyframe.functions import text as fn
from tallyframe.operators import outline, reconcile, variance
from tallyframe.plans import staged

FACT = "`DEPT` string, `Service` string, `Variant` string, `DEPT DESCRIPTION` string, `Project` string, FiscalYear string, Value long, meta_report_type string"


def facts(spark, *rows):
    return spark.createDataFrame([(k, "s", "v", "d", p, fy, n, kind) for k, p, fy, n, kind in rows], FACT)


def test_variance_of_one_sided_and_null_keys(spark):
    df = facts(spark, ("A", "p", "FY25", 10, "Budget"), ("A", "p", "FY26", 30, "Cost"), ("B", "p", "FY25", 7, "Cost"), ("C", "p", "FY25", 5, "Budget"), ("D", None, "FY25", 99, "Cost"), ("A", "p", "Total Cost", 30, "Cost"))
    got = {r["DEPT"]: (r["Budget"], r["Cost"], r["Variance"], r["VarPct"], r["Status"]) for r in variance.compiled(df).collect()}
    assert got == {"A": (10, 30, -20, -66.7, "deficit"), "B": (0, 7, -7, -100.0, "deficit"), "C": (5, 0, 5, None, "surplus"), "GRAND TOTAL": (15, 37, -22, -59.5, "deficit")}
    assert variance.periods(df) == ["FY25", "FY26"]
    rows = {(r["DEPT"], r["Measure"]): (r["FY25"], r["FY26"], r["TOTAL"]) for r in variance.stacked(df, ["FY25", "FY26"]).collect()}
    assert rows["A", "Variance"] == (10, -30, -20) and rows["C", "Cost"] == (0, 0, 0) and len(rows) == 9
    assert {(r["DEPT"], r["present_in"]) for r in variance.seam_check(df).collect()} == {("B", "Cost only"), ("C", "Budget only"), ("D", "Cost only")}


def test_numbers(spark):
    cases = {"(948)": -948.0, "($948)": -948.0, "(1,234.5)": -1234.5, "( 5 )": -5.0, "-$5": -5.0, "+7": 7.0, ".5": 0.5, "1,2,3": 123.0, " 5": 5.0, "5.": None, "1e5": None, "12%": None, "": None, "n/a": None}
    got = {r[0]: r[1] for r in spark.createDataFrame([(c,) for c in cases], "c string").select("c", fn.to_number(F.col("c"))).collect()}
    assert got == cases


def test_outline(spark):
    rows = spark.createDataFrame([("f", 1, "A", 0), ("f", 2, "a1", 1), ("f", 3, "x", 2), ("f", 4, "B", 0), ("f", 5, "y", 2), ("f", 6, None, 2)], "source_file string, r long, label string, sub_level int")
    assert [r["path"] for r in outline.lineage(rows, 3).orderBy("r").collect()][:5] == ["A", "A > a1", "A > a1 > x", "B", "B > y"]
    assert [r["is_parent"] for r in outline.parent_leaf(rows).orderBy("r").collect()] == [True, True, False, True, False, False]
    with pytest.raises(Exception, match="deeper than 2"):
        outline.lineage(rows, 2).collect()


def test_blank_fill(spark):
    rows = [("f", 1, 0, "A", "MC", "x"), ("f", 2, 1, "A subtype 1", "MC", "x"), ("f", 3, 0, None, "N", "x"), ("f", 4, 0, "\u00a0", " ", "y"), ("f", 5, 0, "B", None, "C"), ("f", 6, 2, None, "N", "x")]
    got = outline.fill_blanks(spark.createDataFrame(rows, "source_file string, r int, sub_level int, d string, s string, v string"), ["d", "s", "v"]).orderBy("r").collect()
    assert [tuple(r)[3:] for r in got[2:]] == [("A", "N", "x", ["d"], []), ("A", "N", "y", ["d", "s"], []), ("B", None, "C", [], ["s"]), (None, "N", "x", [], ["d"])]
    found = {(r["method"], r["source_header"], r["review_priority"]): r["note"][:1] for r in outline.blank_findings(outline.fill_blanks(spark.createDataFrame(rows, "source_file string, r int, sub_level int, d string, s string, v string"), ["d", "s", "v"])).collect()}
    assert found == {("label_repeat_filled", "d", "OK"): "2", ("label_repeat_filled", "s", "OK"): "1", ("dim_missing_value", "d", "HIGH"): "1", ("dim_missing_value", "s", "HIGH"): "1"}


@pytest.mark.parametrize("kind", ["double", "decimal(18,2)"])
def test_variance_keeps_fractions(spark, kind):
    df = facts(spark, ("A", "p", "FY25", 1075, "Budget"), ("A", "p", "FY25", 350, "Cost")).withColumn("Value", (F.col("Value") / 100).cast(kind))
    row = variance.compiled(df).where("DEPT = 'A'").first()
    assert (float(row["Budget"]), float(row["Cost"]), float(row["Variance"])) == (10.75, 3.5, 7.25)
    assert {float(r["TOTAL"]) for r in variance.stacked(df, ["FY25"]).collect()} == {10.75, 3.5, 7.25}
    assert variance.headline_text(variance.headline_totals(df)).first()[0] == "Budget 11  Cost 4  Variance 7 (+207.1%)"


def test_strict_alignment(spark):
    df = facts(spark, ("A", "p", "FY25", 10, "Budget"), ("B", "p", "FY25", 7, "Cost"), ("C", "p", "FY25", 5, "Budget"), ("C", "p", "FY25", 2, "Cost"))
    got = {(r["DEPT"], r["Measure"]): (r["FY25"], r["TOTAL"]) for r in variance.in_order(variance.strict(df, ["FY25"])).collect()}
    assert got == {("A", "Budget"): (10, 10), ("A", "Variance"): (None, 0), ("B", "Cost"): (7, 7), ("B", "Variance"): (None, 0), ("C", "Budget"): (5, 5), ("C", "Cost"): (2, 2), ("C", "Variance"): (3, 3)}


def test_gates(spark):
    leaves = spark.createDataFrame([("f", "FY25", 5.0), ("f", "FY25", 6.0), ("f", "FY26", 1.0)], "source_file string, p string, v double")
    totals = spark.createDataFrame([("f", "FY25", 11.0), ("f", "FY27", 2.0)], "source_file string, p string, total double")
    assert {r["p"] for r in reconcile.totals_against_leaves(leaves, totals, "p", "v", 0.01).collect()} == {"FY26", "FY27"}
    members = spark.createDataFrame([("L", "F-1"), ("L", "f1"), ("L", "G"), ("M", "F1"), ("N", "Straße"), ("N", "STRASSE")], "level string, member string")
    assert [tuple(r) for r in reconcile.near_duplicates(members).orderBy("level").collect()] == [("L", "f1", "F-1, f1"), ("N", "strasse", "STRASSE, Straße")]


def test_contract(spark):
    df = facts(spark, ("A", "p", "FY25", 10, "Budget"))
    assert staged.check_contract(df) is df
    report = {r["column_name"]: r["present"] for r in staged.contract_report(df.drop("Value")).collect()}
    assert not report["Value"] and report["DEPT"]


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
