"""Workbooks made here, with one property changed at a time, through the whole ingestion: did it block, and for the right reason?"""

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import config, ingest, report
from tallyframe.sources import xlsx

NAME = "F-DEPT-VAR"
LEVELS = [
    {"canonical": "DEPT", "aliases": ["Row labels"], "vocabulary": ["A", "B", "C", "A one", "A two"]},
    {"canonical": "Service", "aliases": ["Division"], "vocabulary": ["MC", "N", "F"], "normalization": {"punctuation": True, "case": True}},
    {"canonical": "Variant", "aliases": ["Type"], "vocabulary": ["A", "B", "C"]},
]


def declaration(**more):
    fields = ["Report", "Report Type"]
    return config.load({"hierarchy": LEVELS, "metadata": {"declared_fields": fields, "required_fields": fields}, **more})


def base():
    rows = [["Report:", NAME], ["Report Type:", "Cost"], [], ["Row labels", "Division", "Type", "Sum of FY26", "FY27"]]
    data = [["A", "MC", "A", 30, 3], ["  A one", "MC", "A", 10, 1], ["  A two", "MC", "A", 20, 2], ["A", "F", "C", 948, 5], ["B", "N", "B", 7, 7], ["C", "F", "A", 1, 2]]
    return [*rows, *data, ["total", None, None, 986, 17], [], ["*NOTES total of nothing"]]


def changed(*cells, rows=None):
    out = [list(r) for r in (rows or base())]
    for r, c, v in cells:
        out[r][c] = v
    return out


NARROW = [[v for c, v in enumerate(r) if c != 2] if len(r) > 2 else r for r in base()]
#: Name: rows, indents, findings that block, sum of the leaves in FY26.
BOOKS = {
    "clean": (base(), None, [], 986),
    "attributes": (changed((5, 0, "A one"), (6, 0, "A two")), {(NAME, 5, 0): 1, (NAME, 6, 0): 1}, [], 986),
    "repeats": (changed((7, 0, None)), None, [], 986),
    "negatives": (changed((7, 3, "(948)"), (10, 3, -910)), None, [], -910),
    "text": (changed(*[(r, 3, f"{base()[r][3]:,}") for r in range(4, 11)]), None, [], 986),
    "rewards": (changed((8, 0, "Total Rewards")), None, ["member_undeclared"], 986),
    "printed": (changed((8, 1, "(blank)")), None, [], 986),
    "dirty": (changed((8, 0, "B "), (9, 1, "f")), None, [], 986),
    "hole": (changed((8, 2, None)), None, ["dim_missing_value", "dimension_null"], 986),
    "untied": (changed((10, 3, 985)), None, ["reconciliation_mismatch"], 986),
    "untotalled": (base()[:10], None, ["reconciliation_no_total"], 986),
    "renamed": (changed((0, 1, "other")), None, ["report_name_mismatch"], 986),
    "narrow": (NARROW, None, ["dimension_null", "hierarchy_missing"], 986),
    "permitted": (NARROW, None, [], 986),
}


def test_batch(spark, tmp_path):
    """All workbooks in one batch, with a file that is none."""
    (tmp_path / "in").mkdir()
    for name, (rows, indents, _, _) in BOOKS.items():
        xlsx.write_book(str(tmp_path / f"in/{name}.xlsx"), {NAME: rows}, indents)
    (tmp_path / "in/bad.xlsx").write_bytes(b"nothing")
    d = declaration(overrides={"allow_missing_levels": {"permitted.xlsx": ["Variant"]}})
    with pytest.raises(report.LoadBlocked, match="file_error x1"):
        ingest.ingest(spark, str(tmp_path / "in"), d, ingested_at="t0", out=str(tmp_path / "out"))
    own = F.regexp_extract("source_file", r"([^/]+)\.xlsx$", 1).alias("name")
    facts = spark.read.parquet(str(tmp_path / "out/ingested_data")).select("*", own).toPandas()
    found = spark.read.parquet(str(tmp_path / "out/audit_report")).select("*", own).toPandas()
    high = found[found["review_priority"] == "HIGH"]
    got = {name: (sorted(set(high[high["name"] == name]["method"])), facts[(facts["name"] == name) & facts["is_leaf"] & (facts["Period"] == "FY26")]["Value"].sum()) for name in BOOKS}
    assert got == {name: (methods, total) for name, (_, _, methods, total) in BOOKS.items()}
    assert list(high[high["name"] == "bad"]["method"]) == ["file_error"]
    assert not facts["row_key"].duplicated().any() or facts.groupby("name")["row_key"].nunique().eq(12).all()
    row = facts[(facts["name"] == "clean") & (facts["path"] == "A > A one") & (facts["Period"] == "FY27")].iloc[0]
    assert (row["Value"], row["sub_level"], row["parent_label"], row["meta_report_type"], row["ingested_at"]) == (1.0, 1, "A", "Cost", "t0")
    assert "label_repeat_filled" in set(found[found["name"] == "repeats"]["method"]) and facts[facts["name"] == "repeats"]["DEPT"].notna().all()
    assert "NA - Not Provided" in set(facts[facts["name"] == "printed"]["Service"])
    assert set(facts[facts["name"] == "permitted"]["Variant"]) == {"NA - Overridden"} and set(facts[facts["name"] == "permitted"]["nulled_levels"]) == {"Variant"}
    assert list((tmp_path / "out/review_high.csv").iterdir())


def test_register_is_kept(spark, tmp_path):
    path = str(tmp_path / "register")
    assert ingest.load_register(spark, path).count() == 0
    row = [("L", "A", True, "x", None, "t0", {"P": 2})]
    ingest.save_register(spark.createDataFrame(row, ingest.REGISTER), path)
    again = ingest.load_register(spark, path)
    assert [tuple(r) for r in again.collect()] == row
    ingest.save_register(again.unionByName(spark.createDataFrame([("L", "B", False, None, None, "t1", None)], ingest.REGISTER)), path)
    assert {r["member"]: r["approved"] for r in ingest.load_register(spark, path).collect()} == {"A": True, "B": False}
