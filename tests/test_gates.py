"""Workbooks, declaration, registers and findings on cases made by hand."""

import pytest

from tallyframe.operators import members
from tallyframe.plans import config, report
from tallyframe.sources import xlsx


def test_workbook_files(spark, tmp_path):
    xlsx.write_book(str(tmp_path / "a.xlsx"), {"One": [["Report:", "One"], [], ["A & <b>", None, 2.5]]}, {("One", 2, 0): 1})
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    rows = xlsx.scan_cells(spark, str(tmp_path)).collect()
    assert [r["kind"] for r in rows if r["source_file"].endswith("bad.xlsx")] == ["error"]
    got = sorted((r["r"], r["c"], r["kind"], r["str"], r["num"], r["indent"]) for r in rows if r["source_file"].endswith("/a.xlsx"))
    assert got == [(0, 0, "string", "Report:", None, 0), (0, 1, "string", "One", None, 0), (2, 0, "string", "A & <b>", None, 1), (2, 2, "number", "2.5", 2.5, 0)]
    assert xlsx.file_digest(spark, str(tmp_path)).count() == 2


def test_declaration():
    d = config.load({"hierarchy": [{"canonical": "DEPT", "vocabulary": ["A", "B"]}, {"canonical": "Project"}], "matching": {"accept_threshold": 0.9}})
    assert [v.mode for v in d.levels] == ["closed", "observed"] and d.accept == 0.9 and d.names == ("DEPT", "Project")
    with pytest.raises(ValueError, match="merges"):
        config.Level("S", vocabulary=("F-1", "F1"), punctuation=True, mode="closed")
    with pytest.raises(ValueError, match="vocabulary"):
        config.Level("S", mode="closed")


def test_register(spark):
    schema = "level string, member string, approved boolean, approved_by string, first_seen string"
    registry = spark.createDataFrame([("L", "A", True, "x", "t0"), ("L", "B", False, None, "t0")], schema)
    seen = spark.createDataFrame([("f", "L", "A "), ("f", "L", "Ab"), ("f", "L", "(blank)")], "source_file string, level string, member string")
    judged = members.judge(seen, members.approved_members(registry, "L"), mode="registry").cache()
    assert {(r["member"], r["value"], r["method"]) for r in judged.collect()} == {("A ", "A", "member_normalized"), ("Ab", "Ab", "member_pending_approval"), ("(blank)", members.NOT_PROVIDED, "member_blank_literal")}
    after = members.registry_after(registry, judged, "t1")
    assert {r["member"] for r in members.pending_members(after).collect()} == {"B", "Ab"}
    assert members.approve_members(registry, "L", []).where("approved").count() == 1
    with pytest.raises(report.LoadBlocked, match="member_pending_approval x1"):
        report.load_gate(members.member_findings(judged))
