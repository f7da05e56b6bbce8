"""The driver's contract, with and without the optional subpackage."""

import sys

import __spark_entry__ as entry


def test_names_agree():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 80
    assert "p2_found" in q


def test_core_works_without_the_subpackage(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "kinmark.llm", None)
    core = importlib.reload(entry).queries()
    assert "p2_found" in core and "p1_found" not in core
    monkeypatch.undo()
    importlib.reload(entry)


def test_export_is_well_formed(spark):
    import xml.etree.ElementTree as ET

    for name in ("r_combined", "r_tombstone_texts"):
        rows = entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
        assert all(ET.fromstring(r.record_data).tag.endswith("eac-cpf") for r in rows)
    assert rows is not None
