"""Many sheets whose headers differ."""

import os

import pytest
from pyspark.sql import functions as F

from sheetwright.constants import ROW_INDEX
from sheetwright.plans.mapping import load_mapping, load_mappings
from sheetwright.sources import sheets
from sheetwright.sources.sheets import read_sheets, sheet_headers

A = """Title,,,,,
View Object,View Object Attribute,Database Table,Database Column,Primary Key Column,Is Indexed?
App.Mod.Svc.Thing,A1,T1,C1,Yes,No
App.Mod.Thing,A2,T1,C2,No,maybe
"""
B = """Other title,,,,,,
a note,,,,,,
,,,,,,
Database Column,View Object,View Object Attribute,Database Table,Is Unique?,Primary Key Column,Is Indexed?
C9,App,B1,T9,Yes,Yes,No
C8,App,B2,T9,,Yes,No
C7,App.Mod,B3,T9,No,No,Yes
"""
C = """T,,,,
View Object,View Object Attribute,Database Table,Database Column,Primary Key Column
App.Mod.Svc.Thing,C1,T1,K1,Yes
App.Mod.Svc.Thing,C2,T1,K2,
"""


def _folder(path, **files):
    os.makedirs(path)
    for name, text in files.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    return path


def _rows(load):
    return {r["viewObjectAttribute"]: (r["sheet"].rsplit("/", 1)[-1], r[ROW_INDEX], r["databaseTable"], r["databaseColumn"], r["primaryKeyColumn"],
                                       r["isIndexed"], r["isUnique"], r["viewObjectModelTop"]) for r in load.mappings.collect()}


def test_order_and_further_flags(spark, tmp_dir):
    load = load_mappings(spark, _folder(f"{tmp_dir}/s", a=A, b=B, c=C), fmt="csv")
    assert load.names == ("viewObject", "viewObjectAttribute", "databaseTable", "databaseColumn", "primaryKeyColumn", "isIndexed", "isUnique")
    assert load.flags == ("primaryKeyColumn", "isIndexed", "isUnique")
    assert _rows(load) == {
        "A1": ("a.csv", 1, "T1", "C1", 1, 0, None, "App"),
        "B1": ("b.csv", 3, "T9", "C9", 1, 0, 1, "App"),
        "B3": ("b.csv", 5, "T9", "C7", 0, 1, 0, "App"),
        "C1": ("c.csv", 1, "T1", "K1", 1, None, None, "App"),
    }


def test_each_sheet_loads_as_it_does_alone(spark, tmp_dir):
    texts = {"a": A, "b": B, "c": C}
    folder = _folder(f"{tmp_dir}/s", **texts)
    together = load_mappings(spark, folder, fmt="csv")
    for name in texts:
        alone = load_mapping(spark, f"{folder}/{name}.csv", fmt="csv")
        own = together.mappings.filter(F.col("sheet").endswith(f"/{name}.csv")).select(alone.mappings.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, alone.mappings.collect()))


def test_parquet_sheets_of_different_width(spark, tmp_dir):
    for name, text in {"a": A, "b": B, "c": C}.items():
        lines = [[c or None for c in line.split(",")] for line in text.splitlines()]
        width = len(lines[0])
        spark.createDataFrame(lines, ", ".join(f"_c{i} string" for i in range(width))).coalesce(1).write.parquet(f"{tmp_dir}/p/{name}")
    load = load_mappings(spark, f"{tmp_dir}/p/*")
    assert {k: v[1:] for k, v in _rows(load).items()} == {
        "A1": (1, "T1", "C1", 1, 0, None, "App"), "B1": (3, "T9", "C9", 1, 0, 1, "App"), "B3": (5, "T9", "C7", 0, 1, 0, "App"),
        "C1": (1, "T1", "K1", 1, None, None, "App")}


def test_rows_are_read_once_whatever_the_number_of_headers(spark, tmp_dir):
    load = load_mappings(spark, _folder(f"{tmp_dir}/s", a=A, b=B, c=C), fmt="csv")
    plan = load.mappings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Union" not in plan


def test_more_sheets_than_are_broadcast(spark, tmp_dir, monkeypatch):
    folder = _folder(f"{tmp_dir}/s", a=A, b=B, c=C)
    want = _rows(load_mappings(spark, folder, fmt="csv"))
    monkeypatch.setattr(sheets, "MAX_BROADCAST_ROWS", 0)
    assert _rows(load_mappings(spark, folder, fmt="csv")) == want


def test_cells_past_a_sheets_own_header_raise(spark, tmp_dir):
    """Even where another sheet has a column at that place."""
    load = load_mappings(spark, _folder(f"{tmp_dir}/s", b=B, c=C + "App,C3,T1,K3,Yes,Yes\n"), fmt="csv")
    with pytest.raises(Exception, match="more cells than the header"):
        load.mappings.collect()


def test_sheets_without_what_a_mapping_needs_raise(spark, tmp_dir):
    for name, text, error in (("k", C.replace("Primary Key Column", "Other Flag"), "primaryKeyColumn"),
                              ("t", C.replace("Database Column", "Some Column"), "first four columns"),
                              ("d", C.replace("Database Column", "View Object"), "duplicate")):
        with pytest.raises(ValueError, match=error):
            load_mappings(spark, _folder(f"{tmp_dir}/{name}", a=A, z=text), fmt="csv")
    with pytest.raises(LookupError, match="z.csv"):
        load_mappings(spark, _folder(f"{tmp_dir}/h", a=A, z="Title,,\n,,\n"), fmt="csv")


def test_too_many_headers_raise(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sheets, "MAX_VARIANTS", 2)
    with pytest.raises(ValueError, match="more than 2 different headers"):
        read_sheets(spark, _folder(f"{tmp_dir}/s", a=A, b=B, c=C), "csv")


def test_headers_as_rows(spark, tmp_dir):
    heads = sheet_headers(spark, _folder(f"{tmp_dir}/s", a=A, b=B, c=C), "csv").collect()
    assert {h["sheet"].rsplit("/", 1)[-1]: h["headerLine"] for h in heads} == {"a.csv": 1, "b.csv": 3, "c.csv": 1}
