"""Sheets and exports of many parts: no task writes a whole sheet."""

import os

import pytest
from pyspark.sql import functions as F

from sheetwright.constants import ROW_INDEX
from sheetwright.plans.mapping import load_mappings
from sheetwright.plans.registry import q_discover_header_variants, q_mapping_load_sheets, q_mapping_load_variants
from sheetwright.sources import fixtures, sheets
from sheetwright.sources.sheets import read_sheets, sheet_headers

HEADER = "View Object,View Object Attribute,Database Table,Database Column,Primary Key Column\n"
ROWS = 3000


@pytest.fixture()
def small_parts(monkeypatch):
    monkeypatch.setattr(fixtures, "PART_LINES", 250, raising=False)
    monkeypatch.setattr(fixtures, "MIN_PARTS", 1, raising=False)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A folder with a ``lineitem`` of its own rows."""
    path = str(tmp_path_factory.mktemp("parts"))
    i = F.col("id")
    spark.range(ROWS).select(
        F.expr("id div 4").alias("l_orderkey"), (i * 7 % 50).alias("l_partkey"), (i * 3 % 10).alias("l_suppkey"),
        (i % 4 + 1).cast("int").alias("l_linenumber"), (i % 50 + 1).cast("double").alias("l_quantity"),
        F.when(i % 3 == 0, "R").otherwise("N").alias("l_returnflag"), F.when(i % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def _largest_part(spark, path):
    files = spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.input_file_name())
    return files.count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("write", ["write_mapping_variants", "write_mapping_sheets", "write_mapping_sheet"])
def test_no_part_grows_with_the_table(spark, sf_dir, tmp_dir, small_parts, write):
    path = getattr(fixtures, write)(spark, sf_dir, path=f"{tmp_dir}/out")
    assert _largest_part(spark, path) < 500  # 3000 lines, in four sheets or one


def test_no_part_of_the_csv_grows_with_the_table(spark, sf_dir, tmp_dir, small_parts):
    path = fixtures.write_mapping_csv(spark, sf_dir, path=f"{tmp_dir}/out")
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) >= 10
    assert max(os.path.getsize(f"{path}/{f}") for f in parts) < sum(os.path.getsize(f"{path}/{f}") for f in parts) / 6


def test_lines_are_put_in_order_without_their_cells(spark, sf_dir):
    for lines in fixtures._sheet_lines(fixtures.table(spark, sf_dir, "lineitem")):
        assert set(lines.columns) == {"_grp", "_ord", *fixtures.SHEET_ORDER}


@pytest.mark.parametrize("query", [q_mapping_load_variants, q_mapping_load_sheets, q_discover_header_variants])
def test_queries_do_not_depend_on_the_parts(spark, sf_dir, tmp_dir, monkeypatch, query):
    found = []
    for lines, least in ((10 * ROWS, 1), (250, 1)):
        monkeypatch.setattr(fixtures, "PART_LINES", lines)
        monkeypatch.setattr(fixtures, "MIN_PARTS", least)
        monkeypatch.setattr(fixtures, "_export_folder", lambda spark, sf_dir, name: f"{tmp_dir}/{name}-{lines}")
        found.append(sorted(map(str, query(spark, sf_dir).collect())))
    assert found[0] == found[1]
    assert found[0]


@pytest.mark.parametrize("few", [1000, 0])
def test_a_folder_of_parts_is_one_sheet(spark, tmp_dir, monkeypatch, few):
    monkeypatch.setattr(sheets, "FEW_FILES", few)
    monkeypatch.setattr(sheets, "PART_GROUP", 2)
    lines = ["Title,,,,\n", "a note,,,,\n", HEADER, *[f"App.Mod.V{i},A{i},T,C{i},Yes\n" for i in range(7)]]
    for sheet, cuts in (("a", (0, 1, 2, 4, 9, 10)), ("b", (0, 10))):
        os.makedirs(f"{tmp_dir}/s/{sheet}")
        for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
            with open(f"{tmp_dir}/s/{sheet}/part-{n:05d}.csv", "w") as f:
                f.write("".join(lines[low:high]))
    load = load_mappings(spark, f"{tmp_dir}/s/*", fmt="csv", folders=True)
    got = {}
    for r in load.mappings.collect():
        got.setdefault(r["sheet"].rsplit("/", 1)[-1], {})[r[ROW_INDEX]] = r["viewObjectAttribute"]
    assert got == {s: {i + 2: f"A{i}" for i in range(7)} for s in "ab"}
    heads = sheet_headers(spark, f"{tmp_dir}/s/*", "csv", folders=True).collect()
    assert sorted((h["sheet"].rsplit("/", 1)[-1], h["headerLine"]) for h in heads) == [("a", 2), ("b", 2)]
    named, _ = read_sheets(spark, f"{tmp_dir}/s/*", "csv", names=load.names, folders=True)
    assert sorted(r[ROW_INDEX] for r in named.collect()) == sorted([*range(9)] * 2)
