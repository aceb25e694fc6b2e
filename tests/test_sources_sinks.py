"""Sheet and JSON sources, file sinks and the streaming export."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sheetwright.constants import ROW_INDEX
from sheetwright.plans.mapping import load_mapping, load_mappings
from sheetwright.sinks.files import dataset_names, dated_name, dated_path, write_json, write_many
from sheetwright.sinks.tables import save_table, save_view
from sheetwright.sources.fixtures import HEADER_LINE, write_mapping_sheet
from sheetwright.sources.json_records import read_json_records
from sheetwright.sources.sheets import discover_header, header_frame, open_sheet, read_sheet, read_with_row_index
from sheetwright.streaming.records import stream_record_export

SHEET_CSV = """Mapping export,,,,,
Generated for review,,,,,
,,,,,
View Object,View Object Attribute,Database Table,Database Column,Primary Key Column,Is Indexed?
App.Mod.Svc.Thing,AttrA,T1,C1,Yes,No
App.Mod.Thing,AttrB,T1,C2,No,Yes
App,AttrC,T2,C3,yes,No
App.Mod.Svc.Thing,AttrD,T1,C4,Yes,Yes
"""


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_sheet_positions_and_header(spark, tmp_dir):
    # the same sheet split over two part files: positions continue across files
    lines = SHEET_CSV.splitlines(keepends=True)
    os.makedirs(f"{tmp_dir}/sheet")
    _write(f"{tmp_dir}/sheet/part-00000.csv", "".join(lines[:6]))
    _write(f"{tmp_dir}/sheet/part-00001.csv", "".join(lines[6:]))
    load = load_mapping(spark, f"{tmp_dir}/sheet", fmt="csv")
    assert load.names == ("viewObject", "viewObjectAttribute", "databaseTable", "databaseColumn",
                          "primaryKeyColumn", "isIndexed")
    rows = {r["viewObjectAttribute"]: r for r in load.mappings.collect()}
    assert set(rows) == {"AttrA", "AttrB", "AttrD"}          # AttrC has 'yes': dropped
    assert rows["AttrA"][ROW_INDEX] == 3 and rows["AttrD"][ROW_INDEX] == 6   # line - 1, gaps kept
    assert rows["AttrB"]["viewObjectModelService"] == ""
    assert rows["AttrA"]["viewObjectName"] == "Thing"


def test_csv_positions_across_file_blocks(spark, tmp_dir):
    """A CSV file read in many blocks (splits) keeps exact line numbers, blank lines included."""
    from sheetwright.sources.sheets import POS, _positioned_csv

    lines = [f"r{i},{'x' * (i % 50)},{i}" if i % 97 else "" for i in range(6000)]
    _write(f"{tmp_dir}/big.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        df = _positioned_csv(spark, [f"{tmp_dir}/big.csv"])
        got = {r[POS]: r["_c0"] for r in df.collect()}
        n_parts = df.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n_parts > 4
    assert got == {i: (f"r{i}" if i % 97 else None) for i in range(6000)}


def test_many_single_file_sheets(spark, tmp_dir):
    from sheetwright.plans.mapping import load_mappings

    os.makedirs(f"{tmp_dir}/many")
    _write(f"{tmp_dir}/many/a.csv", SHEET_CSV)
    _write(f"{tmp_dir}/many/b.csv", "Other title,,,,,\n" + SHEET_CSV.split("\n", 3)[3].replace("AttrA", "AttrZ"))
    load = load_mappings(spark, f"{tmp_dir}/many", fmt="csv")
    rows = {(r["sheet"].rsplit("/", 1)[-1], r["viewObjectAttribute"]): r[ROW_INDEX] for r in load.mappings.collect()}
    assert rows[("a.csv", "AttrA")] == 3 and rows[("b.csv", "AttrZ")] == 1   # rowIndex per sheet
    _write(f"{tmp_dir}/many/c.csv", "T,,\nA,B,C\nx,y,z\n")
    with pytest.raises(ValueError):
        load_mappings(spark, f"{tmp_dir}/many", fmt="csv")


def test_header_needs_blank_second_cell_on_line_zero(spark, tmp_dir):
    _write(f"{tmp_dir}/bad.csv", "Title,Oops,,\n" + SHEET_CSV.split("\n", 1)[1])
    with pytest.raises(LookupError):
        read_sheet(spark, f"{tmp_dir}/bad.csv", fmt="csv")


def test_header_must_be_within_fifteen_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/late.csv", "Title,,\n" + ",,\n" * 16 + "A,B,C\nx,y,z\n")
    with pytest.raises(LookupError):
        read_sheet(spark, f"{tmp_dir}/late.csv", fmt="csv")


def test_parquet_sheet_fixture(spark):
    path = write_mapping_sheet(spark, SF_SMALL)
    sheet = open_sheet(spark, path)
    hdr = discover_header(sheet)
    assert hdr.line == HEADER_LINE
    frame = {r["position"]: r["columnName"] for r in header_frame(sheet).collect()}
    assert [frame[i] for i in range(len(frame))] == list(hdr.names)
    lines = sheet.lines()
    assert lines.agg(F.min("_line"), F.max("_line"), F.count("*")).first() == (0, lines.count() - 1, lines.count())


def test_row_index_over_many_files(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    li.orderBy("l_orderkey", "l_linenumber").repartition(1).write.parquet(f"{tmp_dir}/one")
    (spark.read.parquet(f"{tmp_dir}/one").repartitionByRange(5, "l_orderkey", "l_linenumber")
     .sortWithinPartitions("l_orderkey", "l_linenumber").write.parquet(f"{tmp_dir}/five"))
    single = read_with_row_index(spark, f"{tmp_dir}/one")
    multi = read_with_row_index(spark, f"{tmp_dir}/five")
    assert multi.agg(F.countDistinct(ROW_INDEX), F.min(ROW_INDEX), F.max(ROW_INDEX)).first() == \
        (li.count(), 0, li.count() - 1)
    a = single.groupBy().agg(F.sum(F.col(ROW_INDEX) * F.col("l_linenumber"))).first()[0]
    b = multi.groupBy().agg(F.sum(F.col(ROW_INDEX) * F.col("l_linenumber"))).first()[0]
    assert a == b


def test_json_documents_list_object_and_empty(spark, tmp_dir):
    _write(f"{tmp_dir}/list.json", json.dumps([{"a": 1, "b": None}, {"a": 2, "b": "x"}]))
    _write(f"{tmp_dir}/one.json", json.dumps({"a": 3, "b": "y"}))
    _write(f"{tmp_dir}/empty.json", "[]")
    got = read_json_records(spark, f"{tmp_dir}/list.json", schema="a long, b string").collect()
    assert [(r.a, r.b) for r in got] == [(1, ""), (2, "x")]
    assert read_json_records(spark, f"{tmp_dir}/one.json", schema="a long, b string").count() == 1
    assert read_json_records(spark, f"{tmp_dir}/empty.json", schema="a long, b string").count() == 0
    _write(f"{tmp_dir}/data.xlsx", "not json")
    with pytest.raises(ValueError):
        read_json_records(spark, f"{tmp_dir}/data.xlsx")
    with pytest.raises(FileNotFoundError):
        read_json_records(spark, f"{tmp_dir}/missing.json", schema="a long")
    os.makedirs(f"{tmp_dir}/records.v2")
    _write(f"{tmp_dir}/records.v2/part.json", json.dumps([{"a": 5, "b": "z"}]))
    assert read_json_records(spark, f"{tmp_dir}/records.v2", schema="a long, b string").count() == 1


def test_write_json_document_layout_is_valid_json(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = write_json(orders, f"{tmp_dir}/docs", simplify=True, layout="document")
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    records = []
    for f in files:
        with open(os.path.join(out, f)) as fh:
            text = fh.read()
        if text.strip():
            records.extend(json.loads(text))
    assert len(records) == orders.count()
    assert records[0]["o_orderdate"].endswith("+00:00")


def test_document_lines_round_trip(spark, tmp_dir):
    from sheetwright.sources.json_records import read_json_document_lines

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").drop("o_orderdate")
    out = write_json(orders, f"{tmp_dir}/docs", simplify=False, layout="document")
    back = read_json_document_lines(spark, out, orders.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))
    _write(f"{tmp_dir}/one.json", '[\n{"o_orderkey": 1, "o_custkey": 2}\n]\n')
    got = read_json_document_lines(spark, f"{tmp_dir}/one.json", "o_orderkey long, o_custkey long").collect()
    assert [tuple(r) for r in got] == [(1, 2)]


def test_pretty_documents_read_back_whole(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").drop("o_orderdate")
    out = write_json(orders, f"{tmp_dir}/pretty", simplify=False, layout="document", pretty=True)
    back = read_json_records(spark, out, schema=orders.schema, document=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))


def test_write_many_names_skip_and_overwrite(spark, tmp_dir):
    a = spark.range(3)
    b = spark.range(2)
    empty = spark.range(0)
    written = write_many([a, empty, b], f"{tmp_dir}/t", names=["only one"])
    assert list(written) == ["Sheet 1 of 3", "Sheet 3 of 3"]
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["Sheet-1-of-3", "Sheet-3-of-3"]
    write_many([b], f"{tmp_dir}/t", names=["extra"], overwrite=False)
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["Sheet-1-of-3", "Sheet-3-of-3", "extra"]
    write_many([b], f"{tmp_dir}/t", names=["extra"], overwrite=True)
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["extra"]
    assert dataset_names(2, ["x", "y"]) == ["x", "y"]
    write_many([spark.createDataFrame([(1, None)], "a int, b string")], f"{tmp_dir}/csv", names=["m"], fmt="csv")
    back = spark.read.option("header", "true").csv(f"{tmp_dir}/csv/m").collect()
    assert [tuple(r) for r in back] == [("1", None)] or [tuple(r) for r in back] == [("1", "")]


def test_row_cap_is_positional(spark, tmp_dir):
    _write(f"{tmp_dir}/s.csv", SHEET_CSV)
    df, _ = read_sheet(spark, f"{tmp_dir}/s.csv", fmt="csv", nrows=5)
    assert sorted(r[ROW_INDEX] for r in df.collect()) == [0, 1, 2, 3, 4]


def test_export_path(spark):
    from sheetwright.sinks.files import export_path

    day = dt.date(2026, 1, 5)
    assert export_path("/out", "pk Cols") == "/out/pk-Cols.json"
    assert export_path("/out", "Été report.yaml") == "/out/Ete-report.yaml"
    assert export_path("/out", "pkCols", dated=True, on=day) == "/out/V2026.01.05__pkCols.json"


def test_dated_names():
    day = dt.date(2026, 1, 5)
    assert dated_name("pkCols.json", day) == "V2026.01.05__pkCols.json"
    assert dated_path("/a/b/pkCols", day) == "/a/b/V2026.01.05__pkCols"


def test_table_and_view_sinks(spark, tmp_dir):
    save_table(spark.range(5), "sw_test_tab", f"{tmp_dir}/tab")
    save_table(spark.range(3), "sw_test_tab", f"{tmp_dir}/tab")
    assert spark.table("sw_test_tab").count() == 3
    save_view(spark.table("sw_test_tab").filter("id > 0"), "sw_test_view")
    assert spark.table("sw_test_view").count() == 2


def test_streaming_record_export(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/a.json", json.dumps({"id": 1, "tags": ["x", "y"], "d": {"k": 0, "v": "z"}}) + "\n")
    _write(f"{src}/b.json", json.dumps({"id": 0, "tags": [], "d": {"k": 0, "v": ""}}) + "\n")
    q = stream_record_export(spark, src, "id long, tags array<string>, d struct<k:long, v:string>",
                             f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    out = spark.read.json(f"{tmp_dir}/out").collect()
    assert [r.asDict() for r in out] == [{"d_v": "z", "id": 1, "tags": "x>y"}]


def test_write_catalogue_documents(spark, tmp_dir):
    from sheetwright.constants import LEVELS
    from sheetwright.plans.mapping import MappingLoad, store_mapping, write_catalogue
    from sheetwright.plans.registry import _mappings
    from sheetwright.sources.fixtures import SHEET_COLUMNS, SHEET_FLAGS

    store_mapping(MappingLoad(_mappings(spark, SF_SMALL), SHEET_COLUMNS, SHEET_FLAGS), "mappings",
                  f"{tmp_dir}/mappings")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # several ordered documents
    try:
        out = write_catalogue(spark, tmp_dir, dated=True, on=dt.date(2026, 1, 5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out.endswith("/V2026.01.05__pkCols.json")
    records = []
    for f in sorted(os.listdir(out)):
        if f.startswith("part-"):
            with open(os.path.join(out, f)) as fh:
                text = fh.read()
            if text.strip():
                records.extend(json.loads(text))
    assert len(records) == spark.table("mappings").select(*LEVELS, "databaseTable").filter(
        "primaryKeyColumn = 1").distinct().count() + spark.table("mappingsTables").filter("colCntPK = 0").count()
    keys = [(r["viewObjectModelTop"], r["viewObjectModel"], r["viewObjectModelService"], r["viewObjectName"])
            for r in records]
    assert keys == sorted(keys)
    assert all(isinstance(r["cols"], list) for r in records if r.get("colCntPK"))


def test_select_from_and_sql_views(spark, tmp_dir):
    from sheetwright.operators.selection import run_sql, select_from
    from sheetwright.plans.mapping import MappingLoad, store_mapping
    from sheetwright.plans.registry import _mappings
    from sheetwright.sinks.tables import save_sql_view
    from sheetwright.sources.fixtures import SHEET_COLUMNS, SHEET_FLAGS

    store_mapping(MappingLoad(_mappings(spark, SF_SMALL), SHEET_COLUMNS, SHEET_FLAGS), "mappings",
                  f"{tmp_dir}/mappings")
    one = select_from(spark, "mappingsPkCols", "viewObjectAttribute")
    assert one.columns == ["viewObjectAttribute"]
    assert one.filter("viewObjectAttribute IS NULL").count() == 0          # nulls shown as ''
    assert select_from(spark, "mappingsTables").count() == spark.table("mappingsTables").count()
    save_sql_view(spark, "top_objects", "SELECT viewObjectModelTop, SUM(colCnt) AS n FROM mappingsTables "
                                        "GROUP BY viewObjectModelTop")
    total = run_sql(spark, "SELECT SUM(n) AS t FROM top_objects").first()["t"]
    assert total == spark.table("mappings").count()


def test_partitioned_datasets_replace_only_present_partitions(spark, tmp_dir):
    from sheetwright.sinks.files import write_partitioned_datasets

    first = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, v int")
    write_partitioned_datasets(first, f"{tmp_dir}/parts", "dataset")
    write_partitioned_datasets(spark.createDataFrame([("b", 3)], "dataset string, v int"), f"{tmp_dir}/parts",
                               "dataset")
    back = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/parts").select("dataset", "v").collect())
    assert back == [("a", 1), ("b", 3)]


def test_dated_record_export(spark, tmp_dir):
    from sheetwright.plans.mapping import export_records

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "event_type")
    out = export_records(ev, f"{tmp_dir}/events", dated=True, on=dt.date(2026, 1, 5))
    assert out.endswith("/V2026.01.05__events")
    assert spark.read.json(out).count() == ev.filter("event_id <> 0 OR event_type NOT IN ('', 'None')").count()


def test_hash_list_equals_hashlib(spark):
    import hashlib

    from pyspark.sql import types as T

    from sheetwright.functions.hashing import hash_list

    df = spark.createDataFrame([(["a", "é"],), ([],)], "l array<string>")
    got = [r[0] for r in df.select(hash_list("l", T.ArrayType(T.StringType()))).collect()]
    assert got == [hashlib.sha512(json.dumps(v).encode()).hexdigest() for v in (["a", "é"], [])]


def test_snapshot_partitions(spark, tmp_dir):
    from sheetwright.sinks.files import write_snapshot

    write_snapshot(spark.range(3), f"{tmp_dir}/snap", on=dt.date(2026, 1, 5))
    write_snapshot(spark.range(2), f"{tmp_dir}/snap", on=dt.date(2026, 1, 6))
    write_snapshot(spark.range(4), f"{tmp_dir}/snap", on=dt.date(2026, 1, 5))   # same day: replaced
    back = spark.read.parquet(f"{tmp_dir}/snap").groupBy("snapshot_date").count().collect()
    assert sorted((str(r[0]), r[1]) for r in back) == [("2026-01-05", 4), ("2026-01-06", 2)]


def test_header_found_behind_many_empty_part_files(spark, tmp_dir):
    """Empty files do not hide the header."""
    os.makedirs(f"{tmp_dir}/gappy")
    for i in range(18):
        _write(f"{tmp_dir}/gappy/part-{i:05d}.csv", "")
    _write(f"{tmp_dir}/gappy/part-00018.csv", SHEET_CSV)
    hdr = discover_header(open_sheet(spark, f"{tmp_dir}/gappy", fmt="csv"))
    assert hdr.line == 3 and hdr.names[-1] == "isIndexed"
    load = load_mapping(spark, f"{tmp_dir}/gappy", fmt="csv")
    assert load.mappings.count() == 3


def test_csv_width_counts_all_lines(spark, tmp_dir):
    """A cell far down and a header in a smaller file keep their columns."""
    from sheetwright.sources.sheets import positioned_lines

    os.makedirs(f"{tmp_dir}/wide")
    _write(f"{tmp_dir}/wide/part-00000.csv", SHEET_CSV)
    _write(f"{tmp_dir}/wide/part-00001.csv", "a,b\n" * 500 + '1,2,3,4,5,"x,7",7\n')
    lines = positioned_lines(spark, f"{tmp_dir}/wide", "csv")
    assert [c for c in lines.columns if c.startswith("_c")] == [f"_c{i}" for i in range(7)]
    last = lines.orderBy(F.desc("_line")).first()
    assert (last["_line"], last["_c5"], last["_c6"]) == (508, "x,7", "7")


def test_cells_past_the_header_raise(spark, tmp_dir):
    """A cell past the header's names is no column: it raises on a data line, also where the line's flags would drop it."""
    lines = SHEET_CSV.rstrip("\n").split("\n")
    width = max(line.count(",") for line in lines) + 1
    for name, extra, message in (("wide", "x" + ",x" * width, "more cells than the header"), ("blank", "," * (width + 3), None)):
        os.makedirs(f"{tmp_dir}/{name}")
        _write(f"{tmp_dir}/{name}/part-00000.csv", SHEET_CSV + lines[-1] + "\n" + extra + "\n")
        for load in (load_mapping, load_mappings):
            rows = load(spark, f"{tmp_dir}/{name}", fmt="csv").mappings
            if message is None:
                assert rows.count() == 4
            else:
                with pytest.raises(Exception, match=message):
                    rows.count()
    preamble = SHEET_CSV.split("\n")
    os.makedirs(f"{tmp_dir}/preamble")
    preamble.insert(1, "note" + "," * (width + 1) + "wide preamble")
    _write(f"{tmp_dir}/preamble/part-00000.csv", "\n".join(preamble))
    for load in (load_mapping, load_mappings):
        assert load(spark, f"{tmp_dir}/preamble", fmt="csv").mappings.count() == 3


def test_csv_quotes_line_breaks_and_folder_names(spark, tmp_dir):
    folder = f"{tmp_dir}/my sheet 100%"
    os.makedirs(folder)
    _write(f"{folder}/part-00000.csv", SHEET_CSV.replace("AttrA", '"say ""hi"", you"').replace("AttrB", '"two\nlines"'))
    rows = {r["viewObjectAttribute"]: r[ROW_INDEX] for r in load_mapping(spark, folder, fmt="csv").mappings.collect()}
    assert rows == {'say "hi", you': 3, "two\nlines": 4, "AttrD": 6}
    one_line = SHEET_CSV.replace("AttrA", '"say ""hi"", you"')
    _write(f"{folder}/part-00000.csv", one_line)
    rows = {r["viewObjectAttribute"]: r[ROW_INDEX] for r in load_mapping(spark, folder, fmt="csv").mappings.collect()}
    assert rows == {'say "hi", you': 3, "AttrB": 4, "AttrD": 6}
    _write(f"{folder}/part-00000.csv", SHEET_CSV.replace("AttrD", '"never closed'))
    with pytest.raises(Exception, match="not closed"):
        load_mapping(spark, folder, fmt="csv").mappings.collect()


def test_parts_are_ordered_by_number(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/parts")
    for number, text in ((99999, SHEET_CSV), (100000, "App,AttrZ,T9,C9,Yes,No\n")):
        _write(f"{tmp_dir}/parts/part-{number:05d}.csv", text)
    rows = {r["viewObjectAttribute"]: r[ROW_INDEX] for r in load_mapping(spark, f"{tmp_dir}/parts", fmt="csv").mappings.collect()}
    assert rows["AttrA"] == 3 and rows["AttrZ"] == 7


def test_csv_reading_never_exchanges_text(spark, tmp_dir):
    _write(f"{tmp_dir}/plain.csv", SHEET_CSV)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load_mapping(spark, f"{tmp_dir}/plain.csv", fmt="csv").mappings._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_save_table_over_itself(spark, tmp_dir):
    from sheetwright.sinks.tables import save_table

    for path in (None, f"{tmp_dir}/own"):
        save_table(spark.range(10).toDF("v"), "own_rows", path)
        save_table(spark.table("own_rows").filter("v < 4"), "own_rows", path)
        assert spark.table("own_rows").count() == 4
    with pytest.raises(Exception):  # a failing write leaves the table as it was
        save_table(spark.table("own_rows").select(F.raise_error(F.lit("no")).alias("v")), "own_rows", f"{tmp_dir}/own")
    assert spark.table("own_rows").count() == 4
    spark.sql("DROP TABLE own_rows")


def test_views_outlive_the_session(spark, tmp_dir):
    from sheetwright.plans.mapping import MappingLoad, store_mapping
    from sheetwright.plans.registry import _mappings
    from sheetwright.sources.fixtures import SHEET_COLUMNS, SHEET_FLAGS

    store_mapping(MappingLoad(_mappings(spark, SF_SMALL), SHEET_COLUMNS, SHEET_FLAGS), "mappings", f"{tmp_dir}/m")
    other = spark.newSession()
    assert other.table("mappingsTables").count() == spark.table("mappingsTables").count() > 0
    assert other.table("mappingsPkCols").filter("colCntPK = 0 AND rowIndex IS NULL").count() > 0


def test_write_many_refuses_clashing_names_and_reads_its_target(spark, tmp_dir):
    a, b = spark.range(3), spark.range(2)
    for names in (["Q1/A", "Q1A"], ["???", "x"], [".", "x"]):
        with pytest.raises(ValueError):
            write_many([a, b], f"{tmp_dir}/clash", names=names)
    assert not os.path.exists(f"{tmp_dir}/clash")
    write_many([a, b], f"{tmp_dir}/self", names=["a", "b"])
    old = spark.read.parquet(f"{tmp_dir}/self/a").filter("id > 0")
    assert set(write_many([old, b], f"{tmp_dir}/self", names=["b", "c"])) == {"b", "c"}
    assert sorted(os.listdir(f"{tmp_dir}/self")) == ["b", "c"]
    assert spark.read.parquet(f"{tmp_dir}/self/b").count() == 2
    assert os.listdir(tmp_dir) == ["self"]


def test_malformed_json_raises(spark, tmp_dir):
    from sheetwright.sources.json_records import read_json_document_lines

    schema = "a long, b string"
    _write(f"{tmp_dir}/cut.json", '[{"a": 1, "b": "x"}, {"a": 2, "b"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_records(spark, f"{tmp_dir}/cut.json", schema=schema).collect()
    _write(f"{tmp_dir}/pretty.json", json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], indent=1))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_document_lines(spark, f"{tmp_dir}/pretty.json", schema).collect()
    assert read_json_records(spark, f"{tmp_dir}/pretty.json", schema=schema).count() == 2


def test_null_keys_stay_in_json(spark, tmp_dir):
    from sheetwright.functions.jsonfmt import record_json
    from sheetwright.operators.records import flatten_records

    df = spark.createDataFrame([(1, None, [(None, 1)])], "a int, b string, k array<struct<x:int,y:int>>")
    assert df.select(record_json(df.columns, df.schema)).first()[0] == '{"a":1,"b":null,"k":[{"x":null,"y":1}]}'
    assert flatten_records(df).first()["k"] == '[{"x":null,"y":1}]'
    write_json(df, f"{tmp_dir}/kept", simplify=False)
    write_json(df, f"{tmp_dir}/simple")
    texts = [spark.read.text(f"{tmp_dir}/{n}").first()[0] for n in ("kept", "simple")]
    assert texts == ['{"a":1,"b":null,"k":[{"x":null,"y":1}]}', '{"a":1,"k":"[{\\"x\\":null,\\"y\\":1}]"}']
    for keep_order in (True, False):
        write_json(df.filter("a > 1"), f"{tmp_dir}/none.json", layout="document", keep_order=keep_order)
        assert spark.read.text(f"{tmp_dir}/none.json").collect() == [("[]",)]


def test_parquet_sheet_nan_cells_are_null(spark, tmp_dir):
    """Typed exports (names given): numbers become text cells, NaN becomes an empty (null) cell."""
    rows = [("Title", None, None), ("x", float("nan"), "Yes"), ("y", 2.5, "No")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b double, c string")
    df.orderBy("i").drop("i").coalesce(1).write.parquet(f"{tmp_dir}/typed")
    data, names = read_sheet(spark, f"{tmp_dir}/typed", names=["name", "weight", "flag"])
    got = {r["name"]: (r["weight"], r["rowIndex"]) for r in data.collect()}
    assert got == {"x": (None, 0), "y": ("2.5", 1)}


def test_offsets_of_few_and_of_many_files_agree(spark, tmp_dir, monkeypatch):
    from sheetwright.sources import sheets

    os.makedirs(f"{tmp_dir}/parts")
    for i in range(12):
        _write(f"{tmp_dir}/parts/part-{i:05d}.csv", "".join(f"a{i},{j}\n" for j in range(i % 4)))
    few = {(r["_line"], r["_c0"], r["_c1"]) for r in sheets.positioned_lines(spark, f"{tmp_dir}/parts", "csv").collect()}
    monkeypatch.setattr(sheets, "FEW_FILES", 3)
    many = {(r["_line"], r["_c0"], r["_c1"]) for r in sheets.positioned_lines(spark, f"{tmp_dir}/parts", "csv").collect()}
    want = [(f"a{i}", str(j)) for i in range(12) for j in range(i % 4)]
    assert few == many == {(n, *cells) for n, cells in enumerate(want)}
