"""Dictionaries with dynamic keys as columns."""

import json

import pytest
from pyspark.sql import functions as F

from sheetwright.operators.records import discover_keys, flatten_records

SCHEMA = "id int, props map<string,string>, rec struct<tags: map<string,int>, n: int>, deep map<string,map<int,struct<x: double, l: array<string>>>>, many array<map<string,int>>"
ROWS = [
    (1, {"a": "x", "b": "", "c d.e": "y"}, ({"t1": 0, "t2": 5}, 1), {"k": {1: (1.5, ["p", "q"]), 2: None}}, [{"z": 1}]),
    (2, {"b": "None", "tick`": "v"}, (None, 2), {"k": {7: (0.0, [])}, "m": {}}, []),
    (3, None, None, None, None),
    (4, {}, ({}, None), {"q": {1: (None, ["only"])}}, None),
]


def python_rows(rows):
    """What the record walk gives: nested keys joined by '_', text lists by '>', empties gone."""
    def walk(value, name, out):
        if isinstance(value, dict):
            for k, v in value.items():
                walk(v, f"{name}_{k}", out)
        elif isinstance(value, list) and all(isinstance(x, str) for x in value):
            out[name] = ">".join(value)
        elif isinstance(value, list):
            out[name] = json.dumps(value, separators=(",", ":")) if value else None
        else:
            out[name] = value

    found = []
    for i, props, rec, deep, many in rows:
        out = {}
        walk(i, "id", out)
        walk(props or {}, "props", out)
        walk({} if rec is None else {"tags": rec[0] or {}, "n": rec[1]}, "rec", out)
        walk({k: {n: ({} if r is None else {"x": r[0], "l": r[1]}) for n, r in d.items()} for k, d in (deep or {}).items()}, "deep", out)
        walk(many or [], "many", out)
        found.append({k: v for k, v in out.items() if v not in (None, "", "None") and v != 0})
    return found


@pytest.fixture()
def records(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_discovered_keys_equal_python(records):
    out = flatten_records(records, keys="discover")
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in out.orderBy("id").collect()]
    want = python_rows(ROWS)
    assert got == want
    # what is empty in every record is no column, what a fixed record names is
    assert "props_b" not in out.columns and "deep_k_2_x" not in out.columns and "rec_tags_t1" not in out.columns
    assert {"props_a", "props_c d.e", "props_tick`", "rec_tags_t2", "rec_n", "deep_k_1_x", "deep_k_1_l", "deep_q_1_l"} <= set(out.columns)


def test_given_keys_open_only_what_they_name(records):
    out = flatten_records(records, keys={"props": ["a", "missing"], "rec_tags": ["t2"]})
    assert out.columns == ["id", "props_a", "props_missing", "rec_tags_t2", "rec_n", "deep", "many"]
    first = out.orderBy("id").first()
    assert (first["props_a"], first["props_missing"], first["rec_tags_t2"]) == ("x", None, 5) and json.loads(first["deep"])["k"]["1"]["x"] == 1.5
    assert flatten_records(records).columns == ["id", "props", "rec_tags", "rec_n", "deep", "many"]


def test_keys_with_empty_values_count_without_cleaning(records):
    assert discover_keys(records)["props"] == ["a", "c d.e", "tick`"]
    assert discover_keys(records, clean=False)["props"] == ["a", "b", "c d.e", "tick`"]
    assert discover_keys(records, clean=True, drop_zero=False)["rec_tags"] == ["t1", "t2"]


def test_too_many_keys_and_clashing_names_raise(spark):
    many = spark.range(50).select(F.create_map(F.concat(F.lit("k"), "id"), F.lit(1)).alias("m"))
    assert len(discover_keys(many, max_keys=50)["m"]) == 50
    with pytest.raises(ValueError, match="more than 49"):
        discover_keys(many, max_keys=49)
    clash = spark.createDataFrame([(1, {"b": 2})], "a_b int, a map<string,int>")
    with pytest.raises(ValueError, match="collide"):
        flatten_records(clash, keys="discover")
    cases = spark.createDataFrame([({"b": 2, "B": 3},)], "a map<string,int>")
    with pytest.raises(ValueError, match="collide"):
        flatten_records(cases, keys="discover")


def test_tables_without_dictionaries_or_rows(spark, records):
    assert discover_keys(spark.range(3)) == {}
    assert discover_keys(records.where("id > 9")) == {"props": [], "rec_tags": [], "deep": []}
    assert flatten_records(records.where("id > 9"), keys="discover").columns == ["id", "rec_n", "many"]


def test_keys_are_combined_before_the_shuffle(spark):
    """A key that all records share crosses once a task, whatever the number of records."""
    df = spark.range(0, 100_000, 1, 4).select(F.create_map(F.lit("hot"), F.col("id"), F.concat(F.lit("k"), F.col("id") % 5), F.lit(1).cast("bigint")).alias("m"))
    assert discover_keys(df)["m"] == ["hot", "k0", "k1", "k2", "k3", "k4"]
