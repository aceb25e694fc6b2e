"""JSON documents read block by block, against the reader that takes a document as one value."""

import json
import os
import random

import pytest

from sheetwright.sources import json_documents
from sheetwright.sources.json_records import read_json_documents, read_json_records

SCHEMA = "id long, name string, nested struct<a: long, text: string, list: array<struct<k: string, n: long>>>, words array<string>"
SIGNS = ['plain', 'quote " and \\', '{"not": "a record"}', "}}}]", "[[{", "\\\\\"}", "line\nbreak\ttab", "é日\U0001F600", "", "\\", "a,b}", " "]


@pytest.fixture()
def small_blocks(spark):
    """Files are read in splits of 2 KB."""
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def _record(rng, i):
    record = {"id": i, "name": rng.choice(SIGNS) * rng.randint(0, 3)}
    if rng.random() < 0.7:
        items = [{"k": rng.choice(SIGNS), "n": j} for j in range(rng.randint(0, 4))]
        record["nested"] = {"a": i, "text": rng.choice(SIGNS), "list": items}
    if rng.random() < 0.3:
        record["words"] = [rng.choice(SIGNS) for _ in range(rng.randint(0, 5))]
    if i % 97 == 5:  # longer than several blocks
        record["words"] = [rng.choice(SIGNS) + " " * 30 for _ in range(400)]
    return record


def _same(spark, path):
    got = read_json_documents(spark, path, SCHEMA).collect()
    want = read_json_records(spark, path, schema=SCHEMA, document=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


@pytest.mark.parametrize("layout", [{"indent": 2}, {}, {"separators": (",", ":"), "ensure_ascii": False}, {"indent": 1, "ensure_ascii": False}])
def test_every_layout_equals_the_whole_reader(spark, tmp_dir, small_blocks, layout):
    rng = random.Random(str(layout))
    records = [_record(rng, i) for i in range(300)]
    path = _write(f"{tmp_dir}/doc.json", json.dumps(records, **layout))
    got = _same(spark, path)
    assert sorted(r["id"] for r in got) == list(range(300))
    changes = json_documents.block_changes(json_documents.document_pieces(spark, [path]))
    assert changes.rdd.getNumPartitions() > 10 and changes.count() > 10


def test_only_border_records_are_stitched(spark, tmp_dir, small_blocks):
    path = _write(f"{tmp_dir}/doc.json", json.dumps([{"id": i, "name": "}" * 9} for i in range(3000)], indent=2))
    states = json_documents.block_states(json_documents.block_changes(json_documents.document_pieces(spark, [path])))
    found = json_documents.block_rows(json_documents.document_pieces(spark, [path]).join(states.drop("_size").hint("broadcast"), ["_file", "_blk"]))
    n = {r["_kind"]: r["count"] for r in found.groupBy("_kind").count().collect()}
    assert n["piece"] <= 2 * states.count() < n["record"] and n["end"] == 1
    assert n["record"] + json_documents.stitched(found).count() == 3000


def test_single_records_empty_lists_and_marks(spark, tmp_dir, small_blocks):
    folder = f"{tmp_dir}/docs"
    os.makedirs(folder)
    rng = random.Random(3)
    big = _record(rng, 5)
    texts = [json.dumps(big, indent=4), json.dumps(big), " \n[ ]\n", "[]", '  {"id": 1}\r\n\r\n', '\n[\n{"id": 2}\n]\n\n', '[{"id":3},{"id":4}]', "{}", "[{}, {}]"]
    for i, text in enumerate(texts):
        _write(f"{folder}/d{i}.json", text)
    assert len(_same(spark, folder)) == 9
    _write(f"{tmp_dir}/mark.json", '﻿[{"id": 7}]')
    assert [r["id"] for r in read_json_documents(spark, f"{tmp_dir}/mark.json", SCHEMA).collect()] == [7]
    _write(f"{tmp_dir}/none.json", "")
    assert read_json_documents(spark, f"{tmp_dir}/none.json", SCHEMA).collect() == []


def test_nulls_become_empty_texts_unless_kept(spark, tmp_dir):
    path = _write(f"{tmp_dir}/n.json", '[{"id": null, "name": null}, {"id": 1}]')
    assert [r["name"] for r in read_json_documents(spark, path, SCHEMA).collect()] == ["", ""]
    assert [r["name"] for r in read_json_documents(spark, path, SCHEMA, fill=False).collect()] == [None, None]


BROKEN = {
    "cut in a record": '[{"id": 1}, {"id": 2',
    "cut in a text": '[{"id": 1, "name": "ab}',
    "no closing bracket": '[{"id": 1}, {"id": 2}',
    "one bracket too many": '[{"id": 1}]]',
    "no comma": '[{"id": 1} {"id": 2}]',
    "two commas": '[{"id": 1},, {"id": 2}]',
    "comma at the end": '[{"id": 1}, ]',
    "a bare word": '[{"id": 1}, x, {"id": 2}]',
    "a number as record": '[{"id": 1}, 5]',
    "only numbers": "[1, 2]",
    "something after": '[{"id": 1}] x',
    "two documents": '{"id": 1}\n{"id": 2}',
    "not a document": "id, name\n1, x\n",
    "a bad record": '[{"id": 1}, {"id" 2}]',
    "a closing brace alone": "}",
    "open text at the end": '[{"id": 1}] "',
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_broken_documents_raise(spark, tmp_dir, name):
    path = _write(f"{tmp_dir}/broken.json", BROKEN[name])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_documents(spark, path, SCHEMA).collect()


def test_broken_deep_inside_raises(spark, tmp_dir, small_blocks):
    good = json.dumps([{"id": i, "name": "x" * 30} for i in range(1000)], indent=1)
    path = _write(f"{tmp_dir}/deep.json", good.replace('"id": 612,', '"id": 612, {'))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_documents(spark, path, SCHEMA).collect()


def test_more_blocks_than_are_broadcast(spark, tmp_dir, small_blocks, monkeypatch):
    monkeypatch.setattr(json_documents, "MAX_BROADCAST_ROWS", 2)
    rng = random.Random(11)
    _same(spark, _write(f"{tmp_dir}/doc.json", json.dumps([_record(rng, i) for i in range(200)], indent=2)))


def test_compressed_documents_and_missing_paths_raise(spark, tmp_dir):
    import gzip

    with gzip.open(f"{tmp_dir}/c.json.gz", "wt") as f:
        f.write(json.dumps([{"id": i} for i in range(100)]))
    with pytest.raises(ValueError):
        read_json_documents(spark, f"{tmp_dir}/c.json.gz", SCHEMA)
    with pytest.raises(ValueError, match="compressed"):
        read_json_documents(spark, f"{tmp_dir}/*.gz", SCHEMA)
    with pytest.raises(FileNotFoundError):
        read_json_documents(spark, f"{tmp_dir}/missing.json", SCHEMA)
