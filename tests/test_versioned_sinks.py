"""Tables and dataset sets that readers never find missing (S4, S8), ordered documents of bounded size."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sheetwright.sinks import files
from sheetwright.sinks.files import ordered_documents, publish_many, read_many, write_json
from sheetwright.sinks.tables import quoted, save_table


@pytest.fixture()
def table(spark):
    name = "replaced_rows"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- tables ---------------------------------------------------------------------


def test_a_reader_always_finds_a_whole_table(spark, tmp_dir, table):
    save_table(spark.range(100).toDF("v"), table, f"{tmp_dir}/t", keep=100)
    seen, errors, done = set(), [], threading.Event()

    def read():
        other = spark.newSession()
        while not done.is_set():
            try:
                other.catalog.refreshTable(table)
                seen.add(other.table(table).count())
            except Exception as e:  # noqa: BLE001
                errors.append(str(e)[:300])

    threads = [threading.Thread(target=read) for _ in range(2)]
    for t in threads:
        t.start()
    for i in range(2, 8):
        save_table(spark.range(100 * i).toDF("v"), table, f"{tmp_dir}/t", keep=100)
    done.set()
    for t in threads:
        t.join()
    assert not errors and seen <= {100 * i for i in range(1, 8)} and spark.table(table).count() == 700


def test_old_versions_are_removed(spark, tmp_dir, table):
    for i in range(5):
        save_table(spark.range(i + 1).toDF("v"), table, f"{tmp_dir}/t")
        assert len(os.listdir(f"{tmp_dir}/t")) == min(i + 1, 2)
    save_table(spark.range(9).toDF("v"), table, f"{tmp_dir}/t", keep=0)
    assert len(os.listdir(f"{tmp_dir}/t")) == 1 and spark.table(table).count() == 9


def test_a_running_reader_keeps_its_version(spark, tmp_dir, table):
    save_table(spark.range(50).toDF("v"), table, f"{tmp_dir}/t")
    reader = spark.table(table).selectExpr("sum(v) AS s")
    reader._jdf.queryExecution().executedPlan()  # planned before the switch
    save_table(spark.range(5).toDF("v"), table, f"{tmp_dir}/t")
    assert reader.first()["s"] in (1225, 10)


def test_schema_changes(spark, tmp_dir, table):
    save_table(spark.range(3).toDF("a"), table, f"{tmp_dir}/t")
    spark.sql(f"CREATE OR REPLACE VIEW replaced_view AS SELECT sum(a) AS s FROM {table}")
    save_table(spark.range(4).selectExpr("id AS a", "cast(id AS string) AS `b c`"), table, f"{tmp_dir}/t")  # a column more
    assert spark.table(table).columns == ["a", "b c"] and spark.table("replaced_view").first()["s"] == 6
    save_table(spark.range(5).selectExpr("id + 0.5 AS a"), table, f"{tmp_dir}/t")  # another type, a column less
    assert dict(spark.table(table).dtypes)["a"].startswith("decimal") and spark.table(table).count() == 5
    save_table(spark.range(2).toDF("z"), table, f"{tmp_dir}/t", fmt="orc")  # another format
    assert spark.table(table).columns == ["z"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}_")]
    spark.sql("DROP VIEW replaced_view")


def test_a_failed_write_leaves_the_table_and_no_folder(spark, tmp_dir, table):
    save_table(spark.range(3).toDF("v"), table, f"{tmp_dir}/t")
    with pytest.raises(Exception, match="broken"):
        save_table(spark.table(table).select(F.raise_error(F.lit("broken")).cast("bigint").alias("v")), table, f"{tmp_dir}/t")
    assert spark.table(table).count() == 3 and len(os.listdir(f"{tmp_dir}/t")) == 1


def test_tables_of_other_databases(spark, tmp_dir):
    assert quoted("db.t") == "`db`.`t`" and quoted("t") == "`t`" and quoted("`a.b`") == "`a.b`"
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    for n in (3, 4):
        save_table(spark.range(n).toDF("v"), "other_db.rows", f"{tmp_dir}/t")
        assert spark.table("other_db.rows").count() == n
    save_table(spark.range(2).toDF("w"), "other_db.rows", f"{tmp_dir}/t")
    assert spark.table("other_db.rows").columns == ["w"]
    spark.sql("DROP DATABASE other_db CASCADE")


# --- sets of datasets -----------------------------------------------------------


def _set(spark, target):
    return {k: sorted(r[0] for r in df.collect()) for k, df in read_many(spark, target).items()}


def test_a_set_is_replaced_as_a_whole(spark, tmp_dir):
    target = f"{tmp_dir}/set"
    assert read_many(spark, target) == {} == publish_many([], target)
    out = publish_many([spark.range(3), spark.range(0), None, spark.range(2)], target, names=["A a", "empty", "none", "B"])
    assert list(out) == ["A a", "B"] and _set(spark, target) == {"A a": [0, 1, 2], "B": [0, 1]}
    assert spark.read.parquet(out["A a"]).count() == 3
    publish_many([spark.range(1), spark.range(5)], target, names=["B", "C"], overwrite=False)
    assert {k: len(v) for k, v in _set(spark, target).items()} == {"A a": 3, "B": 1, "C": 5}
    publish_many([read_many(spark, target)["C"].where("id > 2")], target, names=["only"])  # reads what it replaces
    assert _set(spark, target) == {"only": [3, 4]}
    publish_many([spark.createDataFrame([(1, None)], "a int, b string")], target, names=["m"], fmt="csv")
    assert [r["a"] for r in read_many(spark, target)["m"].collect()] == ["1"]


def test_a_failure_at_any_step_leaves_the_old_set(spark, tmp_dir, monkeypatch):
    target = f"{tmp_dir}/set"
    publish_many([spark.range(3), spark.range(2)], target, names=["a", "b"])
    old = _set(spark, target)
    bad = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):  # the second member's write
        publish_many([spark.range(9), bad], target, names=["a", "b"])
    assert _set(spark, target) == old

    def fails(*_):
        raise OSError("the manifest cannot be written")

    with monkeypatch.context() as m:
        m.setattr(files, "_write_manifest", fails)
        with pytest.raises(OSError):
            publish_many([spark.range(9)], target, names=["a"])
    assert _set(spark, target) == old
    cut = files._manifest_path(target, 2)  # a writer that stopped half way through the manifest
    with open(cut, "w") as f:
        f.write('{"members": {"a": {"path": "a/v-')
    assert _set(spark, target) == old
    with monkeypatch.context() as m:  # the clean-up after the switch
        m.setattr(files, "_remove_unlisted", fails)
        with pytest.raises(OSError):
            publish_many([spark.range(7)], target, names=["a"])
    assert {k: len(v) for k, v in _set(spark, target).items()} == {"a": 7}
    publish_many([spark.range(1)], target, names=["z"], keep=0)
    assert _set(spark, target) == {"z": [0]} and sorted(os.listdir(target)) == ["_manifests", "z"]
    assert [n for n in os.listdir(f"{target}/_manifests") if n.endswith(".json")] == ["m-000000000004.json"]


def test_a_reader_of_the_set_before_goes_on(spark, tmp_dir):
    target = f"{tmp_dir}/set"
    publish_many([spark.range(3)], target, names=["a"])
    before = read_many(spark, target)["a"]
    publish_many([spark.range(30)], target, names=["a"])
    assert before.count() == 3 and read_many(spark, target)["a"].count() == 30
    publish_many([spark.range(300)], target, names=["a"])
    assert len(os.listdir(f"{target}/a")) == 2


def test_two_writers_do_not_overwrite_each_others_set(spark, tmp_dir, monkeypatch):
    target = f"{tmp_dir}/set"
    publish_many([spark.range(3)], target, names=["a"])
    monkeypatch.setattr(files, "_manifest_numbers", lambda *_: [])  # the other's manifest came in between
    with pytest.raises(Exception, match="(?i)exist"):
        publish_many([spark.range(9)], target, names=["a"])
    monkeypatch.undo()
    assert _set(spark, target) == {"a": [0, 1, 2]}


def test_names_that_clash(spark, tmp_dir):
    with pytest.raises(ValueError, match="distinct"):
        publish_many([spark.range(1), spark.range(1)], f"{tmp_dir}/s", names=["Q1/A", "Q1A"])


# --- ordered documents ----------------------------------------------------------


def _documents(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    texts = [open(os.path.join(path, n), encoding="utf-8").read() for n in names]
    return texts, [r for t in texts for r in json.loads(t)]


@pytest.mark.parametrize("limit", [300, 5_000, 40_000, 10_000_000])
def test_documents_keep_order_below_the_limit(spark, tmp_dir, limit):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderpriority", F.expr("repeat('é', o_custkey % 40)").alias("pad"))
    ordered = orders.orderBy("o_orderkey", "o_orderpriority", "pad")
    out = write_json(ordered, f"{tmp_dir}/o", simplify=False, layout="document", keep_order=True, limit_mb=limit / 1e6)
    texts, records = _documents(out)
    assert [(r["o_orderkey"], r["o_orderpriority"], r["pad"]) for r in records] == [tuple(r) for r in ordered.collect()]
    sizes = [len(t.encode()) for t in texts]
    assert max(sizes) <= limit
    longest = max(len(json.dumps(r, ensure_ascii=False, separators=(",", ":")).encode()) for r in records) + 3
    assert len(texts) <= sum(sizes) // (limit - longest - 4) + 1


def test_a_text_longer_than_the_limit_and_empty_output(spark, tmp_dir):
    rows = [(i, "x" * (5000 if i == 7 else 20)) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, s string").orderBy("i")
    texts, records = _documents(write_json(df, f"{tmp_dir}/long", simplify=False, layout="document", keep_order=True, limit_mb=0.0004))
    assert [(r["i"], r["s"]) for r in records] == rows
    assert all(len(t) <= 400 or '"i":7' in t for t in texts)
    texts, records = _documents(write_json(df.where("i > 99"), f"{tmp_dir}/none", layout="document", keep_order=True, limit_mb=1))
    assert records == [] and len(texts) == 1


def test_input_partitions_without_order_are_kept(spark, tmp_dir):
    df = spark.range(1000).repartition(7).selectExpr("id")
    docs, n = ordered_documents(df.selectExpr("concat('{\"id\":', id, '}') AS json"), 700)
    assert n == docs.rdd.getNumPartitions() and n > 10
    assert sorted(json.loads(r["json"])["id"] for r in docs.collect()) == list(range(1000))
