"""Table and view sinks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    """A table name for SQL; the parts of ``db.table`` are quoted each, parts that are quoted already stay."""
    if name.startswith("`"):
        return name
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet", keep: int = 1) -> str:
    """Replace table ``name`` with ``df`` (S4), which may itself read that table.

    Each save writes a version folder below ``path`` (without one, below a
    folder of the warehouse) and then switches the table's location, so a
    reader finds the old rows or the new ones and never no table.  New columns
    at the end are added before the switch; only a change that drops, moves or
    retypes columns, for which the catalog has no such switch, swaps two
    tables by renaming.  A failed write leaves the table as it was.  The last
    ``keep`` versions before the new one stay for readers that still use them;
    older ones are removed.
    """
    spark = df.sparkSession
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/_versions/{name.replace('`', '')}").rstrip("/")
    version = f"{base}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.format(fmt).save(version)
    except Exception:
        _remove(spark, version)
        raise
    schema = spark.read.format(fmt).schema(df.schema).load(version).schema
    table = quoted(name)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=version, source=fmt, schema=schema)
    elif _format(spark, table) == fmt and _extends(schema, spark.table(table).schema):
        _switch(spark, table, schema, version)
    else:
        _swap(spark, table, schema, version, fmt)
    _remove_versions(spark, base, version, keep)
    return name


def _format(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
    return found["data_type"].lower() if found else ""


def _extends(new: StructType, old: StructType) -> bool:
    """Whether ``new`` has the columns of ``old`` first, in name and type."""
    return len(new) >= len(old) and [(f.name, f.dataType) for f in new][: len(old)] == [(f.name, f.dataType) for f in old]


def _switch(spark: SparkSession, table: str, schema: StructType, version: str) -> None:
    """Point the table to another folder; readers see missing new columns as null until then."""
    more = schema.fields[len(spark.table(table).schema):]
    if more:
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in more)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)


def _swap(spark: SparkSession, table: str, schema: StructType, version: str, fmt: str) -> None:
    """Put another table in its place by two renames, one right after the other."""
    prefix, last = table.rpartition(".")[0], table.rpartition(".")[2].strip("`")
    mark = uuid.uuid4().hex[:8]
    new, old = (".".join(filter(None, [prefix, f"`{last}_{mark}_{x}`"])) for x in ("new", "old"))
    spark.catalog.createTable(new, path=version, source=fmt, schema=schema)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def _remove(spark: SparkSession, *folders: str) -> None:
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        make(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(make(folder), True)


def _remove_versions(spark: SparkSession, base: str, current: str, keep: int) -> None:
    """Remove the version folders of ``base`` before the last ``keep`` that came before ``current``."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = make(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = current.rpartition("/")[2]
    names = sorted(f.getPath().getName() for f in fs.listStatus(make(base)) if f.getPath().getName().startswith("v-"))
    earlier = [n for n in names if n < now]
    _remove(spark, *[f"{base}/{name}" for name in earlier[: max(0, len(earlier) - keep)]])


def save_view(df: DataFrame, name: str) -> str:
    """Replace the session view ``name`` (S5); views may be built over other views."""
    df.createOrReplaceTempView(name)
    return name


def save_sql_view(spark: SparkSession, name: str, sql: str, persistent: bool = False) -> str:
    """Replace view ``name`` defined by SQL text (S5); a persistent one stays in the catalog for other sessions."""
    if persistent:
        spark.catalog.dropTempView(name)  # a session view of that name would hide it
    spark.sql(f"CREATE OR REPLACE {'' if persistent else 'TEMPORARY '}VIEW {quoted(name)} AS {sql}")
    return name
