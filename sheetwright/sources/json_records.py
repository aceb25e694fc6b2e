"""JSON record files into a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.nulls import fill_text
from .json_documents import document_records


def _check_json_path(spark: SparkSession, path: str) -> None:
    """A missing path is an error; an existing file must be ``.json``; folders and globs pass."""
    if any(ch in path for ch in "*?[{"):
        return
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        raise FileNotFoundError(path)
    if fs.getFileStatus(hp).isFile() and not path.lower().endswith(".json"):
        raise ValueError(f"not a .json file: {path}")


def read_json_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
                      document: bool = True, fill: bool = True) -> DataFrame:
    """Records from JSON files; text nulls become '' (S1).

    ``document=True``: each file is one JSON document — a list of records
    (one row each) or a single record (one row); an empty list gives no
    rows.  Each document is parsed by one task.  ``document=False`` reads
    JSON Lines, which Spark splits across tasks (the scale form).
    Files must end in ``.json`` (folders and globs pass); missing paths and
    malformed documents raise.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        _check_json_path(spark, p)
    reader = spark.read.option("multiLine", "true" if document else "false").option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(paths)
    return fill_text(df) if fill else df


def read_json_document_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
                             fill: bool = True) -> DataFrame:
    """Records from JSON list documents that hold one record per line (as ``write_json`` writes them).

    Such a document is read line by line, so Spark splits it across tasks:
    the bracket lines are skipped and each record line loses its list
    punctuation before ``from_json``.  Documents laid out otherwise (records
    spanning lines) raise; they need ``read_json_records(document=True)``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select(F.trim("value").alias("v"))
    body = F.regexp_replace(F.regexp_replace("v", r"^\[\s*", ""), r"\s*[,\]]?\s*\]?$", "")
    records = (lines.select(body.alias("v")).filter(F.col("v") != "")
               .select(F.from_json("v", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*"))
    return fill_text(records) if fill else records


def read_json_documents(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, fill: bool = True) -> DataFrame:
    """Records of JSON documents of any layout, each document read by as many tasks as it has file blocks.

    The same rows as ``read_json_records(document=True)`` gives (in no fixed
    order): a list of records, or one record, in each file, pretty-printed or
    on one line.  Documents must be uncompressed UTF-8 and their list elements
    records; malformed ones raise.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        _check_json_path(spark, p)
    parsed = document_records(spark, paths).select(F.from_json("_json", schema, {"mode": "FAILFAST"}).alias("r"))
    records = parsed.select("r.*")
    return fill_text(records) if fill else records
