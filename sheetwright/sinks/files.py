"""File sinks: JSON records (S6) with the output size guard (S7), named datasets (S8), dated snapshots."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import DATASET_NAME_PATTERN, OUTPUT_MB_LIMIT, SNAPSHOT_PREFIX_FORMAT
from ..functions.jsonfmt import record_json
from ..functions.naming import slugify, text_values
from ..operators.records import flatten_records
from ..session import scratch_path

#: Bytes that a record takes in a document beside its text (a comma and two line breaks), and that the brackets take.
_SEPARATOR, _BRACKETS = 3, 4
MANIFESTS = "_manifests"


def json_text(df: DataFrame, pretty: bool = False, drop_nulls: bool = False) -> DataFrame:
    """One column ``json``: each record's JSON text (F7 rules); ``drop_nulls`` leaves out null keys (cleaned records)."""
    return df.select(record_json(df.columns, df.schema, pretty, drop_nulls).alias("json"))


def json_output_size(df: DataFrame, limit_mb: int = OUTPUT_MB_LIMIT, drop_nulls: bool = False) -> DataFrame:
    """Total JSON text size and the number of files that keeps each under ``limit_mb``.

    One aggregate over the data; the result is one row.
    """
    sized = json_text(df, drop_nulls=drop_nulls).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.length("json")), F.lit(0)).cast("long").alias("chars"),
    )
    return sized.select(
        "records",
        "chars",
        (F.col("chars") / F.lit(1_000_000.0)).alias("size_mb"),
        F.greatest(F.lit(1), F.ceil(F.col("chars") / F.lit(limit_mb * 1_000_000.0))).cast("long").alias("files"),
    )


def _document_lines(batches):
    """Per partition: wrap the record texts into one JSON list document, one record per line."""
    first, pending = True, None
    for pdf in batches:
        texts = pdf["json"]
        if texts.empty:
            continue
        if pending is not None:
            yield pd.DataFrame({"value": [pending]})
        lines = (",\n" + texts).tolist()
        if first:
            lines[0] = "[\n" + texts.iloc[0]
            first = False
        pending = lines.pop()
        if lines:
            yield pd.DataFrame({"value": lines})
    if pending is not None:
        yield pd.DataFrame({"value": [pending + "\n]"]})


def _offsets(batches):
    """Per partition: each text with the partition, its place there, its size in a document and the sizes before it."""
    part, at, begin = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = pc.add(pc.binary_length(batch.column("json")), _SEPARATOR).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = begin + np.cumsum(size)
        n = len(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column("json"), pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n)), pa.array(size), pa.array(ends - size)],
            names=["json", "_part", "_at", "_size", "_begin"])
        at, begin = at + n, int(ends[-1]) if n else begin


def ordered_documents(texts: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """(rows (json), number of documents): the texts in the order of the input's partitions, one partition for each document.

    Sizes are summed inside the partitions, then over the partitions (one row
    each), so every text knows the bytes before it in the whole output.  The
    output is cut every ``limit - longest`` bytes and a document takes the
    texts that begin in its stretch: none is longer than ``limit`` bytes, but
    for one that holds a single text longer than that.
    """
    spark = texts.sparkSession
    schema = "json string, _part int, _at bigint, _size bigint, _begin bigint"
    sized_path = scratch_path(spark, "document-texts")
    texts.mapInArrow(_offsets, schema).write.parquet(sized_path)
    sized = spark.read.schema(schema).parquet(sized_path)
    room = limit - _BRACKETS
    longest = sized.where(F.col("_size") <= room).agg(F.coalesce(F.max("_size"), F.lit(0))).first()[0]
    stretch = max(1, room - longest + 1)
    parts = sized.groupBy("_part").agg(F.sum("_size").alias("_bytes"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = parts.select("_part", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_before"))
    placed = sized.join(F.broadcast(offsets), "_part").withColumn("_stretch", F.floor((F.col("_before") + F.col("_begin")) / stretch))
    numbers = placed.select("_stretch").distinct().select("_stretch", (F.row_number().over(Window.orderBy("_stretch")) - 1).alias("_doc"))
    numbers_path = scratch_path(spark, "document-numbers")
    numbers.write.parquet(numbers_path)  # one row a document
    numbers = spark.read.parquet(numbers_path)
    n = numbers.count()
    docs = placed.join(numbers, "_stretch").repartitionById(max(1, n), "_doc").sortWithinPartitions("_part", "_at")
    return docs.select("json"), n


def write_json(df: DataFrame, path: str, simplify: bool = True, layout: str = "lines",
               limit_mb: float | None = OUTPUT_MB_LIMIT, keep_order: bool = False, pretty: bool = False) -> str:
    """Write records as JSON (S6): flatten + clean first by default.

    ``layout='lines'``: JSON Lines (splittable, the scale form).
    ``layout='document'``: each part file is one JSON list document, as the
    original tool wrote; the number of files is chosen so that each holds
    about ``limit_mb`` MB of text or less (S7).  With ``keep_order`` the
    documents follow the order of the input's partitions (a range-sorted input,
    e.g. after ``orderBy``, gives files in order), cut so that none holds more
    than ``limit_mb`` MB; without a limit each partition is one document.
    ``pretty`` indents each record in a document (such documents are read
    back with ``read_json_records(document=True)``).
    """
    data = flatten_records(df) if simplify else df
    if layout == "lines":
        # the cleaner's dropped keys are nulls here; without it a null is a value and stays
        data.write.mode("overwrite").option("ignoreNullFields", str(simplify).lower()).json(path)
        return path
    if layout != "document":
        raise ValueError(f"unknown layout: {layout}")
    texts = json_text(data, pretty, drop_nulls=simplify)
    if limit_mb and not keep_order:
        size = json_output_size(data, limit_mb, drop_nulls=simplify).first()
        records, texts = size["records"], texts.repartition(int(size["files"]))
    elif limit_mb:
        texts, records = ordered_documents(texts, int(limit_mb * 1_000_000))
    else:
        records = len(texts.take(1))
    if not records:  # a document without records is an empty list
        df.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path
    docs = texts.mapInPandas(_document_lines, "value string")
    docs.write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def dated_name(name: str, on: dt.date | None = None) -> str:
    """``VYYYY.MM.DD__name`` for the given day (today when not given)."""
    on = on or dt.date.today()
    return f"{on.strftime(SNAPSHOT_PREFIX_FORMAT)}{name}"


def dated_path(path: str, on: dt.date | None = None) -> str:
    """The path with its last element prefixed by the snapshot date."""
    head, _, leaf = path.rstrip("/").rpartition("/")
    return f"{head}/{dated_name(leaf, on)}" if head else dated_name(leaf, on)


def write_snapshot(df: DataFrame, target: str, on: dt.date | None = None, fmt: str = "parquet",
                   column: str = "snapshot_date") -> str:
    """Dated snapshot as a partition of one dataset (S9): only that day's partition is replaced."""
    on = on or dt.date.today()
    dated = df.withColumn(column, F.lit(on.isoformat()).cast("date"))
    return write_partitioned_datasets(dated, target, column, fmt)


def export_path(folder: str, name: str, dated: bool = False, on: dt.date | None = None) -> str:
    """``folder/<slug(name)>``, with ``.json`` when the slug has no suffix, optionally date-prefixed."""
    leaf, = text_values(SparkSession.active(), slugify, [name])
    if "." not in leaf.lstrip("."):
        leaf = f"{leaf}.json"
    if dated:
        leaf = dated_name(leaf, on)
    return f"{folder.rstrip('/')}/{leaf}"


def dataset_names(n: int, names: Sequence[str] | None) -> list[str]:
    """Given names when there is one per dataset, else ``Sheet i of n`` for all of them."""
    if not names or len(names) != n:
        return [DATASET_NAME_PATTERN.format(i=i + 1, n=n) for i in range(n)]
    return list(names)


def _file_system(spark: SparkSession, path: str):
    """(file system, Path class) of ``path``."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def write_many(datasets: Sequence[DataFrame | None], target: str, names: Sequence[str] | None = None,
               overwrite: bool = True, drop_null_cols: bool = False, fmt: str = "parquet") -> dict[str, str]:
    """Write each dataset to ``target/<slug(name)>`` (S8); empty or missing datasets are skipped.

    ``overwrite=True`` replaces the whole target; ``False`` replaces only the
    members being written.  All members are written beside the target first
    and moved in at the end, so a dataset may read what it replaces and a
    failed write changes nothing.  Names whose slugs are empty or equal raise.
    Emptiness is checked with a one-row probe per dataset, not a count.
    Readers may meet the target between two moves; ``publish_many`` has no
    such moment.
    """
    from ..operators.nulls import drop_null_columns, fill_text

    target = target.rstrip("/")
    present = _present(datasets, names)
    if not present:
        return {}
    spark = present[0][0].sparkSession
    beside = f"{target}.new-{uuid.uuid4().hex[:12]}"
    written = {}
    for df, label, slug in present:
        if df.isEmpty():
            continue
        out = fill_text(drop_null_columns(df) if drop_null_cols else df)
        writer = out.write.format(fmt)
        if fmt == "csv":  # a sheet-like text export: header line first
            writer = writer.option("header", "true")
        writer.save(f"{beside}/{slug}")
        written[label] = slug
    fs, path = _file_system(spark, target)
    if overwrite:
        fs.delete(path(target), True)
    fs.mkdirs(path(target))
    for slug in written.values():
        fs.delete(path(f"{target}/{slug}"), True)
        if not fs.rename(path(f"{beside}/{slug}"), path(f"{target}/{slug}")):
            raise OSError(f"could not move {beside}/{slug} to {target}/{slug}")
    fs.delete(path(beside), True)
    return {label: f"{target}/{slug}" for label, slug in written.items()}


def _present(datasets: Sequence[DataFrame | None], names: Sequence[str] | None) -> list[tuple[DataFrame, str, str]]:
    """(dataset, name, slug) of the datasets given; names whose slugs are empty or equal raise."""
    present = [(df, label) for df, label in zip(datasets, dataset_names(len(datasets), names)) if df is not None]
    if not present:
        return []
    slugs = text_values(present[0][0].sparkSession, slugify, [label for _, label in present])
    if not all(s.strip(".") for s in slugs) or len(set(slugs)) != len(slugs):
        raise ValueError(f"dataset names do not give distinct folder names: {[label for _, label in present]} -> {slugs}")
    return [(df, label, slug) for (df, label), slug in zip(present, slugs)]


def publish_many(datasets: Sequence[DataFrame | None], target: str, names: Sequence[str] | None = None, overwrite: bool = True,
                 drop_null_cols: bool = False, fmt: str = "parquet", keep: int = 1) -> dict[str, str]:
    """Write a set of datasets that readers see as a whole or not at all (S8); returns the folder of each by name.

    Every member goes to a version folder of its own, ``target/<slug>/v-...``,
    and the set is what the newest whole manifest lists.  The manifest is one
    small file, written last and under a new name, so nothing is renamed or
    replaced: a failure at any step leaves the old set as it was, also where a
    rename is a copy.  ``overwrite=False`` keeps the members of the set that
    are not written now.  Empty or missing datasets are skipped.  Versions
    that none of the last ``keep`` + 1 sets lists are removed at the end, so a
    reader of the set before goes on undisturbed.  Read with ``read_many``.
    """
    from ..operators.nulls import drop_null_columns, fill_text

    target = target.rstrip("/")
    present = _present(datasets, names)
    if not present:
        return {}
    spark = present[0][0].sparkSession
    old = {} if overwrite else dict(_manifest(spark, target)["members"])
    version, members = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", {}
    for df, label, slug in present:
        if df.isEmpty():
            continue
        out = fill_text(drop_null_columns(df) if drop_null_cols else df)
        writer = out.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.save(f"{target}/{slug}/{version}")
        members[label] = {"path": f"{slug}/{version}", "format": fmt}
    taken = {m["path"].split("/")[0] for m in members.values()}
    kept = {label: m for label, m in old.items() if m["path"].split("/")[0] not in taken}
    _write_manifest(spark, target, {"members": kept | members, "whole": True})
    _remove_unlisted(spark, target, keep)
    return {label: f"{target}/{m['path']}" for label, m in (kept | members).items()}


def read_many(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The datasets of the newest set that ``publish_many`` wrote to ``target``, by name."""
    out = {}
    for label, member in _manifest(spark, target.rstrip("/"))["members"].items():
        reader = spark.read.format(member["format"])
        if member["format"] == "csv":
            reader = reader.option("header", "true")
        out[label] = reader.load(f"{target.rstrip('/')}/{member['path']}")
    return out


def _manifest_numbers(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the manifests of ``target``, newest first."""
    fs, path = _file_system(spark, target)
    folder = path(f"{target}/{MANIFESTS}")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((int(n[2:-5]) for n in names if n.startswith("m-") and n.endswith(".json") and n[2:-5].isdigit()), reverse=True)


def _manifest_path(target: str, number: int) -> str:
    return f"{target}/{MANIFESTS}/m-{number:012d}.json"


def _read_manifest(spark: SparkSession, target: str, number: int) -> dict | None:
    """A manifest, or None if its writer did not finish it."""
    found = spark.read.text(_manifest_path(target, number), wholetext=True).first()
    try:
        manifest = json.loads(found[0]) if found else {}
    except ValueError:
        return None
    return manifest if manifest.get("whole") else None


def _manifest(spark: SparkSession, target: str) -> dict:
    """The newest whole manifest of ``target``; an empty set if there is none."""
    for number in _manifest_numbers(spark, target):
        if manifest := _read_manifest(spark, target, number):
            return manifest
    return {"members": {}}


def _write_manifest(spark: SparkSession, target: str, manifest: dict) -> None:
    """Write the next manifest; another writer's manifest of that number raises."""
    fs, path = _file_system(spark, target)
    number = next(iter(_manifest_numbers(spark, target)), 0) + 1
    out = fs.create(path(_manifest_path(target, number)), False)
    try:
        out.write(bytearray(json.dumps(manifest, ensure_ascii=False).encode()))
    finally:
        out.close()


def _remove_unlisted(spark: SparkSession, target: str, keep: int) -> None:
    """Remove manifests before the last ``keep`` + 1 whole ones, and the versions written before the newest that none of these lists."""
    fs, path = _file_system(spark, target)
    whole = [(n, m) for n in _manifest_numbers(spark, target) if (m := _read_manifest(spark, target, n))][: keep + 1]
    listed = {m["path"] for _, found in whole for m in found["members"].values()}
    newest = max(p.split("/")[1] for p in listed) if listed else ""
    for member in fs.listStatus(path(target)):
        slug = member.getPath().getName()
        if not member.isDirectory() or slug == MANIFESTS:
            continue
        versions = [v.getPath() for v in fs.listStatus(member.getPath())]
        gone = [v for v in versions if v.getName().startswith("v-") and v.getName() < newest and f"{slug}/{v.getName()}" not in listed]
        for v in gone:
            fs.delete(v, True)
        if len(gone) == len(versions):
            fs.delete(member.getPath(), True)
    for n in _manifest_numbers(spark, target):
        if whole and n < whole[-1][0]:
            fs.delete(path(_manifest_path(target, n)), False)


def write_partitioned_datasets(df: DataFrame, target: str, by: str, fmt: str = "parquet") -> str:
    """Same-schema datasets as partitions of one target; only the partitions present are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(by).format(fmt).save(target))
    return target
