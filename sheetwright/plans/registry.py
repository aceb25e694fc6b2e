"""Registered queries: one per operator of the inventory, each over the given tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the tables; intermediate files go below the shared checkpoint
folder.  ``ORACLES`` (plans/oracles.py) holds the SQL twin of each query
that has one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import LEVELS, MAPPINGS_TABLE, OBJECT_VIEW, PK_VIEW, ROW_INDEX, TABLE
from ..functions.hashing import hash_files, hash_record, hash_text
from ..functions.jsonfmt import encode_list, join_list, python_json, record_json
from ..functions.naming import camel_case, slugify, split_camel_case
from ..operators.catalogue import distinct_collapse, object_rollup, pk_catalogue, pk_entries, pk_view, sort_catalogue
from ..operators.flags import drop_incomplete, yes_no_flags
from ..operators.nulls import drop_null_columns, fill_text
from ..operators.records import clean_empties, flatten_records
from ..operators.selection import non_flag_columns, pk_rows, run_sql, select_columns, select_from
from ..session import scratch_path
from ..sinks.files import dated_path, json_output_size, publish_many, read_many, write_json, write_many
from ..sinks.tables import save_table
from ..sources.fixtures import (SHEET_COLUMNS, SHEET_FLAGS, raw_mapping, table, write_mapping_csv,
                                write_mapping_sheet, write_mapping_sheets, write_mapping_variants)
from ..sources.json_records import read_json_documents, read_json_records
from ..sources.sheets import (apply_header, discover_header, header_frame, open_sheet, read_with_row_index,
                              sheet_headers)
from ..streaming.records import stream_record_export
from .mapping import MappingLoad, clean_mapping, export_records, load_mapping, load_mappings, store_mapping

# Snapshot day of the dated-snapshot query (a parameter, so results are reproducible).
SNAPSHOT_DAY = dt.date(2026, 1, 5)

Query = Callable[[SparkSession, str], DataFrame]


def _mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(raw_mapping(spark, sf_dir), SHEET_FLAGS)


def q_yes_no_flags(spark, sf_dir):
    return yes_no_flags(raw_mapping(spark, sf_dir), SHEET_FLAGS)


def q_drop_incomplete(spark, sf_dir):
    return drop_incomplete(yes_no_flags(raw_mapping(spark, sf_dir), SHEET_FLAGS), SHEET_FLAGS)


def q_split_path(spark, sf_dir):
    return _mappings(spark, sf_dir)


def q_fill_text(spark, sf_dir):
    return fill_text(raw_mapping(spark, sf_dir))


def q_select_columns(spark, sf_dir):
    m = _mappings(spark, sf_dir)
    return select_columns(m, non_flag_columns(m, SHEET_FLAGS))


def q_pk_filter(spark, sf_dir):
    return pk_rows(_mappings(spark, sf_dir))


def q_object_rollup(spark, sf_dir):
    return object_rollup(_mappings(spark, sf_dir))


def q_pk_view(spark, sf_dir):
    return pk_view(_mappings(spark, sf_dir))


def q_pk_catalogue(spark, sf_dir):
    return pk_catalogue(_mappings(spark, sf_dir))


def q_pk_entries(spark, sf_dir):
    return pk_entries(_mappings(spark, sf_dir))


def q_sorted_catalogue(spark, sf_dir):
    """The catalogue as a sink writes it in group-key order; ``position`` is where each record stands in the files."""
    path = scratch_path(spark, "sorted-catalogue")
    sort_catalogue(pk_catalogue(_mappings(spark, sf_dir))).write.parquet(path)
    return read_with_row_index(spark, path).withColumnRenamed(ROW_INDEX, "position")


def q_distinct_collapse(spark, sf_dir):
    return distinct_collapse(_mappings(spark, sf_dir), LEVELS, TABLE)


def q_row_index(spark, sf_dir):
    li = read_with_row_index(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return li.select("l_orderkey", "l_partkey", "l_linenumber", ROW_INDEX)


def q_mapping_load(spark, sf_dir):
    return load_mapping(spark, write_mapping_sheet(spark, sf_dir)).mappings


def q_mapping_load_csv(spark, sf_dir):
    return load_mapping(spark, write_mapping_csv(spark, sf_dir), fmt="csv").mappings


def q_read_sheet(spark, sf_dir):
    sheet = open_sheet(spark, write_mapping_sheet(spark, sf_dir))
    return apply_header(sheet.lines(), discover_header(sheet).names)


def q_discover_header(spark, sf_dir):
    return header_frame(open_sheet(spark, write_mapping_sheet(spark, sf_dir)))


def _sheet_name(c):
    """The sheet's folder name (the table it lists) from its path."""
    return F.regexp_extract(c, r"/(?:[^/=]*=)?([^/]+)$", 1)


def q_discover_sheet_headers(spark, sf_dir):
    return _header_cells(sheet_headers(spark, f"{write_mapping_sheets(spark, sf_dir)}/*", folders=True))


def q_discover_header_variants(spark, sf_dir):
    """The headers of sheets that differ in columns, in their order and in the line the header stands on."""
    return _header_cells(sheet_headers(spark, f"{write_mapping_variants(spark, sf_dir)}/*", folders=True))


def q_mapping_load_variants(spark, sf_dir):
    load = load_mappings(spark, f"{write_mapping_variants(spark, sf_dir)}/*", folders=True)
    return load.mappings.withColumn("sheet", _sheet_name(F.col("sheet")))


def _header_cells(heads):
    cells = heads.select(_sheet_name(F.col("sheet")).alias("sheet"), "headerLine",
                         F.posexplode(F.array("hdr.*")).alias("position", "headerText"))
    return cells.filter(F.col("headerText").isNotNull()).select(
        "sheet", F.col("position").cast("int").alias("position"), "headerText",
        camel_case(F.col("headerText")).alias("columnName"), F.col("headerLine").cast("int").alias("headerLine"))


def q_mapping_load_sheets(spark, sf_dir):
    load = load_mappings(spark, f"{write_mapping_sheets(spark, sf_dir)}/*", folders=True)
    return load.mappings.withColumn("sheet", _sheet_name(F.col("sheet")))


# --- scalar functions -----------------------------------------------------------

def q_camel_case(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", camel_case("o_orderpriority").alias("priorityName"))


def q_split_camel_case(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = camel_case(F.concat_ws(" ", "p_type", "p_name", "p_brand"))
    return part.select("p_partkey", name.alias("camel"), split_camel_case(name).alias("words"))


def q_slugify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", slugify("text").alias("slug"))


def q_hash_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", hash_text("text").alias("sha512"))


def q_hash_record(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", hash_record(orders).alias("sha512"))


def q_hash_text_256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hash_text("text", 256).alias("sha256"))


def q_hash_record_256(spark, sf_dir):
    orders = _orders_with_nulls(spark, sf_dir)
    return orders.select("o_orderkey", hash_record(orders, bits=256).alias("sha256"))


def q_python_json(spark, sf_dir):
    """The text that record hashes are taken of."""
    orders = _orders_with_nulls(spark, sf_dir)
    record = F.struct(*[F.col(c) for c in orders.columns])
    return orders.select("o_orderkey", python_json(record, orders.schema).alias("json"))


def _orders_with_nulls(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))


def q_record_to_json(spark, sf_dir):
    orders = _orders_with_nulls(spark, sf_dir)
    return orders.select("o_orderkey", record_json(orders.columns, orders.schema).alias("json"))


def q_join_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    long_words = F.filter(F.split("p_name", " ", -1), lambda w: F.length(w) > 4)
    return part.select("p_partkey", join_list(long_words).alias("joined"),
                       join_list(F.split("p_name", " ", -1), ", ").alias("commaText"))


def q_encode_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keys = F.filter(F.array("o_orderkey", "o_custkey"), lambda k: k > 1000)
    records = F.transform(keys, lambda k: F.struct(k.alias("key"), F.nullif(k % 3, F.lit(0)).alias("rest")))
    return orders.select("o_orderkey", encode_list(records).alias("encoded"))


# --- records -----------------------------------------------------------------------

def _event_records(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.col("value"), F.col("user_id")).alias("detail"),
        F.from_json("props", "k BIGINT").alias("props"),
        F.when(F.col("event_type") == "view", F.array().cast("array<string>"))
         .otherwise(F.array(F.lit(""), F.col("event_type"))).alias("tags"),
        F.array("user_id", "event_id").alias("ids"),
        F.array(F.struct(F.col("event_id").alias("id"), F.nullif(F.col("user_id") % 2, F.lit(0)).alias("odd"))).alias("parts"),
    )


def q_clean_empties(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rec = ev.select(
        "event_id", "ts", "event_type", "value", (F.col("user_id") % 3).alias("bucket"),
        F.struct(F.col("value"), F.from_json("props", "k BIGINT")["k"].alias("k")).alias("detail"),
    )
    cleaned = clean_empties(rec)
    return cleaned.select("event_id", "ts", "event_type", "value", "bucket",
                          F.to_json("detail", {"ignoreNullFields": "false"}).alias("detail"))


def q_clean_nested(spark, sf_dir):
    """Cleaning over records three levels deep with a list of records."""
    ev = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    items = F.array(F.struct((F.col("user_id") % 2).alias("odd"), kind.alias("kind")))
    inner = F.struct(F.col("value"), items.alias("items"))
    rec = ev.select("event_id", F.struct(kind.alias("kind"), inner.alias("inner")).alias("record"))
    return clean_empties(rec).select("event_id", F.to_json("record", {"ignoreNullFields": "false"}).alias("record"))


def q_flatten_records(spark, sf_dir):
    return flatten_records(_event_records(spark, sf_dir))


def _event_dictionaries(spark, sf_dir):
    """Events with dictionaries whose keys are data: values, records and dictionaries by event type."""
    ev = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return ev.select(
        "event_id",
        F.create_map(kind, F.col("value"), F.concat(F.lit("user"), F.col("user_id") % 3), (F.col("user_id") % 7).cast("double")).alias("metrics"),
        F.struct(F.create_map(kind, F.struct(F.from_json("props", "k BIGINT")["k"].alias("k"), F.lit("").alias("empty"))).alias("byType")).alias("detail"),
        F.create_map(F.lit("deep"), F.create_map((F.col("user_id") % 2).cast("int"), F.array(kind))).alias("nested"),
    )


def q_flatten_dynamic_keys(spark, sf_dir):
    return flatten_records(_event_dictionaries(spark, sf_dir), keys="discover")


def q_drop_null_columns(spark, sf_dir):
    return drop_null_columns(raw_mapping(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------------

def q_read_json_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-json")
    write_json(orders, path, simplify=False, layout="document")
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate STRING, o_orderpriority STRING")
    return read_json_records(spark, path, schema=schema, document=True)


def q_read_json_documents(spark, sf_dir):
    """Pretty-printed documents, each read by as many tasks as it has file blocks."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-pretty")
    write_json(orders, path, simplify=False, layout="document", pretty=True)
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate STRING, o_orderpriority STRING")
    return read_json_documents(spark, path, schema)


def q_write_json(spark, sf_dir):
    path = scratch_path(spark, "events-json")
    export_records(_event_records(spark, sf_dir), path)
    schema = ("event_id BIGINT, detail_type STRING, detail_value DOUBLE, detail_user_id BIGINT, props_k BIGINT, "
              "tags STRING, ids STRING, parts STRING")
    return read_json_records(spark, path, schema=schema, document=False, fill=False)


def q_stream_record_export(spark, sf_dir):
    records = _event_records(spark, sf_dir)
    source = scratch_path(spark, "events-stream-in")
    records.write.mode("overwrite").json(source)          # the arriving files
    target, ckpt = scratch_path(spark, "events-stream-out"), scratch_path(spark, "events-stream-ckpt")
    query = stream_record_export(spark, source, records.schema, target, ckpt)
    query.awaitTermination()
    schema = ("event_id BIGINT, detail_type STRING, detail_value DOUBLE, detail_user_id BIGINT, props_k BIGINT, "
              "tags STRING, ids STRING, parts STRING")
    return read_json_records(spark, target, schema=schema, document=False, fill=False)


def q_json_output_size(spark, sf_dir):
    return json_output_size(table(spark, sf_dir, "orders"))


def q_write_many(spark, sf_dir):
    target = scratch_path(spark, "datasets")
    orders = table(spark, sf_dir, "orders")
    # the fourth dataset is empty (no order has a negative price): the sink must skip it
    sets = [orders, table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"),
            orders.filter(F.col("o_totalprice") < 0)]
    written = write_many(sets, target, names=["orders", "customers"])  # wrong length: default names
    parts = [(df := spark.read.parquet(p)).select(F.lit(name).alias("dataset"), F.col(df.columns[0]).alias("key"))
             for name, p in written.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"), F.sum("key").alias("keySum"),
                                      F.countDistinct("key").alias("keys"))


def q_publish_many(spark, sf_dir):
    """A set published twice, the second time with one member replaced and one added, read by its manifest."""
    target = scratch_path(spark, "dataset-set")
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    publish_many([orders.filter(F.col("o_orderkey") % 2 == 0), customers, orders.filter(F.col("o_totalprice") < 0)], target, ["orders", "customers", "none"])
    publish_many([read_many(spark, target)["orders"].unionByName(orders.filter(F.col("o_orderkey") % 2 != 0)), table(spark, sf_dir, "supplier")],
                 target, ["orders", "suppliers"], overwrite=False)
    parts = [df.select(F.lit(name).alias("dataset"), F.col(df.columns[0]).alias("key")) for name, df in read_many(spark, target).items()]
    return reduce(DataFrame.unionByName, parts).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("key").alias("keySum"), F.countDistinct("key").alias("keys"))


def q_catalogue_documents(spark, sf_dir):
    """The catalogue as ordered documents of at most 50,000 bytes, read back: where each record stands, and whether its document keeps the limit."""
    path = scratch_path(spark, "catalogue-documents")
    cat = pk_catalogue(_mappings(spark, sf_dir))
    write_json(sort_catalogue(cat), path, simplify=False, layout="document", keep_order=True, limit_mb=0.05)
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), "value")
    records = docs.select("file", "bytes", F.posexplode(F.from_json("value", T.ArrayType(cat.schema), {"mode": "FAILFAST"})).alias("at", "r"))
    sizes = records.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
    before = Window.partitionBy("one").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a document
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return records.join(starts, "file").select("r.*", (F.col("start") + F.col("at")).alias("position"), (F.col("bytes") <= 50_000).alias("withinLimit"))


def q_dated_snapshot(spark, sf_dir):
    base = scratch_path(spark, "snapshots")
    target = dated_path(f"{base}/orders", SNAPSHOT_DAY)
    table(spark, sf_dir, "orders").write.mode("overwrite").parquet(target)
    back = spark.read.parquet(target)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    return back.select(*back.columns, folder.alias("snapshot"))


def q_save_table(spark, sf_dir):
    save_table(_mappings(spark, sf_dir), MAPPINGS_TABLE, scratch_path(spark, "table-mappings"))
    return spark.table(MAPPINGS_TABLE)


def _stored(spark, sf_dir):
    load = MappingLoad(_mappings(spark, sf_dir), SHEET_COLUMNS, SHEET_FLAGS)
    return store_mapping(load, MAPPINGS_TABLE, scratch_path(spark, "table-mappings"))


def q_object_view(spark, sf_dir):
    _stored(spark, sf_dir)
    return spark.table(OBJECT_VIEW)


def q_select_from(spark, sf_dir):
    _stored(spark, sf_dir)
    return select_from(spark, PK_VIEW, [*LEVELS, TABLE, ROW_INDEX])


def q_sql_passthrough(spark, sf_dir):
    _stored(spark, sf_dir)
    return run_sql(spark, f"SELECT * FROM {PK_VIEW}")


def q_hash_files(spark, sf_dir):
    """Texts written as files of at most 1,000 documents, in order; the files' hashes, and that of a folder, which is no file."""
    docs = table(spark, sf_dir, "documents").select("lang", F.expr("doc_id div 1000").alias("part"), "doc_id", "text")
    root = scratch_path(spark, "doc-files")
    ordered = docs.repartition("lang", "part").sortWithinPartitions("lang", "part", "doc_id")
    ordered.select("lang", "part", "text").write.partitionBy("lang", "part").text(root)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        F.regexp_replace("path", "^file:", "").alias("path"))
    folders = docs.select(F.concat_ws("/", F.lit(root), F.concat(F.lit("lang="), F.col("lang"))).alias("path")).distinct()
    found = hash_files(spark, listed.unionByName(folders), "path", [root], bits=256)
    return found.select(F.regexp_extract("path", "lang=[^/]+(/part=[^/]+)?", 0).alias("name"), "sha256")


QUERIES: dict[str, Query] = {
    "yes_no_flags": q_yes_no_flags,
    "drop_incomplete": q_drop_incomplete,
    "split_path": q_split_path,
    "fill_text": q_fill_text,
    "select_columns": q_select_columns,
    "pk_filter": q_pk_filter,
    "object_rollup": q_object_rollup,
    "pk_view": q_pk_view,
    "pk_catalogue": q_pk_catalogue,
    "pk_entries": q_pk_entries,
    "sorted_catalogue": q_sorted_catalogue,
    "distinct_collapse": q_distinct_collapse,
    "row_index": q_row_index,
    "mapping_load": q_mapping_load,
    "mapping_load_csv": q_mapping_load_csv,
    "read_sheet": q_read_sheet,
    "discover_header": q_discover_header,
    "discover_sheet_headers": q_discover_sheet_headers,
    "mapping_load_sheets": q_mapping_load_sheets,
    "discover_header_variants": q_discover_header_variants,
    "mapping_load_variants": q_mapping_load_variants,
    "camel_case": q_camel_case,
    "split_camel_case": q_split_camel_case,
    "slugify": q_slugify,
    "hash_text": q_hash_text,
    "hash_record": q_hash_record,
    "hash_text_256": q_hash_text_256,
    "hash_record_256": q_hash_record_256,
    "python_json": q_python_json,
    "record_to_json": q_record_to_json,
    "join_list": q_join_list,
    "encode_list": q_encode_list,
    "clean_empties": q_clean_empties,
    "clean_nested": q_clean_nested,
    "flatten_records": q_flatten_records,
    "flatten_dynamic_keys": q_flatten_dynamic_keys,
    "drop_null_columns": q_drop_null_columns,
    "read_json_records": q_read_json_records,
    "read_json_documents": q_read_json_documents,
    "write_json": q_write_json,
    "stream_record_export": q_stream_record_export,
    "json_output_size": q_json_output_size,
    "write_many": q_write_many,
    "publish_many": q_publish_many,
    "catalogue_documents": q_catalogue_documents,
    "dated_snapshot": q_dated_snapshot,
    "save_table": q_save_table,
    "object_view": q_object_view,
    "select_from": q_select_from,
    "sql_passthrough": q_sql_passthrough,
    "hash_files": q_hash_files,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full chain on a sheet export: read -> header -> clean -> split -> rollup/join -> catalogue."""
    return pk_catalogue(q_mapping_load(spark, sf_dir))

