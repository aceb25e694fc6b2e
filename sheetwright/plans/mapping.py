"""The user-level jobs: mapping load (P1), object and PK views (P2), PK catalogue (P3), record export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (ATTRIBUTE, COL_CNT, COL_CNT_PK, COLUMN, LEVELS, MAPPINGS_TABLE, OBJECT_VIEW, PK_FLAG, PK_VIEW,
                         ROW_INDEX, TABLE, VIEW_OBJECT)
from ..operators.catalogue import pk_catalogue, sort_catalogue
from ..operators.flags import drop_incomplete, yes_no_flags
from ..operators.nulls import fill_text
from ..operators.paths import split_path
from ..sinks.files import dated_path, export_path, write_json
from ..sinks.tables import save_sql_view, save_table
from ..sources.sheets import VARIANT, open_sheets, read_sheet, read_sheets


@dataclass(frozen=True)
class MappingLoad:
    mappings: DataFrame
    names: tuple[str, ...]
    flags: tuple[str, ...]


def clean_mapping(raw: DataFrame, flags: Sequence[str], source: str = VIEW_OBJECT,
                  levels: Sequence[str] = LEVELS) -> DataFrame:
    """R1 -> R2 -> R4 -> R7 over raw sheet rows that already carry ``rowIndex`` (narrow, no shuffle)."""
    flagged = yes_no_flags(raw, flags)
    kept = drop_incomplete(flagged, flags)
    return fill_text(split_path(kept, source, levels))


def load_mapping(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                 names: Sequence[str] | None = None, nrows: int | None = None) -> MappingLoad:
    """Read a sheet export, find and apply its header, clean it (P1 without the store).

    Every column from the fifth on is a Yes/No flag.
    """
    raw, names = read_sheet(spark, paths, fmt, names, nrows)
    flags = _flags(names)
    return MappingLoad(clean_mapping(raw, flags), tuple(names), flags)


def load_mappings(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                  names: Sequence[str] | None = None, folders: bool = False) -> MappingLoad:
    """P1 over many sheets at once, each file (with ``folders`` each folder of part files) its own sheet with its own preamble and header.

    Headers may differ: the four text columns in any order, then flags, among
    them the primary-key flag, in any order and number.  A row is complete when
    all flags of its own sheet are; flags that its sheet does not have are
    null.  Rows keep their per-sheet ``rowIndex`` and a ``sheet`` column.
    """
    if names is not None:
        raw, names = read_sheets(spark, paths, fmt, names, folders)
        return MappingLoad(clean_mapping(raw, _flags(names)), tuple(names), _flags(names))
    found = open_sheets(spark, paths, fmt, folders)
    if len(found.headers) == 1:
        flags = _flags(found.names)
        return MappingLoad(clean_mapping(found.rows.drop(VARIANT), flags), found.names, flags)
    for header in found.headers:
        _flags(header)
        if set(header[:4]) != {VIEW_OBJECT, ATTRIBUTE, TABLE, COLUMN}:
            raise ValueError(f"the first four columns must be {(VIEW_OBJECT, ATTRIBUTE, TABLE, COLUMN)}: {header}")
    flags = tuple(n for n in found.names if n not in found.headers[0][:4])
    flagged = yes_no_flags(found.rows, flags)
    complete = reduce(and_, [F.col(f"`{f}`").isNotNull() | ~found.has(f) for f in flags])
    kept = flagged.filter(complete).drop(VARIANT)
    return MappingLoad(fill_text(split_path(kept, VIEW_OBJECT, LEVELS)), found.names, flags)


def _flags(names: Sequence[str]) -> tuple[str, ...]:
    """The flag columns: the fifth on; the primary-key flag must be among them."""
    flags = tuple(names[4:])
    if PK_FLAG not in flags:
        raise ValueError(f"'{PK_FLAG}' must be one of the flag columns (5th column on): {names}")
    return flags


def store_mapping(load: MappingLoad, table: str = MAPPINGS_TABLE, path: str | None = None) -> DataFrame:
    """Replace the mappings table (P1's store) and build the views over it."""
    spark = load.mappings.sparkSession
    save_table(load.mappings, table, path)
    build_views(spark, table)
    return spark.table(table)


def object_view_sql(table: str) -> str:
    """Rows and flagged rows of every object (A1) as SQL."""
    levels = ", ".join(LEVELS)
    return (f"SELECT {levels}, COUNT(*) AS {COL_CNT}, CAST(SUM({PK_FLAG}) AS BIGINT) AS {COL_CNT_PK} "
            f"FROM `{table}` GROUP BY {levels}")


def pk_view_sql(table: str, object_view: str) -> str:
    """Every object with each of its PK rows, or once with nulls (J1), as SQL.

    The outer join is written as its inner part plus the objects without a
    partner, as ``pk_view`` does: a hot object's rows can then be split.
    """
    levels = ", ".join(f"t.{c}" for c in LEVELS)
    carried = (ATTRIBUTE, TABLE, COLUMN, ROW_INDEX)
    same = " AND ".join(f"t.{c} = v.{c}" for c in LEVELS)
    no_level = " OR ".join(f"t.{c} IS NULL" for c in LEVELS)
    return (f"SELECT {levels}, t.{COL_CNT}, t.{COL_CNT_PK}, {', '.join(f'v.{c}' for c in carried)} "
            f"FROM `{object_view}` t JOIN (SELECT * FROM `{table}` WHERE {PK_FLAG} = 1) v ON {same} "
            f"UNION ALL SELECT {levels}, t.{COL_CNT}, t.{COL_CNT_PK}, {', '.join(f'NULL AS {c}' for c in carried)} "
            f"FROM `{object_view}` t WHERE COALESCE(t.{COL_CNT_PK}, 0) = 0 OR {no_level}")


def build_views(spark: SparkSession, table: str = MAPPINGS_TABLE, object_view: str = OBJECT_VIEW,
                pk_view_name: str = PK_VIEW) -> None:
    """Object rollup view and PK view over the stored mappings table, kept in the catalog."""
    save_sql_view(spark, object_view, object_view_sql(table), persistent=True)
    save_sql_view(spark, pk_view_name, pk_view_sql(table, object_view), persistent=True)


def catalogue(spark: SparkSession, table: str = MAPPINGS_TABLE) -> DataFrame:
    """PK catalogue over the stored mappings table."""
    return pk_catalogue(spark.table(table))


def export_records(df: DataFrame, path: str, dated: bool = False, on: dt.date | None = None,
                   simplify: bool = True, layout: str = "lines") -> str:
    """Record export (P4): flatten + clean, JSON text, optional dated name, size-guarded files."""
    target = dated_path(path, on) if dated else path
    return write_json(df, target, simplify=simplify, layout=layout)


def export_named(df: DataFrame, folder: str, name: str, dated: bool = False, on: dt.date | None = None,
                 simplify: bool = True, layout: str = "document", keep_order: bool = False) -> str:
    """Record export under ``folder`` with a slugged name (``.json`` added when it has no suffix)."""
    return write_json(df, export_path(folder, name, dated, on), simplify=simplify, layout=layout,
                      keep_order=keep_order)


def write_catalogue(spark: SparkSession, folder: str, name: str = "pkCols", table: str = MAPPINGS_TABLE,
                    dated: bool = False, on: dt.date | None = None) -> str:
    """P3's output: the PK catalogue in group-key order (O3) as JSON documents, lists kept as lists."""
    ordered = sort_catalogue(catalogue(spark, table))
    return export_named(ordered, folder, name, dated, on, simplify=False, keep_order=True)
