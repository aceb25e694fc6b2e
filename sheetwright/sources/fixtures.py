"""Scale fixtures derived by Spark from the given tables.

``raw_mapping`` turns every ``lineitem`` row into one raw mapping-sheet row
(paths of 1 to 5 parts, bad flags, objects without PK, objects spread over
several tables).  ``write_mapping_sheet`` writes it as a sheet export with a
title line, a preamble and a header line, in a total order, so positions
are reproducible by an SQL oracle.  Both grow with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ROW_INDEX
from ..session import path_exists, scratch_path

# --- fixed values -------------------------------------------------------------
# Display texts of the header line; camel case turns them into the column names.
SHEET_HEADER = ("View Object", "View Object Attribute", "Database Table", "Database Column",
                "Primary Key Column", "Indexed Column")
SHEET_TITLE = "Application to database mapping"
SHEET_PREAMBLE = ("Exported from the mapping workbook, second sheet",)
# Lines before the header: title (line 0), preamble, one blank line.
HEADER_LINE = 1 + len(SHEET_PREAMBLE) + 1
# Total order of the data lines in the export (ties are identical rows).
SHEET_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
# An export has at least MIN_PARTS parts, each of about PART_LINES lines at most.
PART_LINES = 250_000
MIN_PARTS = 4
# ------------------------------------------------------------------------------

SHEET_COLUMNS = ("viewObject", "viewObjectAttribute", "databaseTable", "databaseColumn",
                 "primaryKeyColumn", "indexedColumn")
SHEET_FLAGS = ("primaryKeyColumn", "indexedColumn")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapping_cells(li: DataFrame) -> list:
    s = lambda c: F.col(c).cast("string")
    pk5 = F.col("l_partkey") % 5
    view_object = F.concat_ws(
        ".",
        F.concat(F.lit("Top"), (F.col("l_suppkey") % 5).cast("string")),
        F.when(pk5 >= 1, F.concat(F.lit("Mod"), (F.col("l_partkey") % 7).cast("string"))),
        F.when(pk5 >= 2, F.concat(F.lit("Svc"), (F.col("l_partkey") % 3).cast("string"))),
        F.when(pk5 >= 3, F.concat(F.lit("Vo"), (F.col("l_partkey") % 11).cast("string"))),
        F.when(pk5 >= 4, F.lit("Tail")),
    )
    pk = (
        F.when(F.col("l_partkey") % 11 == 0, "No")
        .when(F.col("l_returnflag") == "R", "Yes")
        .when(F.col("l_quantity") < 3, "yes")
        .otherwise("No")
    )
    indexed = F.when(F.col("l_linestatus") == "O", "Yes").when(F.col("l_quantity") > 48, F.lit(None)).otherwise("No")
    return [
        view_object.alias("viewObject"),
        F.concat(F.lit("Attr"), s("l_orderkey"), F.lit("_"), s("l_linenumber")).alias("viewObjectAttribute"),
        F.concat(F.lit("TAB_"), (F.col("l_suppkey") % 4).cast("string")).alias("databaseTable"),
        F.concat(F.lit("COL_"), s("l_linenumber")).alias("databaseColumn"),
        pk.alias("primaryKeyColumn"),
        indexed.alias("indexedColumn"),
    ]


def raw_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (uncleaned) mapping rows, one per lineitem row; ``rowIndex`` = l_orderkey*10 + l_linenumber."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*_mapping_cells(li), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(ROW_INDEX))


def _export_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of an export of this ``lineitem`` table; a changed table gets another one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    key = "".join(ch if ch.isalnum() else "_" for ch in sf_dir.rstrip("/"))
    return scratch_path(spark, f"{name}{key}-{status.getModificationTime()}-{status.getLen()}", unique=False)


def _top_lines() -> list[list[str | None]]:
    """Lines 0 to ``HEADER_LINE``: title, preamble, a blank line, the header."""
    short = [[text] + [None] * (len(SHEET_COLUMNS) - 1) for text in (SHEET_TITLE, *SHEET_PREAMBLE)]
    return [*short, [None] * len(SHEET_COLUMNS), list(SHEET_HEADER)]


def _sheet_lines(li: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Top lines (_grp 0, by _ord) and data lines (_grp 1, by SHEET_ORDER), narrow: cells are made once the lines are in order."""
    data = li.select(F.lit(1).alias("_grp"), F.lit(0).alias("_ord"), *SHEET_ORDER)
    blank = [F.lit(None).cast(t).alias(c) for c, t in li.select(*SHEET_ORDER).dtypes]
    top = li.sparkSession.range(0, len(_top_lines()), 1, 1).select(F.lit(0).alias("_grp"), F.col("id").cast("int").alias("_ord"), *blank)
    return top, data


def _sheet_cells(cells: list) -> list:
    """The cells _c0.. of the lines of ``_sheet_lines``; ``cells`` are those of the data lines."""
    tops = zip(*_top_lines())
    return [F.when(F.col("_grp") == 0, F.get(F.array(*[F.lit(t).cast("string") for t in top]), F.col("_ord"))).otherwise(c).alias(f"_c{i}")
            for i, (c, top) in enumerate(zip(cells, tops))]


def _in_order(lines: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``lines`` in the total order of ``keys``; the parts' number follows the ``rows``, so a task's share does not grow with them."""
    return lines.repartitionByRange(max(MIN_PARTS, -(-rows // PART_LINES)), *keys).sortWithinPartitions(*keys)


def write_mapping_sheet(spark: SparkSession, sf_dir: str, path: str | None = None, reuse: bool = True) -> str:
    """Write the fixture as a Parquet sheet export (all-text cells ``_c0.._c5``) and return its path.

    The data lines are sorted by ``SHEET_ORDER``: a range shuffle of the
    narrow order columns orders the part files, and the cells are made after
    it; with ``reuse`` an existing export is kept.
    """
    path = path or _export_folder(spark, sf_dir, "mapping-sheet")
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        return path
    li = table(spark, sf_dir, "lineitem")
    top, data = _sheet_lines(li)
    ordered = _in_order(top.unionByName(data), li.count(), "_grp", "_ord", *SHEET_ORDER)
    ordered.select(_sheet_cells(_mapping_cells(li))).write.mode("overwrite").parquet(path)
    return path


def write_mapping_csv(spark: SparkSession, sf_dir: str, path: str | None = None, reuse: bool = True) -> str:
    """The sheet as CSV over several files, its attribute cells with commas, quotes and line breaks."""
    path = path or _export_folder(spark, sf_dir, "mapping csv")
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        return path
    li = table(spark, sf_dir, "lineitem")
    cells = _mapping_cells(li)
    cells[1] = F.format_string('Attr "%s", line\n%s', F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    top, data = _sheet_lines(li)
    ordered = _in_order(top.unionByName(data), li.count(), "_grp", "_ord", *SHEET_ORDER)
    ordered.select(_sheet_cells(cells)).write.mode("overwrite").option("escape", '"').csv(path)
    return path


def _sheet_of() -> Column:
    """The sheet of a data line: its database table."""
    return F.concat(F.lit("TAB_"), (F.col("l_suppkey") % 4).cast("string")).alias("sheetName")


def write_mapping_sheets(spark: SparkSession, sf_dir: str, path: str | None = None, reuse: bool = True) -> str:
    """Write the fixture as several sheets, one per database table, under ``path/sheetName=<table>``.

    Each sheet is a folder of part files in order: its own title, preamble and
    header lines, then its data lines in ``SHEET_ORDER``; one pass writes all.
    Returns the folder whose sub-folders are the sheets.
    """
    path = path or _export_folder(spark, sf_dir, "mapping-sheets-parts")
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        return path
    li = table(spark, sf_dir, "lineitem")
    top, data = _sheet_lines(li)
    data = data.withColumn("sheetName", _sheet_of())
    top = data.select("sheetName").distinct().join(F.broadcast(top))  # a few lines for each sheet
    ordered = _in_order(top.unionByName(data), li.count(), "sheetName", "_grp", "_ord", *SHEET_ORDER)
    ordered.select("sheetName", *_sheet_cells(_mapping_cells(li))).write.mode("overwrite").partitionBy("sheetName").parquet(path)
    return path


# --- fixed values -------------------------------------------------------------
# Columns of the sheets whose headers differ, by the number of their table.
VARIANT_COLUMNS = (
    ("View Object", "View Object Attribute", "Database Table", "Database Column", "Primary Key Column", "Indexed Column"),
    ("View Object", "View Object Attribute", "Database Table", "Database Column", "Indexed Column", "Primary Key Column"),
    ("View Object", "View Object Attribute", "Database Table", "Database Column", "Primary Key Column", "Unique Column", "Indexed Column"),
    ("Database Table", "Database Column", "View Object", "View Object Attribute", "Primary Key Column"),
)
# ------------------------------------------------------------------------------


def write_mapping_variants(spark: SparkSession, sf_dir: str, path: str | None = None, reuse: bool = True) -> str:
    """Write the fixture as sheets, one folder of part files per database table, with different headers and header lines.

    A sheet's preamble has a line for each status of its rows, so where its
    header stands follows from the data; column order and flags differ by
    table (``VARIANT_COLUMNS``).  Returns the folder whose sub-folders are the sheets.
    """
    path = path or _export_folder(spark, sf_dir, "mapping-variants-parts")
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        return path
    li = table(spark, sf_dir, "lineitem")
    cells = dict(zip(SHEET_HEADER, _mapping_cells(li)))
    cells["Unique Column"] = F.when(F.col("l_linenumber") % 3 == 0, "Yes").when(F.col("l_linenumber") % 7 != 1, "No")
    group = F.col("_grp")

    def cell(i: int) -> Column:
        """Cell ``i`` of a title (_grp 0), a status (1), a header (2) or a data line (3)."""
        own = [(k, header[i]) for k, header in enumerate(VARIANT_COLUMNS) if i < len(header)]
        top = F.when(group == 0, F.lit(SHEET_TITLE)).when(group == 1, F.concat(F.lit("Status "), F.col("_ord"))) if i == 0 else F.when(group < 2, F.lit(None))
        named = F.coalesce(*[F.when(F.col("sheetName") == f"TAB_{k}", name) for k, name in own])
        data = F.coalesce(*[F.when(F.col("l_suppkey") % 4 == k, cells[name]) for k, name in own])
        return top.when(group == 2, named).otherwise(data).alias(f"_c{i}")

    data = li.select(_sheet_of(), F.lit(3).alias("_grp"), F.lit("").alias("_ord"), *SHEET_ORDER)
    blank = [F.lit(None).cast(t).alias(c) for c, t in li.select(*SHEET_ORDER).dtypes]
    statuses = li.select(_sheet_of(), F.concat("l_returnflag", "l_linestatus").alias("_ord")).distinct().select(
        "sheetName", F.lit(1).alias("_grp"), "_ord", *blank)
    tops = [(f"TAB_{k}", group, "") for group in (0, 2) for k in range(len(VARIANT_COLUMNS))]
    top = spark.createDataFrame(tops, "sheetName string, _grp int, _ord string").select("*", *blank)
    top = top.join(li.select(_sheet_of()).distinct(), "sheetName", "left_semi")
    ordered = _in_order(top.unionByName(statuses).unionByName(data), li.count(), "sheetName", "_grp", "_ord", *SHEET_ORDER)
    ordered.select("sheetName", *map(cell, range(max(map(len, VARIANT_COLUMNS))))).write.mode("overwrite").partitionBy("sheetName").parquet(path)
    return path
