"""Mapping sheets exported as Parquet or CSV: positions (R3), header discovery (S3), naming.

A *sheet* is one directory (or file list) of part files in sheet order, as
``df.orderBy(...).write`` produces: by part number, then by name.  Every line
gets its 0-based sheet line number: the row position inside its file (Parquet
``_metadata.row_index``; CSV line number) plus the number of lines in all
earlier files.  The per-file offsets are a small staged table (one row per
file, computed by Spark), broadcast when its row count is checked to be small
and joined otherwise; cells are never shuffled for their position.

Semantics kept from the original tool: line 0 is consumed as the sheet's
first (title) line and its second cell must be blank; the header is the
first of the next 15 lines whose second cell is non-empty; all names are
camel-cased; ``rowIndex`` = line - 1, assigned before any row is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import HEADER_SEARCH_LINES, ROW_INDEX, SHEET
from ..functions.naming import camel_case, text_values
from ..session import scratch_path
from .csv_records import FILE, POS, block_counts, block_records, block_starts, stitched

LINE = "_line"
#: Rows of an offsets or block table up to which it is broadcast (some tens of MB); beyond, a shuffle join places the lines.
MAX_BROADCAST_ROWS = 200_000
PART_GROUP = 1024
FEW_FILES = 1000
#: Different headers that many sheets may have between them.
MAX_VARIANTS = 1000
VARIANT = "_variant"
BLANK_CSV = {"quote": '"', "escape": '"'}


def _cell_names(n: int) -> list[str]:
    return [f"_c{i}" for i in range(n)]


def _cells(df: DataFrame) -> list[str]:
    return sorted((c for c in df.columns if c.startswith("_c")), key=lambda c: int(c[2:]))


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small_side(df: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if its row count allows it."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def _positioned_parquet(spark: SparkSession, paths: Sequence[str], merge: bool = False) -> DataFrame:
    df = spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)
    cells = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)  # NaN -> null
        cells.append(c.cast("string").alias(f"_c{i}"))
    return df.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.row_index").alias(POS),
        *cells,
    )


def _split_cells(records: DataFrame, width: int) -> DataFrame:
    """Rows (FILE, POS, text) with the text's cells; doubled quotes stand for one, an empty cell is null."""
    names = _cell_names(width)
    options = BLANK_CSV | {"maxColumns": str(max(20480, width + 1))}
    parsed = records.select(FILE, POS, F.from_csv("_text", ", ".join(f"{n} STRING" for n in names), options).alias("_r"))
    return parsed.select(FILE, POS, *[F.when(F.col(f"_r.{n}") != "", F.col(f"_r.{n}")).alias(n) for n in names])


def _text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths), lineSep="\n").select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_m"),
        F.regexp_replace("value", r"\r$", "").alias("_text"),
    )


def _quotes(text: str | Column = "_text") -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def _width(text: str = "_text") -> Column:
    """Number of cells of a record: separators outside quoted parts, plus one."""
    bare = F.regexp_replace(text, '"[^"]*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def _positioned_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV records with their number inside the file, read splittably, parsed by ``from_csv``.

    One pass over all lines counts, per file block, the lines, the widest line
    and the lines that leave a quoted cell open; its result (one row per block)
    is staged.  A line's number is the line count of the earlier blocks of its
    file plus its order inside its block (the row counter of the scan, which
    is contiguous within a block); a scan laid out differently from the counting pass
    raises.  Blank lines are kept (as empty rows).  Where quoted cells span
    lines, records are cut block by block first (``csv_records``).  An unclosed
    quote raises.
    """
    text = _text_lines(spark, paths)
    blocks = _staged(text.groupBy(FILE, "_blk").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"), F.max(_width()).alias("_width"),
        F.sum(_quotes() % 2).alias("_open")), "csv-blocks")
    found = blocks.agg(F.max("_width").alias("width"), F.sum("_open").alias("open")).first()
    if found["open"]:
        records = _records_over_lines(text)
        width = records.agg(F.max(_width())).first()[0]
        return _split_cells(records, width)
    earlier = Window.partitionBy(FILE).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = _staged(blocks.select(FILE, "_blk", "_m0", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_b0")), "csv-starts")
    lines = text.join(_small_side(starts), on=[FILE, "_blk"])
    same_scan = F.col("_m").between(F.col("_m0"), F.col("_m0") + F.col("_n") - 1)
    position = F.when(same_scan, F.col("_b0") + F.col("_m") - F.col("_m0")).otherwise(
        F.raise_error(F.lit("the file scan changed between counting and reading")).cast("bigint"))
    return _split_cells(lines.select(FILE, position.alias(POS), "_text"), found["width"] or 1)


def _records_over_lines(text: DataFrame) -> DataFrame:
    """Records (FILE, POS, _text) whose quoted cells may span lines, staged; every block of a file is read by its own task."""
    counts = _staged(block_counts(text), "csv-block-counts")
    unclosed = counts.groupBy(FILE).agg((F.sum("_quotes") % 2).alias("odd")).where("odd = 1").first()
    if unclosed:
        raise ValueError(f"a quoted cell is not closed in {unclosed[FILE]}")
    starts = _staged(block_starts(counts), "csv-block-starts")
    if starts.count() <= MAX_BROADCAST_ROWS:
        lines = text.join(F.broadcast(starts), on=[FILE, "_blk"])
    else:  # a shuffle deals whole blocks but not in order
        lines = text.join(starts, on=[FILE, "_blk"]).sortWithinPartitions(FILE, "_blk", "_m")
    pieces = _staged(block_records(lines), "csv-pieces")
    across = _staged(stitched(pieces), "csv-across")
    return pieces.where("_whole").select(FILE, POS, "_text").unionByName(across)


def _positioned(spark: SparkSession, paths: Sequence[str], fmt: str, merge: bool = False) -> DataFrame:
    """Lines by file; ``merge`` where files may have different numbers of columns."""
    if fmt == "parquet":
        return _positioned_parquet(spark, paths, merge)
    if fmt == "csv":
        return _positioned_csv(spark, paths)
    raise ValueError(f"Invalid sheet format: {fmt}")


def _file_offsets(raw: DataFrame, sheet: Column | None = None) -> DataFrame:
    """Rows (FILE, _sheet, _n, _off), staged where they are many: the lines of each file and of all files of its sheet before it.

    ``sheet`` names the sheet of a file; without it all files are one sheet.
    Files are ordered by part number, then by name.  Running sums are taken
    within groups of consecutive part numbers, then over the groups' totals (a
    thousandth of the files).  Up to ``FEW_FILES`` files are added up on the
    driver, which saves two staged tables.
    """
    name = F.element_at(F.split(FILE, "/"), -1)
    part = F.coalesce(F.nullif(F.regexp_extract(name, r"^part-(\d+)", 1), F.lit("")).cast("long"), F.lit(0))
    files = raw.groupBy(FILE).agg((F.max(POS) + 1).alias("_n")).select(
        "*", (F.lit("") if sheet is None else sheet).alias("_sheet"), part.alias("_part"), F.floor(part / PART_GROUP).alias("_group"))
    if len(raw.inputFiles()) <= FEW_FILES:
        rows, before = [], {}
        for r in sorted(files.collect(), key=lambda r: (r["_part"], r[FILE])):
            off = before.get(r["_sheet"], 0)
            rows.append((r[FILE], r["_sheet"], r["_n"], off))
            before[r["_sheet"]] = off + r["_n"]
        return raw.sparkSession.createDataFrame(rows, f"{FILE} string, _sheet string, _n bigint, _off bigint")
    files = _staged(files, "sheet-files")
    earlier = Window.partitionBy("_sheet").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("_sheet", "_group").agg(F.sum("_n").alias("_sum")).select(
        "_sheet", "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_sheet", "_group").orderBy("_part", FILE).rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("*", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_in")).join(totals, ["_sheet", "_group"])
    return _staged(placed.select(FILE, "_sheet", "_n", (F.col("_in") + F.col("_before")).alias("_off")), "sheet-offsets")


@dataclass(frozen=True)
class Sheet:
    """A sheet export: its lines with their place in their file, each file's first line number, and the first lines."""

    raw: DataFrame
    offsets: DataFrame
    head: tuple[tuple, ...]  # (line, cells...) of lines 0..HEADER_SEARCH_LINES

    def lines(self) -> DataFrame:
        """Lines with their sheet line number ``_line`` and cells ``_c0..``."""
        placed = self.raw.join(_small_side(self.offsets.select(FILE, "_off")), on=FILE)
        return placed.select(FILE, (F.col("_off") + F.col(POS)).alias(LINE), *_cells(self.raw))


def open_sheet(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet") -> Sheet:
    """Count the lines of each part file and fetch the sheet's first ``HEADER_SEARCH_LINES + 1`` lines.

    Only those lines, and the names of the (at most as many) files that hold
    them, reach the driver.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = _positioned(spark, paths, fmt)
    offsets = _file_offsets(raw)
    first = offsets.filter((F.col("_n") > 0) & (F.col("_off") <= HEADER_SEARCH_LINES)).collect()
    cells = _cells(raw)
    head = []
    if first:
        lines = _head_lines(spark, raw, fmt, [r[FILE] for r in first])
        start = {r[FILE]: r["_off"] for r in first}
        head = sorted((start[r[FILE]] + r[POS], *(r[c] for c in cells)) for r in lines.select(FILE, POS, *cells).collect())
    return Sheet(raw, offsets, tuple(h for h in head if h[0] <= HEADER_SEARCH_LINES))


def _head_lines(spark: SparkSession, raw: DataFrame, fmt: str, files: list[str]) -> DataFrame:
    """The first lines of ``files``; of Parquet only these files are opened."""
    paths = [unquote(f) for f in files]
    if fmt == "parquet" and not any(ch in p for p in paths for ch in "*?[]{}"):
        raw = _positioned_parquet(spark, paths)
    return raw.filter(F.col(FILE).isin(files) & (F.col(POS) <= HEADER_SEARCH_LINES))


def read_with_row_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A Parquet dataset with ``rowIndex``: the 0-based position over its files in part order.

    No shuffle and no unpartitioned window: positions come from the scan
    (``_metadata.row_index``) plus a per-file offset.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths)
    cols = [F.col(f"`{c}`") for c in df.columns]
    raw = df.select(*cols, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(POS))
    joined = raw.join(_small_side(_file_offsets(raw).select(FILE, "_off")), on=FILE)
    return joined.select(*cols, (F.col("_off") + F.col(POS)).alias(ROW_INDEX))


def positioned_lines(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """All sheet lines with their sheet line number ``_line`` and cells ``_c0..``."""
    return open_sheet(spark, paths, fmt).lines()


@dataclass(frozen=True)
class SheetHeader:
    raw: tuple[str | None, ...]
    names: tuple[str, ...]
    line: int


def _truthy(c) -> F.Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def _names(spark: SparkSession, raw: tuple) -> tuple[tuple, tuple[str, ...]]:
    """Header cells (without trailing blanks) and their camel-cased column names; errors on bad names."""
    while raw and raw[-1] in (None, ""):  # trailing empty cells are not columns
        raw = raw[:-1]
    names = tuple(text_values(spark, camel_case, raw))
    bad = [i for i, n in enumerate(names) if not n]
    if bad:
        raise ValueError(f"header cells without a usable name at positions {bad}: {[raw[i] for i in bad]}")
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names after camel case: {names}")
    return raw, names


def discover_header(sheet: Sheet, search: int = HEADER_SEARCH_LINES) -> SheetHeader:
    """Find the header line and camel-case its cells (S3, F1).

    Only lines 0..``search`` are inspected.  Raises when line 0's second cell
    is not blank or no header is found.
    """
    truthy = lambda v: v is not None and v != ""
    if len(_cells(sheet.raw)) < 2:
        raise ValueError("a mapping sheet needs at least two columns")
    by_line = {h[0]: h[1:] for h in sheet.head}
    found = next((n for n in range(1, search + 1) if n in by_line and truthy(by_line[n][1])), None)
    if 0 not in by_line or truthy(by_line[0][1]) or found is None:
        raise LookupError("no header line found: line 0 must have a blank 2nd cell and a header must "
                          f"follow within {search} lines")
    raw, names = _names(sheet.raw.sparkSession, tuple(by_line[found]))
    return SheetHeader(raw=raw, names=names, line=found)


def header_frame(sheet: Sheet, search: int = HEADER_SEARCH_LINES) -> DataFrame:
    """The discovered header as rows (position, headerText, columnName, headerLine), computed lazily."""
    lines = sheet.lines().filter(F.col(LINE) <= search)
    cells = _cells(lines)
    at = lines.filter((F.col(LINE) >= 1) & _truthy("_c1")).agg(F.min(LINE).alias("headerLine"))
    hdr = lines.join(F.broadcast(at), lines[LINE] == at["headerLine"], "inner")  # one-row aggregate
    arr = F.array(*cells)
    trailing = F.array_position(F.transform(F.reverse(arr), lambda x: x.isNotNull() & (x != "")), True) - 1
    kept = F.slice(arr, 1, F.size(arr) - trailing)  # trailing empty cells are not columns
    cells_t = hdr.select("headerLine", F.posexplode(kept).alias("position", "headerText"))
    return cells_t.select(F.col("position").cast("int").alias("position"), "headerText",
                          camel_case(F.col("headerText")).alias("columnName"), F.col("headerLine").cast("int"))


def _checked(lines: DataFrame, number: str, header: Column, width: int) -> DataFrame:
    """``lines`` after line 0; one after line ``header`` with a cell past the ``width`` names that is not blank raises."""
    after_title = F.col(number) >= 1
    extra = _cells(lines)[width:]
    if not extra:
        return lines.filter(after_title)
    wide = (F.col(number) > header) & F.greatest(*[_truthy(c).cast("int") for c in [extra[0], *extra]]).cast("boolean")
    error = F.raise_error(F.concat(F.lit(f"a line has more cells than the header's {width} names: line "), F.col(number), F.lit(" of "), F.col(FILE)))
    # in the cells too: the optimizer may move a later filter on them (the flags) before this one
    cells = {c: F.when(wide, error.cast("string")).otherwise(F.col(c)) for c in _cells(lines)[:width]}
    return lines.filter(F.when(wide, error.cast("boolean")).otherwise(after_title)).withColumns(cells)


def apply_header(lines: DataFrame, names: Sequence[str], header_line: int | None = None) -> DataFrame:
    """Name the cells by position; line 0 is consumed, ``rowIndex`` = line - 1.

    A line after ``header_line`` (by default the first of lines 1 to
    ``HEADER_SEARCH_LINES`` with a 2nd cell, or line 0 if there is none) with a
    cell past the names raises: no cell is dropped unseen.
    """
    if header_line is None and len(_cells(lines)) > len(names):
        searched = lines.filter(F.col(LINE).between(1, HEADER_SEARCH_LINES) & _truthy("_c1"))
        header_line = searched.agg(F.min(LINE)).first()[0]
    return _checked(lines, LINE, F.lit(header_line or 0), len(names)).select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)],
        (F.col(LINE) - 1).alias(ROW_INDEX),
    )


def read_sheet(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
               names: Sequence[str] | None = None, nrows: int | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """Read a sheet export; names are discovered unless given (S2 + S3 + R14).

    ``nrows`` caps the data lines read after line 0 (by position, so the
    cap is a filter on the line number, not a sample).
    """
    sheet = open_sheet(spark, paths, fmt)
    header_line = 0  # with names given, every line after line 0 counts
    if names is None:
        header = discover_header(sheet)
        names, header_line = header.names, header.line
    lines = sheet.lines() if nrows is None else sheet.lines().filter(F.col(LINE) <= nrows)
    return apply_header(lines, names, header_line), tuple(names)


def _sheet_lines(spark: SparkSession, paths: Sequence[str], fmt: str, folders: bool) -> DataFrame:
    """Lines of many sheets, FILE naming the sheet and POS the line in it.

    Every file is a sheet; with ``folders`` every folder is one, whose files
    are its parts in order (a sheet that one task could not write).
    """
    raw = _positioned(spark, paths, fmt, merge=True)
    if not folders:
        return raw
    parts = _small_side(_file_offsets(raw, F.regexp_extract(FILE, "^(.*)/[^/]*$", 1)).select(FILE, "_sheet", "_off"))
    return raw.join(parts, on=FILE).select(F.col("_sheet").alias(FILE), (F.col("_off") + F.col(POS)).alias(POS), *_cells(raw))


def sheet_headers(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                  search: int = HEADER_SEARCH_LINES, folders: bool = False) -> DataFrame:
    """Every file (or folder, ``_sheet_lines``) is its own sheet: the header of each, found by one distributed aggregate (S3, many files).

    One row per sheet: ``sheet`` (its path), ``headerLine``, the raw header
    cells ``hdr`` (a struct), and ``line0Named`` (true when line 0's 2nd
    cell is not blank, i.e. the sheet has no valid header).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _headers(_sheet_lines(spark, paths, fmt, folders), search)


def _headers(raw: DataFrame, search: int = HEADER_SEARCH_LINES) -> DataFrame:
    cells = _cells(raw)
    candidate = (F.col(POS) >= 1) & (F.col(POS) <= search) & _truthy("_c1")
    return raw.filter(F.col(POS) <= search).groupBy(FILE).agg(
        F.max(F.when((F.col(POS) == 0) & _truthy("_c1"), True).otherwise(False)).alias("line0Named"),
        F.min_by(F.struct(*cells), F.when(candidate, F.col(POS))).alias("hdr"),
        F.min(F.when(candidate, F.col(POS))).alias("headerLine"),
    ).withColumnRenamed(FILE, SHEET)


@dataclass(frozen=True)
class SheetSet:
    """Lines of many sheets under their names; ``variant`` tells which of the ``headers`` (names in sheet order) a row's sheet has."""

    rows: DataFrame
    names: tuple[str, ...]
    headers: tuple[tuple[str, ...], ...]

    def has(self, name: str) -> Column:
        """Whether a row's sheet has a column of that name."""
        return F.get(F.array(*[F.lit(name in h) for h in self.headers]), F.col(VARIANT))


def _header_variants(heads: DataFrame, cells: Sequence[str]) -> list[dict]:
    """Each different header once, with an example sheet, in the order of the examples; sheets without a header raise."""
    valid = ~F.col("line0Named") & F.col("hdr").isNotNull()
    found = (heads.groupBy(valid.alias("ok"), F.when(valid, F.col("hdr")).alias("hdr"), F.when(valid, F.col("_key")).alias("_key"))
             .agg(F.min(SHEET).alias("example")).limit(MAX_VARIANTS + 1).collect())  # one row per different header
    bad = [v["example"] for v in found if not v["ok"]]
    if bad:
        raise LookupError(f"no header line found in (e.g.): {bad}")
    if len(found) > MAX_VARIANTS:
        raise ValueError(f"more than {MAX_VARIANTS} different headers")
    return sorted(({"key": v["_key"], "example": v["example"], "texts": tuple(v["hdr"][c] for c in cells)} for v in found), key=lambda v: v["example"])


def open_sheets(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", folders: bool = False) -> SheetSet:
    """Many sheets at once, each a file (or a folder, ``_sheet_lines``), whose headers may differ in order and in number of columns.

    One pass finds the header of every sheet, and one row per different header
    reaches the driver.  The lines are read once: a line's cells are placed
    under the names of its own sheet's header (a staged row for each sheet
    tells which), and a name that a sheet does not have is null there.  Names
    stand in the order in which the headers (by sheet path) bring them.  A line
    after its header with a cell past that header's names raises.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = _sheet_lines(spark, paths, fmt, folders)
    cells = _cells(raw)
    heads = _staged(_headers(raw).withColumn("_key", F.to_json("hdr")), "sheet-headers")
    variants = _header_variants(heads, cells)
    headers = tuple(_names(spark, v["texts"])[1] for v in variants)
    names = tuple(dict.fromkeys(n for h in headers for n in h))
    numbers = spark.createDataFrame([(v["key"], i) for i, v in enumerate(variants)], f"_key string, {VARIANT} int")
    at = heads.join(F.broadcast(numbers), "_key").select(F.col(SHEET).alias(FILE), "headerLine", VARIANT)
    lines = raw.join(_small_side(_staged(at, "sheet-variants")), on=FILE)

    def of(values) -> Column:
        return F.get(F.array(*[F.lit(v).cast("int") for v in values]), F.col(VARIANT))

    row = F.array(*[F.col(c) for c in cells])
    width = of(len(h) for h in headers)
    extra = F.exists(F.slice(row, width + 1, F.lit(len(cells) + 1)), lambda c: c.isNotNull() & (c != ""))
    wide = (F.col(POS) > F.col("headerLine")) & extra
    error = F.raise_error(F.concat(F.lit("a line has more cells than the header's names: line "), F.col(POS), F.lit(" of "), F.col(FILE)))
    placed = [F.when(wide, error.cast("string")).otherwise(F.get(row, of(h.index(n) if n in h else None for h in headers))).alias(n) for n in names]
    rows = lines.filter(F.when(wide, error.cast("boolean")).otherwise(F.col(POS) >= 1)).select(
        *placed, (F.col(POS) - 1).alias(ROW_INDEX), F.col(FILE).alias(SHEET), VARIANT)
    return SheetSet(rows, names, headers)


def read_sheets(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                names: Sequence[str] | None = None, folders: bool = False) -> tuple[DataFrame, tuple[str, ...]]:
    """Read many sheets, each a file (or a folder, ``_sheet_lines``), at once: rows by name, ``rowIndex`` per sheet.

    Headers may differ from sheet to sheet (``open_sheets``); with ``names``
    given, all sheets have these columns.  Adds the ``sheet`` column (its path).
    """
    if names is None:
        found = open_sheets(spark, paths, fmt, folders)
        return found.rows.drop(VARIANT), found.names
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _checked(_sheet_lines(spark, paths, fmt, folders), POS, F.lit(0), len(names))
    out = lines.select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)],
        (F.col(POS) - 1).alias(ROW_INDEX),
        F.col(FILE).alias(SHEET),
    )
    return out, tuple(names)
