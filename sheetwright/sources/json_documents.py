"""General JSON documents (any layout) read by many tasks: a list of records, or one record, in each file.

Where a record of a document ends depends on everything before it, but only on
two things: whether a text is open, and how many brackets are.  Files are read
in pieces that end at ``}``, split as Spark splits the files.  A first pass
takes of every file block how it changes this state: the parity of its quotes,
and under both hypotheses (the block begins outside, or inside, a text) the
change of the depth and the least depth after a ``}``.  These changes are
composed over the blocks, one narrow row each, by running sums.  A second pass,
which knows its block's state, cuts the block into records; the few records
that cross borders of blocks are put together by the block they begin in.

Texts hold no raw line breaks or other control characters in valid JSON, and
a backslash before ``}`` is no escape, so no escape crosses a piece.  A file's
bytes are counted, so the part after its last ``}`` is known.  What stands
between records must be exactly a comma, before them ``[`` and after them
``]`` (or nothing at all for a single record); anything else, an open bracket
or text at the end, and every record that does not parse, raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .csv_records import BLOCK, FILE, _runs
from .sheets import MAX_BROADCAST_ROWS

_SLICE = 1 << 20
_NONE = 1 << 40
_COUNTS = (f"{FILE} string, {BLOCK} bigint, _n bigint, _bytes bigint, _size bigint, _first string, _quotes bigint, "
           "_delta0 bigint, _delta1 bigint, _low0 bigint, _low1 bigint")
_PIECES = f"{FILE} string, {BLOCK} bigint, _opener bigint, _raw string, _kind string, _start boolean"
#: Kinds of rows: a record, a piece of one that crosses blocks, what stands after the last record.
RECORD, PIECE, END = "record", "piece", "end"


def document_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows (file, block, size, number, text): the files cut after every ``}``, without it."""
    return spark.read.text(paths, lineSep="}").select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_m"), F.col("value").cast("binary").alias("_text"))


def _slices(part: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """(pieces, their bytes with each ``}``), about a megabyte at a time."""
    held, size = [], 0
    for text in part.column("_text").to_pylist():
        held.append(text)
        size += len(text)
        if size >= _SLICE:
            yield len(held), b"}".join(held) + b"}"
            held, size = [], 0
    if held:
        yield len(held), b"}".join(held) + b"}"


def _structure(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, quotes before each byte, change of depth at each byte where it is outside of texts)."""
    code = np.frombuffer(data, np.uint8)
    quote = code == 0x22
    back = code == 0x5C
    if back.any():
        place = np.arange(len(code), dtype=np.int32)
        other = np.maximum.accumulate(np.where(back, np.int32(-1), place))
        run = np.zeros(len(code), np.int32)  # backslashes right before each byte
        run[1:] = place[:-1] - other[:-1]
        quote &= run % 2 == 0
    before = np.cumsum(quote, dtype=np.int32) - quote
    step = ((code == 0x7B) | (code == 0x5B)).astype(np.int32) - ((code == 0x7D) | (code == 0x5D))
    return code, before, step


def block_changes(pieces: DataFrame) -> DataFrame:
    """One row for each block: pieces, bytes, first sign, and how it changes the state from either start."""

    def run(batches):
        block, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, part in _runs(batch):
                if key != block:
                    if block is not None:
                        yield pa.RecordBatch.from_pylist([held], schema)
                    block = key
                    held = {FILE: key[0], BLOCK: key[1], "_n": 0, "_bytes": 0, "_size": part.column("_size")[0].as_py(), "_first": None,
                            "_quotes": 0, "_delta0": 0, "_delta1": 0, "_low0": _NONE, "_low1": _NONE}
                for n, data in _slices(part):
                    code, before, step = _structure(data)
                    closing = code == 0x7D
                    for start in (0, 1):
                        outside = (before + held["_quotes"] + start) % 2 == 0
                        depth = held[f"_delta{start}"] + np.cumsum(step * outside)
                        held[f"_low{start}"] = min(held[f"_low{start}"], int(depth[closing & outside].min(initial=_NONE)))
                        held[f"_delta{start}"] = int(depth[-1])
                    held["_quotes"] = (held["_quotes"] + int(before[-1]) + (code[-1] == 0x22)) % 2
                    held["_n"], held["_bytes"] = held["_n"] + n, held["_bytes"] + len(data)
                    if held["_first"] is None:
                        held["_first"] = data.lstrip(b" \t\r\n")[:1].decode("latin-1") or None
        if block is not None:
            yield pa.RecordBatch.from_pylist([held], schema)

    names = [f.split()[0] for f in _COUNTS.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in _COUNTS.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))
    return pieces.select(FILE, BLOCK, "_size", "_text").mapInArrow(run, _COUNTS)


def block_states(changes: DataFrame) -> DataFrame:
    """Rows for each block: the state it begins in, its file's kind of document, and which block the record under way began in."""
    whole = Window.partitionBy(FILE)
    order = whole.orderBy(BLOCK)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = changes.withColumns({
        "_inside": F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2,
        "_base": F.when(F.first("_first", True).over(every) == "[", 1).otherwise(0),
        "_cut": F.sum("_bytes").over(whole) - F.col("_size"),  # 1 where something stands after the last }
        "_last": F.col(BLOCK) == F.max(BLOCK).over(whole)})
    # a byte order mark is in the size but not in the text
    state = state.withColumn("_cut", F.when(F.col("_cut").isin(-3, -2), F.col("_cut") + 3).otherwise(F.col("_cut")))
    state = state.withColumns({x: F.when(F.col("_inside") == 0, F.col(f"{x}0")).otherwise(F.col(f"{x}1")) for x in ("_delta", "_low")})
    state = state.withColumn("_depth", F.coalesce(F.sum("_delta").over(earlier), F.lit(0)))
    state = state.withColumns({"_inside_after": (F.col("_inside") + F.col("_quotes")) % 2, "_depth_after": F.col("_depth") + F.col("_delta")})
    under_way = (F.col("_inside") == 1) | (F.col("_depth") > F.col("_base"))
    stays_open = (F.col("_inside_after") == 1) | (F.col("_depth_after") > F.col("_base"))
    opens = stays_open & (~under_way | (F.col("_depth") + F.col("_low") <= F.col("_base")))
    return state.withColumn("_opener", F.last(F.when(opens, F.col(BLOCK)), True).over(earlier))


def check_states(states: DataFrame) -> None:
    """Raise for a file whose brackets or texts do not close, or whose bytes were not all read."""
    closed = (F.col("_inside_after") == 0) & (F.col("_depth_after") + F.col("_cut") == 0)
    bad = states.where("_last").where(~closed | ~F.col("_cut").isin(0, 1)).select(FILE, "_cut").first()
    if bad:
        why = "malformed JSON document" if bad["_cut"] in (0, 1) else "the bytes read differ from the file's size (compressed documents cannot be split)"
        raise ValueError(f"{why}: {bad[FILE]}")


def block_rows(pieces: DataFrame) -> DataFrame:
    """Rows (file, block, opener, raw, kind, start): what every block holds; ``start`` where nothing of the document comes before.

    ``pieces`` stand in the order of the file within each block, and carry the columns of ``block_states``.
    """
    schema = pa.schema([(FILE, pa.string()), (BLOCK, pa.int64()), ("_opener", pa.int64()), ("_raw", pa.string()), ("_kind", pa.string()), ("_start", pa.bool_())])

    def rows(block, opener, raws: list[bytes], kinds: list[str], starts: list[bool]):
        n = len(raws)
        return pa.RecordBatch.from_arrays(
            [pa.array([block[0]] * n, pa.string()), pa.array([block[1]] * n, pa.int64()), pa.array([opener] * n, pa.int64()),
             pa.array(raws, pa.binary()).cast(pa.string()), pa.array(kinds, pa.string()), pa.array(starts, pa.bool_())], schema=schema)

    def run(batches):
        block, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, part in _runs(batch):
                if key != block:
                    if block is not None:
                        yield from held.finish(rows)
                    block, held = key, _Held(key, {c: part.column(c)[0].as_py() for c in names[3:]})
                for n, data in _slices(part):
                    yield from held.records(n, data, rows)
        if block is not None:
            yield from held.finish(rows)

    names = [FILE, BLOCK, "_text", "_n", "_inside", "_depth", "_base", "_cut", "_last", "_opener"]
    return pieces.select(*names).mapInArrow(run, _PIECES)


class _Held:
    """Where the reading of a block stands."""

    def __init__(self, block, state: dict):
        self.block, self.base, self.pieces = block, state["_base"], state["_n"]
        self.inside, self.depth, self.opener = state["_inside"], state["_depth"], state["_opener"]
        self.remainder = state["_last"] and state["_cut"] == 1
        self.seen, self.open = 0, []
        self.began = not (self.inside or self.depth > self.base)  # the record under way began in this block
        self.start = self.began and self.depth == 0 and block[1] == 0

    def records(self, n: int, data: bytes, rows):
        self.seen += n
        last = self.remainder and self.seen == self.pieces
        code, before, step = _structure(data[:-1] if last else data)
        if len(code):
            outside = (before + self.inside) % 2 == 0
            depth = self.depth + np.cumsum(step * outside)
            ends = (np.flatnonzero((code == 0x7D) & outside & (depth == self.base)) + 1).tolist()
            self.inside = (self.inside + int(before[-1]) + (code[-1] == 0x22)) % 2
            self.depth = int(depth[-1])
        else:
            ends = []
        cuts = list(zip([0, *ends], ends))
        raws = [data[a:b] for a, b in cuts]
        if raws and self.open:
            raws[0] = b"".join([*self.open, raws[0]])
            self.open = []
        if raws:
            kinds = [RECORD if self.began else PIECE] + [RECORD] * (len(raws) - 1)
            yield rows(self.block, self.opener, raws, kinds, [self.start] + [False] * (len(raws) - 1))
            self.began, self.start = True, False
        rest = data[ends[-1] if ends else 0 : len(code)]
        if rest:
            self.open.append(rest)

    def finish(self, rows):
        if self.seen != self.pieces:
            raise ValueError(f"the file scan changed between counting and reading: {self.block}")
        rest = b"".join(self.open)
        if self.remainder:
            yield rows(self.block, self.opener, [rest], [END], [self.start])
        elif rest:  # a record goes on in the next block
            yield rows(self.block, self.block[1] if self.began else self.opener, [rest], [PIECE], [self.start])


def stitched(found: DataFrame) -> DataFrame:
    """Records that cross borders of blocks, by the block they begin in."""
    parts = F.sort_array(F.collect_list(F.struct(BLOCK, "_raw")))
    return found.where(F.col("_kind") == PIECE).groupBy(FILE, "_opener").agg(
        F.array_join(F.transform(parts, lambda p: p["_raw"]), "").alias("_raw"), F.max("_start").alias("_start"))


def _record_text(raw: Column, start: Column, base: Column, path: Column) -> Column:
    """The record of a row, without what must stand before it."""
    lead = F.regexp_extract(raw, r"^[^{]*", 0)
    before = F.when(start & (base == 1), lead.rlike(r"^[ \t\r\n]*\[[ \t\r\n]*$")).when(start, lead.rlike(r"^[ \t\r\n]*$"))
    fits = before.otherwise((base == 1) & lead.rlike(r"^[ \t\r\n]*,[ \t\r\n]*$"))
    return F.when(fits, F.substring(raw, F.length(lead) + 1, F.length(raw))).otherwise(_malformed(path))


def _malformed(path: Column) -> Column:
    return F.raise_error(F.concat(F.lit("malformed JSON document: "), path)).cast("string")


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One column ``_json``: the text of every record of the documents, each block of a file read by its own task."""
    pieces = document_pieces(spark, paths)
    states = _staged(block_states(_staged(block_changes(pieces), "json-changes")), "json-states")
    check_states(states)
    known = states.select(FILE, BLOCK, "_n", "_inside", "_depth", "_base", "_cut", "_last", "_opener")
    if states.count() <= MAX_BROADCAST_ROWS:
        lines = pieces.join(F.broadcast(known), [FILE, BLOCK])
    else:  # a shuffle deals whole blocks but not in order
        lines = pieces.join(known, [FILE, BLOCK]).sortWithinPartitions(FILE, BLOCK, "_m")
    found = _staged(block_rows(lines), "json-pieces")
    base = states.groupBy(FILE).agg(F.max("_base").alias("_base"))
    base = F.broadcast(base) if base.count() <= MAX_BROADCAST_ROWS else base
    records = found.where(F.col("_kind") == RECORD).select(FILE, "_raw", "_start").unionByName(
        _staged(stitched(found), "json-across").select(FILE, "_raw", "_start"))
    texts = records.join(base, FILE).select(_record_text(F.col("_raw"), F.col("_start"), F.col("_base"), F.col(FILE)).alias("_json"))
    # what stands after the last record: kept in the plan, as rows that must not exist
    raw, start, one = F.col("_raw"), F.col("_start"), F.col("_base") == 0
    blank = r"^[ \t\r\n]*$"
    fits = F.when(one, ~start & raw.rlike(blank)).when(start, raw.rlike(r"^[ \t\r\n]*\[[ \t\r\n]*\][ \t\r\n]*$")).otherwise(raw.rlike(r"^[ \t\r\n]*\][ \t\r\n]*$"))
    bad = found.where(F.col("_kind") == END).join(base, FILE).where(~fits)
    return texts.unionByName(bad.select(_malformed(F.col(FILE)).alias("_json")))
