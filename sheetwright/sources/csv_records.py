"""CSV records whose quoted cells may span lines, put together from every split of a file at once.

Whether a line starts a record depends on the quotes of all lines before it,
but only on their number modulo 2.  So one pass over the lines, split as Spark
splits the files, counts for each file block its quotes and its record starts
under both hypotheses (the block begins outside, or inside, a quoted cell);
prefix sums over the blocks, one narrow row each, tell which one holds and how
many records came before.  A second pass cuts every block into records with
their final numbers.  Only a record that crosses a border of blocks is left in
pieces: these few are put together by file and record number.

No file is gathered in one task and no line is sorted.  A record is one value,
so a cell that spans many blocks is as large as it is in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns of lines and of records: file, block of the file, number of the record in its file.
FILE, BLOCK, POS = "_file", "_blk", "_pos"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of a batch of lines that belong to one block."""
    block = batch.column(BLOCK).to_numpy()
    file = batch.column(FILE).dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield (batch.column(FILE)[int(a)].as_py(), int(block[a])), batch.slice(a, b - a)


def _odd(lines: pa.Array) -> np.ndarray:
    """1 for lines with an odd number of quotes."""
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1


def block_counts(lines: DataFrame) -> DataFrame:
    """One row for each block: lines, quotes modulo 2, and record starts if it begins outside (``_even``) or inside (``_odd``) quotes."""

    def run(batches):
        block, counts, parity = None, [0, 0, 0], 0

        def row():
            return pa.RecordBatch.from_pylist([{FILE: block[0], BLOCK: block[1], "_n": counts[0], "_quotes": parity, "_even": counts[1], "_odd": counts[2]}], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            for key, part in _runs(batch):
                if key != block:
                    if block is not None:
                        yield row()
                    block, counts, parity = key, [0, 0, 0], 0
                odd = _odd(part.column("_text"))
                before = (parity + np.cumsum(odd) - odd) & 1
                inside = int(before.sum())
                counts = [counts[0] + len(odd), counts[1] + len(odd) - inside, counts[2] + inside]
                parity = int(parity + odd.sum()) & 1
        if block is not None:
            yield row()

    schema = pa.schema([(FILE, pa.string()), (BLOCK, pa.int64()), ("_n", pa.int64()), ("_quotes", pa.int64()), ("_even", pa.int64()), ("_odd", pa.int64())])
    return lines.select(FILE, BLOCK, "_text").mapInArrow(run, f"{FILE} string, {BLOCK} bigint, _n bigint, _quotes bigint, _even bigint, _odd bigint")


def block_starts(counts: DataFrame) -> DataFrame:
    """Rows (file, block, _n, _inside, _base): whether the block begins inside quotes, and the records that start before it."""
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    state = counts.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("_inside") == 0, F.col("_even")).otherwise(F.col("_odd"))
    return state.withColumn("_s", starts).select(FILE, BLOCK, "_n", "_inside", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_base"))


def block_records(lines: DataFrame) -> DataFrame:
    """Rows (file, block, number, text, _whole): the records of every block, and the pieces of those that cross its borders.

    ``lines`` stand in the order of the file within each block, and carry the
    columns of ``block_starts``.
    """
    schema = pa.schema([(FILE, pa.string()), (BLOCK, pa.int64()), (POS, pa.int64()), ("_text", pa.string()), ("_whole", pa.bool_())])

    def made(block, first: int, texts: list[str], whole: list[bool]) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([block[0]] * n, pa.string()), pa.array(np.full(n, block[1]), pa.int64()), pa.array(np.arange(first, first + n), pa.int64()),
             pa.array(texts, pa.string()), pa.array(whole, pa.bool_())], schema=schema)

    def run(batches):
        block, held = None, None

        def finish():
            if held.seen != held.lines:
                raise ValueError(f"the file scan changed between counting and reading: {block}")
            if held.open:
                yield made(block, held.number, ["\n".join(held.open)], [False])

        for batch in batches:
            if not batch.num_rows:
                continue
            for key, part in _runs(batch):
                if key != block:
                    if block is not None:
                        yield from finish()
                    block, held = key, _Held(part)
                first, texts, whole = held.records(part.column("_text"))
                if texts:
                    yield made(block, first, texts, whole)
        if block is not None:
            yield from finish()

    names = [FILE, BLOCK, "_text", "_n", "_inside", "_base"]
    return lines.select(*names).mapInArrow(run, f"{FILE} string, {BLOCK} bigint, {POS} bigint, _text string, _whole boolean")


class _Held:
    """Where the reading of a block stands: the record under way, its lines so far, whether it began in this block."""

    def __init__(self, part: pa.RecordBatch):
        inside, base, self.lines = (part.column(c)[0].as_py() for c in ("_inside", "_base", "_n"))
        self.inside, self.number, self.seen = inside, base - 1 if inside else base, 0
        self.open: list[str] = []
        self.began = False

    def records(self, lines: pa.Array) -> tuple[int, list[str], list[bool]]:
        """(number of the first, texts, whether each is whole) of the records that end in these lines."""
        odd = _odd(lines)
        before = (self.inside + np.cumsum(odd) - odd) & 1
        self.inside = int(self.inside + odd.sum()) & 1
        self.seen += len(odd)
        starts = np.flatnonzero(before == 0).tolist()
        texts, out, whole = lines.to_pylist(), [], []
        first = self.number
        if self.open or not starts or starts[0]:  # lines of the record under way
            end = starts[0] if starts else len(texts)
            self.open += texts[:end]
            if starts or not self.inside:
                out.append("\n".join(self.open))
                whole.append(self.began)
                self.open, self.began = [], False
        ends = [*starts[1:], len(texts)]
        if starts and self.inside:  # the last record goes on beyond these lines
            self.open, self.began = texts[starts.pop():], True
            ends.pop()
        out += [texts[a] if b - a == 1 else "\n".join(texts[a:b]) for a, b in zip(starts, ends)]
        whole += [True] * len(starts)
        self.number += len(out)
        return first, out, whole


def stitched(pieces: DataFrame) -> DataFrame:
    """Rows (file, number, text): the records that cross borders of blocks."""
    parts = F.sort_array(F.collect_list(F.struct(BLOCK, "_text")))
    return pieces.where("NOT _whole").groupBy(FILE, POS).agg(F.array_join(F.transform(parts, lambda p: p["_text"]), "\n").alias("_text"))
