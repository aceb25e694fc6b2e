"""Hard negatives of anchors by a secondary-sort shuffle of packed pair scores.

Every anchor (a row whose id is divisible by ``every``) is scored against all
rows.  A pair becomes one byte string that sorts as (anchor, descending score,
positives before negatives, id); ``repartitionAndSortWithinPartitions`` deals
the strings by anchor and sorts them, and one streaming pass reads them: the
first ``positives`` rows of the anchor's label each open a window of scores as
they come by, a row of another label goes to every open window that its score
falls into and that is not full yet.  The pass holds the open windows only,
never an anchor's pairs.

Scores are taken in blocks: rows are packed into blocks of equal size, anchors
into blocks of their own, and every block of rows meets every block of anchors
once (the stated set of anchors against all rows).  A pair can be left out
before the shuffle if at least ``positives`` better rows of the anchor's label
stand in its own block, or ``wanted`` better rows of its block lie in the same
window; so the positives are sorted out first, and their windows travel with the
anchors into a second round that hands on at most ``wanted`` negatives of a block
for each window.  That is a combine before the shuffle; no other pair is dropped.

Scale: the product of anchors and rows is the work asked for; it is dealt out
as cells of (rows block, group of anchor blocks), each a bounded task.  What
an anchor's stream holds is bounded by its number of cells times
``positives`` + ``positives`` * ``wanted``, read from disk in order.  A label that a
third of the rows have only makes a block's choice longer.  The driver
receives counts.

Defined results: rows with a null label, a null or empty vector or a null or
non-finite entry take no part, nor do vectors of another length than the
commonest (the longer of two as common); a null id is no anchor and sorts
last; repeated rows are rows of their own (a copy of an anchor is another row
of its label); anchors without a positive, and positives without a negative in
their window, give no rows; an empty table gives none; extra columns are not
read.  Entries are limited so that a score fits a long (to 2**20 at 64
dimensions).
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetwright.llm.common import each, staged
from sheetwright.llm.vectors import commonest_length, matrix
from sheetwright.llm.whitening import vectors_of

EVERY = 100
POSITIVES, WANTED = 5, 10
LOW, HIGH = 30, 90
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 19
ANCHORS, GROUP = 1024, 16
POSITIVE, NEGATIVE = 0, 1
_ID_BITS = 12
_SIGN = 1 << 63

#: anchor row, anchor id, score (descending), positive or negative, whether the id is null, id: big-endian, so bytes sort as the tuple does
PAIR = struct.Struct(">QQQBBQ")
PAIRS = np.dtype([("row", ">u8"), ("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("unnamed", "u1"), ("id", ">u8")])

BLOCK = "block bigint, named binary, ids binary, labels binary, width int, vectors binary"
ANCHOR = "row bigint, anchor bigint, label bigint, vector array<bigint>"
ANCHOR_BLOCK = "part bigint, rows binary, anchors binary, anchor_labels binary, anchor_width int, anchor_vectors binary, windows binary"


def labelled(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """Rows (vec_id, label, _v) that take part; labels of ids divisible by 7 move on by one, modulo 10."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors_of(embeddings, "embedding", F.col("vec_id").cast("bigint").alias("vec_id"), moved.alias("label"))
    return rows.where("label IS NOT NULL").select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * scale)).alias("_v"))


def short(values: np.ndarray) -> np.ndarray:
    """``values`` in the narrowest of 16, 32 and 64 bits."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def packed(rows: DataFrame, dimensions: int, parts: int, block_rows: int) -> DataFrame:
    """Blocks of ``block_rows`` rows, each in the order of their ids (null last)."""
    limit = math.isqrt((1 << 62) // dimensions)

    def block(number: int, tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables).combine_chunks()
        ids = table.column("vec_id")
        named = ids.is_valid().to_numpy()
        ids = ids.fill_null(0).to_numpy()
        order = np.lexsort((ids, ~named))
        vectors = short(np.clip(matrix(table.column("_v").combine_chunks(), dimensions), -limit, limit)[order])
        blobs = [named[order], ids[order], table.column("label").to_numpy()[order]]
        return pa.RecordBatch.from_arrays(
            [pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs),
             pa.array([vectors.itemsize], pa.int32()), pa.array([vectors.tobytes()], pa.binary())], names=["block", "named", "ids", "labels", "width", "vectors"])

    def run(batches):
        number, held, n = 0, [], 0
        for batch in each(batches):
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, block_rows - n)
                held, n, at = [*held, piece], n + piece.num_rows, at + piece.num_rows
                if n == block_rows:
                    yield block(number, held)
                    number, held, n = number + 1, [], 0
        if held:
            yield block(number, held)

    return rows.repartition(parts).mapInArrow(run, BLOCK)


class Block:
    """A block of rows in the order of their ids."""

    def __init__(self, row: dict, dimensions: int):
        self.named = np.frombuffer(row["named"], bool)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.rows = (row["block"] << _ID_BITS) + np.arange(len(self.ids))
        self.vectors = np.frombuffer(row["vectors"], f"i{row['width']}").reshape(-1, dimensions)


def anchors_of(blocks: DataFrame, dimensions: int, every: int) -> DataFrame:
    """Rows (row, anchor, label, vector): the anchors."""

    def run(batches):
        for batch in each(batches):
            for row in batch.to_pylist():
                block = Block(row, dimensions)
                at = np.flatnonzero(block.named & (block.ids % every == 0))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * dimensions, pa.int32()), pa.array(block.vectors[at].astype(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(block.rows[at]), pa.array(block.ids[at]), pa.array(block.labels[at]), lists],
                                                 names=["row", "anchor", "label", "vector"])

    return blocks.mapInArrow(run, ANCHOR)


def anchor_blocks(anchors: DataFrame, parts: int, dimensions: int) -> DataFrame:
    """The anchors (with ``windows``, the scores of their positives) dealt to ``parts`` blocks."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = short(matrix(table.column("vector").combine_chunks(), dimensions))
        windows = np.zeros((table.num_rows, POSITIVES + 1), np.int64)  # their number, then their scores
        for i, scores in enumerate(table.column("windows").to_pylist()):
            windows[i, 0], windows[i, 1 : len(scores) + 1] = len(scores), scores
        blobs = [table.column(n).to_numpy().tobytes() for n in ("row", "anchor", "label")]
        return pa.table([table.column("part").slice(0, 1), *(pa.array([b], pa.binary()) for b in blobs), pa.array([vectors.itemsize], pa.int32()),
                         pa.array([vectors.tobytes()], pa.binary()), pa.array([windows.tobytes()], pa.binary())],
                        names=["part", "rows", "anchors", "anchor_labels", "anchor_width", "anchor_vectors", "windows"])

    part = F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part")
    return anchors.select(part, "row", "anchor", "label", "vector", "windows").groupBy("part").applyInArrow(pack, ANCHOR_BLOCK)


def cells(blocks: DataFrame, n_blocks: int, anchors: DataFrame, parts: int) -> DataFrame:
    """Every block of rows beside every block of anchors, dealt out by (rows block, group of anchor blocks)."""
    groups = -(-parts // GROUP)
    tasks = max(1, min(n_blocks * groups, 100_000))
    rows = blocks.withColumn("at", F.pmod(F.xxhash64("block"), F.lit(n_blocks))).withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sets = anchors.withColumn("of", (F.col("part") % groups).cast("int")).withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    return rows.repartition(tasks, "at", "of").join(sets.repartition(tasks, "at", "of").hint("merge"), ["at", "of"])


def scores_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices, exactly."""
    most = int(np.abs(left.astype(np.int64)).max(initial=0)) * int(np.abs(right.astype(np.int64)).max(initial=0)) * left.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)


def positive_pairs(scores: np.ndarray, block: Block, rows: np.ndarray, labels: np.ndarray) -> Iterator[np.ndarray]:
    """For each anchor the places of its first ``POSITIVES`` rows in this block."""
    for i, own in enumerate(scores):
        at = np.flatnonzero((block.labels == labels[i]) & (block.rows != rows[i]))
        yield at[np.argsort(-own[at], kind="stable")[:POSITIVES]]


def negative_pairs(scores: np.ndarray, block: Block, labels: np.ndarray, windows: np.ndarray) -> Iterator[np.ndarray]:
    """For each anchor the places of the first ``WANTED`` rows of other labels in each of its windows in this block."""
    order = np.argsort(-scores, axis=1, kind="stable")
    for i, own in enumerate(scores):
        at = order[i][block.labels[order[i]] != labels[i]]
        falling = -own[at]
        taken = np.zeros(len(at), bool)
        for score in windows[i, 1 : windows[i, 0] + 1].tolist():
            first = np.searchsorted(falling, -(HIGH * score // 100))
            end = np.searchsorted(falling, (-LOW * score) // 100, "right")
            taken[first : min(first + WANTED, end)] = True
        yield at[taken]


def pair_keys(joined: DataFrame, dimensions: int, kind: int) -> DataFrame:
    """Rows (key): the pairs of every cell that can matter, packed."""

    def run(batches):
        for batch in each(batches):
            for row in batch.to_pylist():
                block = Block(row, dimensions)
                rows, anchors, labels = (np.frombuffer(row[n], np.int64) for n in ("rows", "anchors", "anchor_labels"))
                vectors = np.frombuffer(row["anchor_vectors"], f"i{row['anchor_width']}").reshape(-1, dimensions)
                windows = np.frombuffer(row["windows"], np.int64).reshape(-1, POSITIVES + 1)
                for a in range(0, len(rows), 256):
                    some = slice(a, a + 256)
                    scores = scores_of(vectors[some], block.vectors)
                    found = list(positive_pairs(scores, block, rows[some], labels[some]) if kind == POSITIVE
                                 else negative_pairs(scores, block, labels[some], windows[some]))
                    of = np.repeat(np.arange(len(found)), [len(x) for x in found])
                    at = np.concatenate(found)
                    keys = np.empty(len(at), PAIRS)
                    keys["row"], keys["anchor"] = rows[some][of], sortable(anchors[some][of])
                    keys["score"] = ~sortable(scores[of, at])
                    keys["kind"], keys["unnamed"], keys["id"] = kind, ~block.named[at], sortable(block.ids[at])
                    lists = pa.Array.from_buffers(pa.binary(PAIRS.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
                    yield pa.RecordBatch.from_arrays([lists.cast(pa.binary())], names=["key"])

    return joined.mapInArrow(run, "key binary")


def sortable(values: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones in the same order."""
    return values.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)


def sorted_pairs(keys: DataFrame, parts: int):
    """RDD of (key, None), dealt by anchor row and sorted within partitions."""
    pairs = keys.rdd.map(lambda r: (bytes(r[0]), None))
    return pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))


def unpacked(key: bytes):
    """(anchor row, anchor id, score, kind, id) of a packed pair."""
    row, anchor, score, kind, unnamed, name = PAIR.unpack(key)
    return row, anchor - _SIGN, (_SIGN - 1) - score, kind, None if unnamed else name - _SIGN


def first_positives(pairs) -> Iterator[tuple]:
    """(anchor row, score, key) of the first ``POSITIVES`` pairs of each anchor."""
    last, taken = None, 0
    for key, _ in pairs:
        row, _, score, _, _ = unpacked(key)
        last, taken = row, taken + 1 if row == last else 1
        if taken <= POSITIVES:
            yield row, score, bytearray(key)


def negatives(pairs) -> Iterator[tuple]:
    """The result rows of sorted pairs: positives open windows, negatives go to the open windows that hold their score."""
    last, windows = None, []
    for key, _ in pairs:
        row, anchor, score, kind, name = unpacked(key)
        if row != last:
            last, windows = row, []
        if kind == POSITIVE:
            windows.append([name, score, 0])
            continue
        for window in windows:
            positive, best, n = window
            if n < WANTED and LOW * best <= 100 * score <= HIGH * best:
                window[2] = n + 1
                yield anchor, positive, n + 1, name, best, score


def mined(embeddings: DataFrame, every: int = EVERY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark: SparkSession = embeddings.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = labelled(embeddings)
    dimensions = commonest_length(rows, "_v")
    if not dimensions:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("_v") == dimensions)
    block_rows = max(1, min(block_rows, 1 << _ID_BITS, BLOCK_BYTES // (2 * dimensions)))
    parts = max(1, min(-(-rows.count() // block_rows), 100_000))
    blocks = staged(packed(rows, dimensions, parts, block_rows), "negatives-blocks")
    n_blocks = blocks.count()
    anchors = staged(anchors_of(blocks, dimensions, every), "negatives-anchors")
    anchor_parts = max(1, -(-anchors.count() // ANCHORS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pairs(rows_: DataFrame, kind: int) -> DataFrame:
        sets = staged(anchor_blocks(rows_, anchor_parts, dimensions), "negatives-anchor-blocks")
        return pair_keys(cells(blocks, n_blocks, sets, anchor_parts), dimensions, kind)

    none = anchors.withColumn("windows", F.array().cast("array<bigint>"))
    found = sorted_pairs(pairs(none, POSITIVE), tasks).mapPartitions(first_positives)
    positives = staged(spark.createDataFrame(found, "row bigint, score bigint, key binary", verifySchema=False), "negatives-positives")
    windows = positives.groupBy("row").agg(F.collect_list("score").alias("windows"))  # at most POSITIVES
    keys = pairs(anchors.join(windows, "row"), NEGATIVE).unionByName(positives.select("key"))
    return spark.createDataFrame(sorted_pairs(keys, tasks).mapPartitions(negatives), schema, verifySchema=False)


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0),
positives AS (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
found AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id
  WHERE NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= {WANTED}
"""
