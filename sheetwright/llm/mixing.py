"""Mixing sources to target weights: packed blocks drawn through index permutations.

The words of a source, its documents in a seeded order one after another, are
packed into blocks of ``block_words``.  The mix is a number of output shards
made of slots, one block each.  How many slots of a shard go to each source is
drawn multinomially, given the sources' totals (so the totals come out at the
targets; only their spread over the shards is random).  The t-th slot of a
source with n blocks takes block P(t mod n), P being a pseudorandom
permutation of 0..n-1 (a Feistel network, walked until it falls into range) of
the source and of the round t div n.  Slots and blocks meet in a join by block
index; no shuffled list of blocks is ever drawn up.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
``share`` times all words; a target stops at ``most`` times its source's
words and the excess goes to the others by weight until none is above.

Scale: a document's place in its source's word stream is a running total over
ranges of a uniform key, whose number follows the row count, so no source is
gathered in one task.  Only one row per source (name, words) reaches the driver.
Narrow rows are placed and joined; a document moves once, to meet its pieces.

Defined results: a null or blank text has size 0 and nothing taken; a null
source is a source of its own; a source without words has target 0; equal rows
count each; an empty table gives no rows; a long text is as many blocks as it
fills; further columns of documents stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetwright.llm.common import bucket_count, each, key_range, placed, staged
from sheetwright.llm.sharding import source_key
from sheetwright.llm.textbytes import SPACES, U64, mix, random_words, slices, text_bytes, word_table, words

WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 4
GROUP_SLOTS = 1 << 29


def targets(sizes: list[tuple[str | None, int]], weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Target words of each source, from (source, words) pairs."""
    named = sorted((s for s, _ in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order = named + [None] * any(s is None for s, _ in sizes)
    size = dict(sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(size.values()), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / whole > most * size[s]]
        for s in full or list(open_):
            out[s] = float(most * size[s]) if full else left * weight[s] / whole
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


def permuted(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Places of ``index`` in a pseudorandom permutation of 0..n-1 chosen by ``seed``.

    A Feistel network permutes the smallest 4**h that is not below ``n``; a
    value that falls out of range goes through it again, which stays one to one.
    """
    half = U64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (U64(1) << half) - U64(1)
    keys = random_words(ROUNDS, seed)

    def network(value):
        left, right = value >> half, value & mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        return (left << half) | right

    value = network(index.astype(U64))
    while (out := value >= U64(n)).any():
        value[out] = network(value[out])
    return value.astype(np.int64)


def split_counts(rng: np.random.Generator, counts: np.ndarray, draw: int) -> np.ndarray:
    """How ``draw`` of the slots fall to the sources, multinomial given the sources' totals ``counts``."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for s, own in enumerate(counts.tolist()):
        rest -= own
        out[s] = int(rng.hypergeometric(own, rest, draw)) if own and draw else 0
        draw -= int(out[s])
    return out


def group_counts(totals: np.ndarray, group: int, group_slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this group of shards, slots of each source in it).

    Every group takes of each source the group's share of what is left, whole
    slots first, then the largest remainders (of equal ones the earlier source).
    """
    left, before = totals.tolist(), [0] * len(totals)
    for g in range(group + 1):
        whole = sum(left)
        slots = min(group_slots, whole)
        own = [n * slots // max(1, whole) for n in left]
        for s in sorted(range(len(left)), key=lambda s: (-(left[s] * slots % max(1, whole)), s))[: slots - sum(own)]:
            own[s] += 1
        if g < group:
            left, before = [n - o for n, o in zip(left, own)], [n + o for n, o in zip(before, own)]
    return np.array(before, np.int64), np.array(own, np.int64)


def shard_counts(totals: np.ndarray, shard: int, shards: int, slots: int, seed: int, group_shards: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this shard, slots of each source in it).

    Groups of at most ``GROUP_SLOTS`` slots (a bound of the exact sampler)
    share the totals evenly.  The shards of a group form a binary tree; each
    node splits its totals between its halves with a seed of its own, so any
    shard is drawn alone and all agree.
    """
    group_shards = group_shards or max(1, GROUP_SLOTS // slots)
    group = shard // group_shards
    before, counts = group_counts(totals, group, group_shards * slots)
    low, high = group * group_shards, min(shards, (group + 1) * group_shards)
    while high - low > 1:
        mid = (low + high) // 2
        left = split_counts(np.random.default_rng([seed, low, high]), counts, min(int(counts.sum()), (mid - low) * slots))
        if shard < mid:
            high, counts = mid, left
        else:
            low, counts, before = mid, counts - left, before + left
    return before, counts


def mix_slots(spark, totals: list[int], blocks: list[int], shard_slots: int = 1024, seed: int = 42) -> DataFrame:
    """Rows (shard, slot, source_no, draw, block): the mix, ``totals[s]`` slots of the source number s with ``blocks[s]`` blocks."""
    shards = max(1, -(-sum(totals) // shard_slots))

    def run(batches):
        whole = np.array(totals, np.int64)
        for batch in each(batches):
            for shard in batch.column("id").to_pylist():
                before, counts = shard_counts(whole, shard, shards, shard_slots, seed)
                source = np.repeat(np.arange(len(counts)), counts)
                draw = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts - before, counts)
                block = np.zeros(len(source), np.int64)
                for s in np.flatnonzero(counts):
                    own = source == s
                    turn, index = np.divmod(draw[own], blocks[s])
                    found = np.zeros(len(index), np.int64)
                    for t in np.unique(turn):
                        found[turn == t] = permuted(index[turn == t], blocks[s], seed * 1_000_003 + int(s) * 1009 + int(t))
                    block[own] = found
                order = np.random.default_rng([seed, shard, 1]).permutation(len(source))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (np.full(len(source), shard), np.arange(len(source)), source[order], draw[order], block[order])],
                    names=["shard", "slot", "source_no", "draw", "block"])

    return spark.range(shards).mapInArrow(run, "shard bigint, slot bigint, source_no bigint, draw bigint, block bigint")


def streamed(rows: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """``rows`` (narrow, with _source, _key, size) with _bucket, _at (which name a row within its source) and _start, its first word's place in the source."""
    rows = rows.withColumn("_bucket", key_range(F.col("_key"), buckets))
    sums = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_source", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_source", "_bucket").orderBy("_key", *order)
    placed = rows.withColumns({
        "_at": F.row_number().over(within),
        "_start": F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    return placed.join(offsets, ["_source", "_bucket"]).withColumn("_start", F.col("_start") + F.col("_before")).drop("_before")


class Mix:
    """What is drawn from each source, planned from the sources' sizes."""

    def __init__(self, rows: DataFrame, block_words: int = 64, seed: int = 42, **options):
        self.block_words, self.seed, self.spark = block_words, seed, rows.sparkSession
        found = rows.groupBy("_source").agg(F.sum("size").alias("n")).collect()  # one row per source
        self.size = {r["_source"]: int(r["n"]) for r in found}
        plain = targets([(None if s == "-" else s[1:], n) for s, n in self.size.items()], **options)
        self.target = {s: plain[None if s == "-" else s[1:]] for s in self.size}
        self.sources = sorted(self.size)
        self.blocks = [-(-self.size[s] // block_words) for s in self.sources]
        self.totals = [round(self.target[s] * n / self.size[s]) if n else 0 for s, n in zip(self.sources, self.blocks)]

    def table(self) -> DataFrame:
        """Rows (_source, source_no, source_size, target)."""
        columns = [self.sources, range(len(self.sources)), [self.size[s] for s in self.sources], [self.target[s] for s in self.sources]]
        kinds = [("_source", pa.string()), ("source_no", pa.int64()), ("source_size", pa.int64()), ("target", pa.float64())]
        # as an Arrow table: rows of Python would start further Python workers beside those of the mix
        return self.spark.createDataFrame(pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)], schema=pa.schema(kinds)))

    def slots(self) -> DataFrame:
        """Rows (shard, slot, source_no, draw, block): the mix itself."""
        return mix_slots(self.spark, self.totals, self.blocks, seed=self.seed)

    def pieces(self, streams: DataFrame, row: list[str]) -> DataFrame:
        """Rows (*row, first, words, times): the parts of documents (named by the columns ``row``) that the mix takes, joined by block index."""
        width = self.block_words
        numbers = self.table().select("_source", "source_no")
        parts = streams.where("size > 0").join(F.broadcast(numbers), "_source").select(
            *row, "_start", "size", "source_no",
            F.explode(F.expr(f"sequence(_start div {width}, (_start + size - 1) div {width})")).alias("block"))
        first = F.greatest(F.col("block") * width, F.col("_start"))
        last = F.least((F.col("block") + 1) * width, F.col("_start") + F.col("size"))
        parts = parts.select(*row, "source_no", "block",
                             (first - F.col("_start")).alias("first"), (last - first).alias("words"))
        times = self.slots().groupBy("source_no", "block").agg(F.count("*").alias("times"))
        # a slot stands for few bytes in the planner's estimate, but there are as many as blocks: never broadcast
        return parts.join(times.hint("merge"), ["source_no", "block"]).select(*row, "first", "words", "times")


def mix_rows(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """The columns that place a document in its source's stream."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        source_key().alias("_source"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), text).alias("_key"), *more)


def mixed(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken): what the mix takes of each row of ``docs``."""
    rows = staged(mix_rows(docs, seed), "mix-rows")
    mix = Mix(rows, seed=seed, **options)
    streams = staged(streamed(rows, ["doc_id", "size"], bucket_count(rows.count())), "mix-streams")
    row = ["_source", "_bucket", "_at"]
    taken = mix.pieces(streams, row).groupBy(*row).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = streams.join(taken, row, "left").join(F.broadcast(mix.table()), "_source")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """The mix as documents, in the columns of ``docs``.

    Words taken once or more make a document's first row, words taken twice or
    more its second, and so on; the text holds the words taken, in order,
    parts that do not touch separated by a line break.  A document taken whole
    keeps its text unchanged.  n_chars follows the text.  Documents without
    words take no part.

    Narrow rows are placed in their streams and meet the blocks; the documents
    themselves move once, to meet their pieces, and are not sorted for it.
    """
    columns = docs.columns
    docs, place = placed(docs)
    row = ["_file", "_line"]
    place = [F.col(p).alias(r) for p, r in zip(place, row)]
    rows = staged(mix_rows(docs, seed, *place), "mix-rows")
    mix = Mix(rows, seed=seed, **options)
    streams = streamed(rows, ["doc_id", "size", *row], bucket_count(rows.count()))
    pieces = mix.pieces(streams, row).groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("first", "words", "times"))).alias("pieces"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), *place)
    taken = whole.join(pieces.hint("shuffle_hash"), row).select("_row", "pieces")
    taken = taken.withColumn("copy", F.explode(F.expr("sequence(1, array_max(transform(pieces, p -> p.times)))")))
    taken = taken.select("_row", F.expr("transform(filter(pieces, p -> p.times >= copy), p -> struct(p.first, p.words))").alias("pieces"))
    text = cut_words(taken)
    size = F.col("text").isNotNull()
    replace = {"text": F.col("text"), "n_chars": F.when(size, F.char_length("text")).cast("bigint")}
    return text.select(*[replace.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def cut_words(taken: DataFrame) -> DataFrame:
    """Rows (_row, text): the words of ``_row.text`` named by ``pieces`` (first word and number, ascending)."""
    schema = taken.select("_row", F.lit("").alias("text")).schema

    def run(batches):
        lut = word_table(SPACES)
        for batch in each(batches):
            column = pc.struct_field(batch.column("_row"), "text")
            data, offsets = text_bytes(column)
            pieces = batch.column("pieces")
            bounds = pieces.offsets.to_numpy()
            flat = pieces.values
            first, count = (pc.struct_field(flat, n).to_numpy(zero_copy_only=False) for n in ("first", "words"))
            for a, b in slices(offsets, 1 << 20):
                own = offsets[a : b + 1] - offsets[a]
                start, end, row, _ = words(data[offsets[a] : offsets[b]], own, lut)
                begins = np.searchsorted(row, np.arange(b - a + 1))
                out = []
                for i in range(b - a):
                    f, n = first[bounds[a + i] : bounds[a + i + 1]], count[bounds[a + i] : bounds[a + i + 1]]
                    total = begins[i + 1] - begins[i]
                    text = data[offsets[a + i] : offsets[a + i + 1]].tobytes()
                    if n.sum() < total:
                        cuts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1] + n[:-1])))
                        stops = np.concatenate((cuts[1:], [len(f)])) - 1
                        base = begins[i]
                        text = b"\n".join(
                            text[start[base + f[x]] - own[i] : end[base + f[y] + n[y] - 1] - own[i]] for x, y in zip(cuts, stops))
                    out.append(text.decode())
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(a, b - a), pa.array(out, pa.string())], names=["_row", "text"])

    return taken.mapInArrow(run, schema)
