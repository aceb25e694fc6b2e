"""Shards that each match the mixture of sources: proportional stratified interleaving.

Rows are put in a seeded pseudorandom order within their source.  The r-th of
a source's n rows gets the fractional rank (r - 1 + u) / n, u being a fixed
offset of the source in [0, 1) (without it all small sources would meet at the
same fractions).  All rows sorted by fractional rank form one sequence in
which every source is spread evenly; it is cut into shards whose row counts
differ by one at most.

Scale: neither ranking gathers a source or the corpus in one task.  The
shuffle key is uniform, so a range of it is a bucket of bounded size; rows are
numbered inside buckets, and running totals over the (small) table of bucket
counts give each bucket its offset.  The second ranking does the same over
ranges of the fractional rank, which is uniform as well; the number of ranges
follows the row count.  Only narrow rows are ranked; where documents are asked
for, each moves once, to meet its shard and slot.

Defined results: a null text has size 1 and the CRC of the empty text; a null
source is a source of its own; a null doc_id is ordered like any other value;
rows that are equal in every respect are interchangeable; an empty table gives
no rows; the length of a text does not matter; further columns of documents
stay as they are, except that shard and slot replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetwright.llm.common import attached, bucket_count, key_range, placed, staged


def source_key() -> Column:
    """The source as a non-null key; a null source differs from every other."""
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))


def numbered(df: DataFrame, group: list[str], key: str, order: list[str], buckets: int, name: str) -> DataFrame:
    """``df`` with ``name``: positions from 0 in the order of ``key`` (a uniform bigint), within ``group``.

    ``buckets`` ranges of the key are numbered apart and shifted by the rows before them.
    """
    df = df.withColumn("_bucket", key_range(F.col(key), buckets))
    counts = df.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*group, "_bucket").orderBy(key, *order)
    ranked = df.withColumn("_at", F.row_number().over(within) - 1)
    return ranked.join(offsets, [*group, "_bucket"]).withColumn(name, F.col("_at") + F.col("_before")).drop(
        "_bucket", "_at", "_before")


def interleaved(rows: DataFrame, shards: int, order: list[str], seed: int = 42, buckets: int | None = None) -> DataFrame:
    """``rows`` (staged and narrow, with _source and a seeded bigint _key) with _shard and _slot."""
    n = rows.count()
    buckets = buckets or bucket_count(n)
    totals = rows.groupBy("_source").agg(F.count("*").alias("_total"))
    ranked = attached(numbered(rows, ["_source"], "_key", order, buckets, "_rank"), totals, "_source")
    start = F.xxhash64(F.lit(seed), F.lit("offset"), "_source") / F.lit(2.0**64) + F.lit(0.5)
    ranked = ranked.withColumn("_fraction", (F.col("_rank") + start) / F.col("_total"))
    ranked = ranked.withColumn("_place", ((F.least(F.col("_fraction"), F.lit(1 - 2.0**-52)) - 0.5) * F.lit(2.0**64)).cast("bigint"))
    sequence = numbered(ranked.withColumn("_all", F.lit(0)), ["_all"], "_place", ["_source", "_key", *order], buckets, "_position")
    sequence = sequence.withColumn("_shard", F.expr(f"cast(_position * {shards} div greatest({n}, 1) as int)"))
    return sequence.withColumn("_slot", F.expr(f"_position - (_shard * bigint({n}) + {shards - 1}) div {shards}"))


def shard_rows(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """The narrow columns by which a document is placed."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), source_key().alias("_source"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), text).alias("_key"), *more)


def sharded(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard): one per row of ``docs``.

    size is the UTF-8 bytes of the text plus 1; ``rows`` is the law that holds
    (row counts at most one apart); slot counts from 0 within the shard.
    """
    rows = staged(shard_rows(docs, seed), "shard-rows")
    found = interleaved(rows, shards, ["doc_id", "text_crc32", "size"], seed)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"),
                        F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded_documents(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """``docs`` (all columns) with shard and slot; columns of these names in ``docs`` are replaced.

    Narrow rows are ranked; the documents themselves move once, to meet their
    shard and slot, and are not sorted for it.
    """
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    docs, (file, line) = placed(docs)
    rows = staged(shard_rows(docs, seed, F.col(file).alias("_file"), F.col(line).alias("_line")), "shard-rows")
    found = interleaved(rows, shards, ["doc_id", "text_crc32", "size", "_file", "_line"], seed)
    found = found.select(F.col("_file").alias(file), F.col("_line").alias(line), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
    return docs.select(*own, file, line).join(found.hint("shuffle_hash"), [file, line]).select(*own, "shard", "slot")
