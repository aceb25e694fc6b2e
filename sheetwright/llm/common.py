"""Helpers shared by the operators: staged tables, row-wise Arrow mapping, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetwright.session import scratch_path

#: Rows of a staged table up to which it is broadcast (some tens of MB).
MAX_BROADCAST_ROWS = 200_000
#: Rows that a bucket of a uniform key holds on average.
BUCKET_ROWS = 100_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (a lineage cut that survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with two more columns, and their names: they name each row however often the table is read again.

    A table read from files has the file's hash and the row's place in it;
    any other is written below the shared checkpoint folder first, so that
    later reads agree.
    """
    names = [fresh("_file", df), fresh("_line", df)]
    place = [F.xxhash64("_metadata.file_path").alias(names[0]), F.col("_metadata.row_index").alias(names[1])]
    try:
        if "_metadata" in {c.lower() for c in df.columns}:
            raise AnalysisException("a column of its own hides the place")
        return df.select("*", *place), names
    except AnalysisException:
        own = [f"_c{i}" for i in range(len(df.columns))]
        kept = staged(df.toDF(*own), "placed").select(*own, *place)
        return kept.toDF(*df.columns, *names), names


def attached(df: DataFrame, small: DataFrame, key: str, salts: int = 64) -> DataFrame:
    """``df`` joined to ``small``, one row for each value of ``key``, which may be very uneven in ``df``.

    ``small`` is staged and counted: up to ``MAX_BROADCAST_ROWS`` rows it is
    broadcast; beyond, it is repeated under ``salts`` salts and joined by
    shuffle, so the rows of one value go to that many tasks.
    """
    small = staged(small, "attached")
    if small.count() <= MAX_BROADCAST_ROWS:
        return df.join(F.broadcast(small), key)
    salt = fresh("_salt", df)
    many = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int"))
    return dealt.join(many.hint("merge"), [key, salt]).drop(salt)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Gives back what the C library keeps of freed memory; None where it is another library.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows; memory that Arrow and NumPy have freed goes back to the system after each.

    An idle worker lives on beside the next stages' executors, so what it keeps counts against them.
    """
    for batch in batches:
        if batch.num_rows:
            yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if _TRIM:
            _TRIM(0)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once: the lambda variable keeps Catalyst from inlining it at every use."""
    return F.transform(F.array(value), body)[0]


def lowest(order: Column, rows: Column, wanted: int) -> Column:
    """Whether a uniform bigint ``order`` is surely among the ``wanted`` lowest of ``rows`` or near them.

    Keeps about four times as many rows as wanted, so the exact choice among
    them is a small job; fewer than ``wanted`` would remain with probability
    below 1e-100 for ``wanted`` of 100 or more.
    """
    share = F.least(F.lit(1.0), F.lit(4.0 * wanted) / F.greatest(rows, F.lit(1)))
    return (order / F.lit(2.0**64) + F.lit(0.5)) <= share


def bucket_count(rows: int) -> int:
    """Buckets of a uniform key that hold about ``BUCKET_ROWS`` rows each, and 256 at least."""
    return max(256, -(-rows // BUCKET_ROWS))


def key_range(key: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a uniformly spread bigint key, in the key's order."""
    return F.least(F.lit(buckets - 1), F.floor((key / F.lit(2.0**64) + F.lit(0.5)) * F.lit(buckets))).cast("int")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph as rows (node, root), root being the smallest node of the component.

    ``edges`` has columns a and b.  Large-star and small-star steps alternate
    until the edge set stands still; each is one aggregation (combined before
    the shuffle) and one equi-join, so a node with very many edges is split by
    the skew handling of joins instead of being gathered.  Nodes without edges
    do not appear.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = staged(pairs.distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct()
        current = staged(small, "cc")
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
