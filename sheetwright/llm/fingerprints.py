"""Document fingerprints by winnowing, in DataFrame functions only.

A text is read as units, runs of at most eight characters without white space
(a plain word is one unit; text written without spaces still has bounded
units).  Every ``K`` consecutive units have a hash.  From each window of ``W``
consecutive hashes the smallest is selected, the rightmost of equal ones, and
kept with its position.  So two texts that share ``K + W - 1`` units in a row
share a selected hash, and no match shorter than ``K`` units is reported.

The cuts inside a run longer than a unit depend on where the run begins, so
such runs are read a second time by rolling grams: every ``RUN`` consecutive
characters of a run of that length or more (``K`` full units) have a hash, at
every offset, and from each window of ``RUN_W`` of them the smallest is
selected in the same way.  Two texts that share ``RUN + RUN_W - 1`` characters
without white space (as many as ``K + W - 1`` full units) share a selected
hash, wherever they stand.  In a shorter run the next white space, where the
units fall into step again, is less than ``RUN`` characters away.  The hashes
of both readings, with their positions, are the fingerprint.

The order of hashes is that of their upper 32 bits, which leaves the lower
half of a 64-bit word for the position (descending): one minimum gives both.

A text of fewer than ``K`` units has one hash, of all its units; one of fewer
than ``W`` hashes is one window; one without units has no fingerprint.

Scale: arrays stay inside a row, linear in the text.  Neighbours by doc_id are
found in one shuffle: ids are cut into buckets at every ``CUT_IDS``-th of the
ids with a low hash, and the first row of each bucket is copied to the end of
the bucket before it.  A task streams through its buckets; about ``CUT_IDS``
ids for each of at most ``MAX_BUCKETS`` buckets reach the driver.

The fingerprint returned is the list of selected hashes with their positions,
each hash by the upper 32 bits that order it; the likeness of two fingerprints
is that of their sets of hashes as written, so it can be had from them alone.
It is written after the shuffle, which carries 4 bytes for each hash of the
next document instead.

Defined results: a null text is empty; equal doc_ids follow each other by a
hash of the text; a row with a null doc_id has no next document (nothing
replaces its last quarter, near_next is 0); two empty fingerprints are alike
(1), an empty and another one are not (0); an empty table gives no rows; texts
of any length are read whole; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetwright.llm.common import let

K, W = 4, 4
UNIT = r"\S{1,8}"
STEP = 5
RUN, RUN_W = 8 * K, STEP * STEP
TOP_HALF = -(1 << 32)
LAST = (1 << 31) - 1
BUCKET_ROWS, MAX_BUCKETS, FAN = 500, 65_536, 256
CUT_IDS = 8


def gram_hashes(text: Column, k: int = K) -> Column:
    """Hashes (bigint) of all runs of ``k`` units of ``text``."""
    units = F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))

    def grams(h: Column) -> Column:
        n = F.size(h) - (k - 1)
        runs = F.transform(F.slice(h, F.lit(1), F.greatest(n, F.lit(0))),
                           lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k))))
        return F.when(n > 0, runs).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(units, lambda u: F.xxhash64(u)), grams)


def rolling_hashes(text: Column) -> Column:
    """Hashes (bigint) of all runs of ``RUN`` characters of ``text`` without white space, at every offset."""
    runs = F.regexp_extract_all(text, F.lit(rf"\S{{{RUN},}}"), F.lit(0))

    def grams(run: Column) -> Column:
        # four bytes a character, so that a gram is cut out in constant time
        return let(F.encode(run, "UTF-32"), lambda b: F.transform(
            F.sequence(F.lit(0), (F.octet_length(b) / 4).cast("int") - RUN), lambda i: F.xxhash64(F.substring(b, i * 4 + 1, F.lit(4 * RUN)))))

    return F.flatten(F.transform(runs, grams))


def minima(hashes: Column, width: int) -> Column:
    """The least of each ``width`` neighbours of an array (an empty array if it is shorter)."""
    n = F.size(hashes) - (width - 1)
    return F.transform(F.slice(hashes, F.lit(1), F.greatest(n, F.lit(0))),
                       lambda x, i: F.least(x, *(F.get(hashes, i + j) for j in range(1, width))))


def run_minima(hashes: Column) -> Column:
    """The least of each ``RUN_W`` neighbours: the least of ``STEP`` least ones that are ``STEP`` apart."""

    def outer(m: Column) -> Column:
        return F.transform(F.slice(m, F.lit(1), F.greatest(F.size(m) - (RUN_W - STEP), F.lit(0))),
                           lambda x, i: F.least(x, *(F.get(m, i + STEP * j) for j in range(1, STEP))))

    return let(minima(hashes, STEP), outer)


def selected(hashes: Column, width: int, windows) -> Column:
    """The least hash of each window of ``width`` (by ``windows``) with its position, the rightmost of equal ones."""
    ordered = F.transform(hashes, lambda x, i: x.bitwiseAND(F.lit(TOP_HALF)).bitwiseOR((F.lit(LAST) - i).cast("bigint")))

    def least(p: Column) -> Column:
        return F.when(F.size(p) >= width, windows(p)).when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(p)

    def placed(q: Column) -> Column:
        at = (F.lit(LAST) - q.bitwiseAND(F.lit((1 << 32) - 1))).cast("int")
        return F.struct(F.get(hashes, at).alias("hash"), at.alias("pos"))

    return F.transform(F.array_distinct(let(ordered, least)), placed)


def winnowed(text: Column, k: int = K, w: int = W) -> Column:
    """Selected hashes of the units of ``text`` with their positions: array<struct<hash bigint, pos int>>, by position."""
    return let(gram_hashes(F.coalesce(text, F.lit("")), k), lambda g: selected(g, w, lambda p: minima(p, w)))


def rolling(text: Column) -> Column:
    """Selected hashes of the rolling grams of ``text`` with their positions, like ``winnowed``."""
    return let(rolling_hashes(F.coalesce(text, F.lit(""))), lambda g: selected(g, RUN_W, run_minima))


def readings(text: Column) -> Column:
    """Selected hashes of ``text`` by units and by rolling grams: struct<units, runs>."""
    return F.struct(winnowed(text).alias("units"), rolling(text).alias("runs"))


def both(prints: Column) -> Column:
    """The selected hashes of both readings, by units, then by rolling grams."""
    return F.concat(prints["units"], prints["runs"])


def fingerprint(text: Column) -> Column:
    """Selected hashes of ``text`` with their positions, by units, then by rolling grams."""
    return both(readings(text))


def sketch(prints: Column) -> Column:
    """The distinct hashes of a fingerprint as it is written (their upper 32 bits, by which they are ordered), for ``likeness``."""
    return F.array_distinct(F.transform(prints, lambda p: F.shiftright(p["hash"], 32).cast("int")))


def written(prints: Column) -> Column:
    """A fingerprint as text: ``hash:position`` of every selected hash (8 hex digits), comma-joined; those of the rolling grams come last, after ``;``."""

    def pairs(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda x: F.concat(F.lower(F.hex(F.shiftrightunsigned(x["hash"], 32))), F.lit(":"), x["pos"].cast("string"))), ",")

    return F.concat(pairs(prints["units"]), F.when(F.size(prints["runs"]) > 0, F.concat(F.lit(";"), pairs(prints["runs"]))).otherwise(F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Share of hashes that two sketches have in common (0 to 1)."""
    whole = F.size(a) + F.size(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when(whole == 0, F.lit(1.0)).otherwise(shared / (whole - shared).cast("double"))


def id_buckets(docs: DataFrame) -> tuple[Column, Column, Column, int]:
    """(bucket of doc_id, whether it opens its bucket, the bucket before, number of buckets)."""
    found = docs.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("least")).first()
    buckets = min(MAX_BUCKETS, max(1, -(-found["n"] // BUCKET_ROWS)))
    bounds = [found["least"] or 0]
    if buckets > 1:
        # ids whose hash is low: about CUT_IDS for each bucket, drawn where the rows are
        share = min(1.0, CUT_IDS * buckets / found["n"])
        low = F.xxhash64(F.lit("cut"), "doc_id") / F.lit(2.0**64) + F.lit(0.5) <= share
        ids = sorted(docs.where("doc_id IS NOT NULL").where(low).select("doc_id").distinct().toArrow().column(0).to_pylist())
        bounds = sorted({*bounds, *ids[CUT_IDS::CUT_IDS]})

    def literal(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    doc_id, n = F.col("doc_id"), len(bounds)
    coarse = F.size(F.filter(literal(bounds[::FAN]), lambda b: b <= doc_id)) - 1
    fine = let(coarse, lambda c: c * FAN + F.size(F.filter(F.slice(literal(bounds), c * FAN + 1, F.lit(FAN)), lambda b: b <= doc_id)) - 1)
    bucket = F.when(doc_id.isNotNull(), fine).otherwise(-1 - F.pmod(F.xxhash64("text"), F.lit(n)).cast("int"))
    return bucket, literal(bounds)[F.greatest(F.col("_bucket"), F.lit(0))] == doc_id, F.pmod(F.col("_bucket") + F.lit(n - 1), F.lit(n)).cast("int"), n


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``docs`` with ``next_<column>``: the values of the next document by doc_id (after the last: the first)."""
    bucket, opens, before, _ = id_buckets(docs)
    placed = docs.withColumn("_bucket", bucket)
    places = F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("copy")))
    copied = F.array_append(places, F.struct(before.alias("b"), F.lit(True).alias("copy")))
    placed = placed.withColumn("_place", F.explode(F.when(F.col("doc_id").isNotNull() & opens, copied).otherwise(places)))
    order = Window.partitionBy("_place.b").orderBy("_place.copy", "doc_id", "_order")
    known = F.col("doc_id").isNotNull()
    nexts = {f"next_{c}": F.when(known, F.lead(c).over(order)) for c in columns}
    return placed.withColumns(nexts).where(~F.col("_place.copy")).drop("_bucket", "_place", "_order")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last quarter replaced by as many first
    characters of the next document (all of them, if it has fewer).
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_order"))
    own = own.select("doc_id", "text", "_order", sketch(fingerprint(F.col("text"))).alias("sketch"))
    pairs = with_next(own, ["text", "sketch"])
    n = F.char_length("text")
    part = F.floor(n / 4).cast("int")
    pairs = pairs.select(
        "doc_id", "text", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("text", F.lit(1), n - part), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), part)).alias("edited"))
    pairs = pairs.withColumns({"own": readings(F.col("text")), "prints": readings(F.col("edited"))})
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("own")).alias("fingerprint"),
        written(F.col("prints")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), sketch(both(F.col("prints")))).alias("near_edited"),
        F.when(F.col("next_sketch").isNull(), F.lit(0.0)).otherwise(likeness(F.col("sketch"), F.col("next_sketch"))).alias("near_next"))
