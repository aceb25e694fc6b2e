"""Near-duplicate documents by min-max hashing.

Each distinct text is cut into word shingles.  One evaluation of a hash
function gives two signature values, the smallest and the largest shingle
under it, so ``permutations`` evaluations give twice as many values.  Runs of
``rows`` values form the bands.  Texts that share a band are candidates; the
links are then confirmed on the full shingle sets, and the components of the
confirmed links are the groups.

With the defaults a pair at the threshold 0.85 misses all 64 bands of 8
values with probability 1.4e-9.

Scale: exact copies are folded inside each task before anything is shuffled,
and everything after the first pass works on distinct texts.  Band groups
with the same members (copies meet in many bands) are kept once, and
overlapping ones are merged, so a text rarely moves twice.  A group's
texts are compared in one task up to ``max_group`` texts.  Larger groups are
found by counting each band's texts and dealt out by Spark as pairs of blocks,
once for all bands that hold the same texts, so no task holds more than about
``2 * max_group`` texts and no pair is lost.  A group yields a spanning
forest of its confirmed links, at most one row per member, never all pairs.

Defined results: a null or blank text has no shingles, size 0, and stands
alone; equal texts with words are linked; rows with a null doc_id get the
smallest non-null doc_id of their group (null if there is none); an empty table
gives no rows; texts of any length have all their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.common import connected_components, each, fresh, staged
from sheetwright.llm.textbytes import (
    SPACES, U64, mix, random_words, shingles, slices, text_bytes, word_table, words)

PIECE = 1 << 20
COLUMNS = 4096
SALTS = 64


def text_key(text="text"):
    """Key of a text's content: its MD5 as 16 bytes (null for a null text)."""
    return F.unhex(F.md5(text))


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct ``k``-word shingles as sorted 64-bit fingerprints."""
    data, offsets = text_bytes(column)
    lut = word_table(SPACES)
    for a, b in slices(offsets, PIECE):
        own = offsets[a : b + 1] - offsets[a]
        _, _, row, hashes = words(data[offsets[a] : offsets[b]], own, lut)
        row, values = shingles(row, hashes, b - a, k)
        at = np.searchsorted(row, np.arange(b - a + 1))
        for i in range(b - a):
            yield np.unique(values[at[i] : at[i + 1]])


def bands_of(values: np.ndarray, permutations: int, rows: int) -> np.ndarray:
    """Band keys of a shingle set: from the minima under each permutation, then from the maxima."""
    low, high = (values >> U64(32)).astype(np.uint32), None
    scale = random_words(permutations, 21).astype(np.uint32)[:, None] | np.uint32(1)
    shift = (random_words(permutations, 22) >> U64(32)).astype(np.uint32)[:, None]
    smallest = np.full(permutations, 0xFFFFFFFF, np.uint32)
    largest = np.zeros(permutations, np.uint32)
    for at in range(0, len(low), COLUMNS):
        high = scale * low[at : at + COLUMNS] + shift
        np.minimum(smallest, high.min(1), out=smallest)
        np.maximum(largest, high.max(1), out=largest)
    signature = np.concatenate((smallest, largest)).astype(U64).reshape(-1, rows)
    keys = (signature * random_words(rows, 23)).sum(1, dtype=U64) + random_words(len(signature), 24)
    return mix(keys).view(np.int64)


def signatures(docs: DataFrame, k: int, permutations: int, rows: int) -> DataFrame:
    """Rows (doc_id, n_shingles, key, bands); bands are given with the first copy of a text in each task."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in each(batches):
            keys = batch.column("key").to_pylist()
            sizes, bands = [], []
            for key, values in zip(keys, shingle_sets(batch.column("text"), k)):
                sizes.append(len(values))
                fresh = len(values) > 0 and key not in seen
                if fresh:
                    seen.add(key)
                bands.append(bands_of(values, permutations, rows) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("key"),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "key", "bands"])

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"), "text")
    return rows_in.mapInArrow(run, "doc_id bigint, n_shingles bigint, key binary, bands array<bigint>")


def band_groups(signed: DataFrame, max_group: int) -> DataFrame:
    """Rows (unit, key): the texts that are compared together.

    Bands of at most ``max_group`` texts are grouped by ``short_units``, longer
    ones by ``long_units``; Spark counts them first, so no task ever holds a
    longer one.
    """
    given = signed.where("bands is not null").select("key", "bands").dropDuplicates(["key"])
    spread = staged(given, "minhash-bands").select("key", F.explode(F.array_distinct("bands")).alias("band"))
    sizes = spread.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    long = staged(sizes.where(F.col("n") > max_group), "minhash-long")
    if long.isEmpty():
        return merged_units(short_units(spread), max_group)
    # salted, so that the rows of a long band meet its size in many tasks
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt")
    salted = spread.select("band", "key", salt)
    sized = long.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    short = salted.join(sized.select("band", "salt"), ["band", "salt"], "left_anti").select("key", "band")
    wide = salted.join(sized, ["band", "salt"]).select("band", "key", "n", "least")
    return merged_units(short_units(short), max_group).unionByName(long_units(wide, max_group))


def short_units(spread: DataFrame) -> DataFrame:
    """Rows (unit, key) of bands that fit one task.

    The rows arrive sorted by band and key, so a group is a run of rows.  A
    group is named by its members, and the same members met in another band
    fall together.
    """

    def run(batches):
        tail = None  # rows of the band that may go on in the next batch
        for batch in each(batches):
            frame = np.rec.fromarrays(
                [batch.column("band").to_numpy(), np.array(batch.column("key").to_pylist(), dtype="S16")],
                names="band,key")
            frame = frame if tail is None else np.concatenate((tail, frame))
            if not len(frame):
                continue
            cut = np.searchsorted(frame["band"], frame["band"][-1])
            tail = frame[cut:]
            yield from units(frame[:cut])
        if tail is not None:
            yield from units(tail)

    def units(frame):
        if len(frame) < 2:
            return
        starts = np.flatnonzero(np.concatenate(([True], frame["band"][1:] != frame["band"][:-1])))
        ends = np.concatenate((starts[1:], [len(frame)]))
        names, keys = [], []
        half = random_words(16, 31)
        raw = np.frombuffer(frame["key"].tobytes(), np.uint8).reshape(-1, 16)
        finger = mix((raw.astype(U64) * half).sum(1, dtype=U64))
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            n = b - a
            name = int(mix(np.array([finger[a:b].sum(dtype=U64)], U64) + U64(n))[0])
            names.append(np.full(n, name, U64))
            keys.append(raw[a:b])
        if names:
            keys = np.ascontiguousarray(np.concatenate(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(names).view(np.int64)),
                 pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())],
                names=["unit", "key"])

    rows = spread.repartition("band").sortWithinPartitions("band", "key")
    return rows.mapInArrow(run, "unit bigint, key binary").distinct()


def long_units(wide: DataFrame, max_group: int) -> DataFrame:
    """Rows (unit, key) of the bands of more than ``max_group`` texts: pairs of blocks of texts.

    Bands that share a text within two steps are one cluster where that costs
    no more pairs than its bands apart, so a pair of blocks is one unit however
    many bands its texts share.  The texts are dealt to blocks by their hash,
    and Spark makes the pairs of blocks row by row.
    """
    wide = staged(wide, "minhash-wide")
    near = wide.groupBy("key").agg(F.min("least").alias("label"))
    cluster = wide.join(near, "key").groupBy("band").agg(F.min("label").alias("cluster"), F.first("n").alias("n"))
    cluster = staged(cluster, "minhash-long-clusters")
    # one side has a row for every text of a long band: salted like above
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    placed = wide.select("band", "key", salt.alias("salt")).join(
        cluster.select("band", "cluster", "n", salts.alias("salt")).hint("merge"), ["band", "salt"])
    placed = staged(placed.select("band", "cluster", "key", "n"), "minhash-long-placed")
    together = placed.select("cluster", "key").distinct().groupBy("cluster").agg(F.count("*").alias("whole"))
    apart = cluster.groupBy("cluster").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("cost"))
    both = together.join(apart, "cluster").withColumn("merge", F.col("whole").cast("double") * F.col("whole") <= F.col("cost"))
    both = both.withColumn("salt", salts).hint("merge")
    placed = placed.withColumn("salt", salt).join(both, ["cluster", "salt"])
    group = F.when(F.col("merge"), F.xxhash64(F.lit(1), "cluster")).otherwise(F.xxhash64(F.lit(2), "band"))
    size = F.when(F.col("merge"), F.col("whole")).otherwise(F.col("n"))
    members = placed.select(group.alias("group"), "key", F.ceil(size / F.lit(max_group)).cast("int").alias("blocks")).distinct()
    block = F.pmod(F.xxhash64(F.lit(3), "key"), F.col("blocks")).cast("int").alias("block")
    pairs = members.select("group", "key", "blocks", block)
    pairs = pairs.select("group", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.where("block <> other")  # two or more blocks: the pairs within one are in each of its units
    return pairs.select(F.xxhash64("group", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "key")


def merged_units(units: DataFrame, max_group: int) -> DataFrame:
    """Rows (unit, key): units that overlap brought together, so that a text moves to fewer places.

    A unit joins the cluster named by the smallest key met within two steps
    from its members; all its members go there, so every pair stays together.
    Units of a cluster of more than ``max_group`` texts stay as they are.
    """
    units = staged(units, "minhash-units")
    label = units.groupBy("unit").agg(F.min("key").alias("label"))
    near = units.join(label, "unit").groupBy("key").agg(F.min("label").alias("label"))
    cluster = units.join(near, "key").groupBy("unit").agg(F.min("label").alias("cluster"))
    placed = staged(units.join(cluster, "unit"), "minhash-clusters")
    sizes = placed.select("cluster", "key").distinct().groupBy("cluster").agg(F.count("*").alias("n"))
    name = F.when(F.col("n") <= max_group, F.xxhash64("cluster")).otherwise(F.col("unit"))
    return placed.join(sizes, "cluster").select(name.alias("unit"), "key").distinct()


def first_texts(docs: DataFrame) -> DataFrame:
    """Rows (key, text): every distinct text once; copies are folded in each task before the shuffle."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in each(batches):
            fresh = []
            for key in batch.column("key").to_pylist():
                fresh.append(key is not None and key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(fresh))

    keyed = docs.select(text_key().alias("key"), "text").where("text is not null")
    return keyed.mapInArrow(run, "key binary, text string")


def links_within(sets: list[np.ndarray], per_cent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: pairs whose intersection is ``per_cent`` of their union or more.

    Breadth first from each set not reached yet, counting intersections with
    all sets not reached yet through an inverted list, so reached sets are
    never compared again.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * shared >= per_cent * (sizes.sum() - shared) else []
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(ids, kind="stable")
    posting = owner[order]
    counts = np.bincount(ids, minlength=len(values))
    begin = np.concatenate(([0], np.cumsum(counts)))
    at = np.concatenate(([0], np.cumsum(sizes)))
    waiting = np.ones(n, bool)
    found = []
    for root in range(n):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            x = queue.pop()
            mine = ids[at[x] : at[x + 1]]
            length = counts[mine]
            where = np.repeat(begin[mine] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            shared = np.bincount(posting[where], minlength=n)
            near = np.flatnonzero(waiting & (100 * shared >= per_cent * (sizes + sizes[x] - shared)))
            waiting[near] = False
            queue.extend(near.tolist())
            found.extend((x, int(y)) for y in near)
    return found


def confirmed_links(units: DataFrame, texts: DataFrame, k: int, per_cent: int) -> DataFrame:
    """Rows (a, b): links between text keys, confirmed on the full shingle sets of the texts in each unit."""

    def run(batches):
        unit, keys, sets = None, [], []
        for batch in each(batches):
            units_in = batch.column("unit").to_pylist()
            keys_in = batch.column("key").to_pylist()
            a, b = [], []
            for name, key, values in zip(units_in, keys_in, shingle_sets(batch.column("text"), k)):
                if name != unit:
                    linked(keys, sets, a, b)
                    unit, keys, sets = name, [], []
                if not keys or keys[-1] != key:
                    keys.append(key)
                    sets.append(values)
            yield out(a, b)
        a, b = [], []
        linked(keys, sets, a, b)
        yield out(a, b)

    def linked(keys, sets, a, b):
        if len(keys) > 1:
            for i, j in links_within(sets, per_cent):
                a.append(keys[i])
                b.append(keys[j])

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    # the units grow with the corpus, so they are never broadcast, however small the planner takes them for
    together = texts.join(units.hint("merge"), "key").select("unit", "key", "text")
    together = together.repartition("unit").sortWithinPartitions("unit", "key")
    return together.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, k: int = 5, per_cent: int = 85, permutations: int = 256, rows: int = 8,
                    max_group: int = 4096) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept, key): the near-duplicate group of each row of ``docs``.

    ``docs`` needs columns doc_id and text; other columns are ignored.
    component_id is the smallest doc_id of the group; ``kept`` marks the row(s)
    that carry it; ``key`` is the text's content key.
    """
    signed = staged(signatures(docs, k, permutations, rows), "minhash-signatures")
    units = band_groups(signed, max_group)
    links = confirmed_links(units, first_texts(docs), k, per_cent)
    roots = connected_components(links)
    texts = signed.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    rooted = texts.join(roots.withColumnRenamed("node", "key"), "key", "left")
    rooted = staged(rooted.where("n > 1 or root is not null").select(
        "key", "first", F.coalesce("root", "key").alias("root")), "minhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = rooted.join(least, "root").select("key", "component_id")
    plain = signed.select("doc_id", "n_shingles", "key")
    joined = plain.join(groups, (plain["key"] == groups["key"]) & (plain["n_shingles"] > 0), "left")
    component = F.coalesce(groups["component_id"], plain["doc_id"])
    return joined.select(plain["doc_id"], plain["n_shingles"], component.alias("component_id"),
                         plain["doc_id"].eqNullSafe(component).alias("kept"), plain["key"])


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one of each near-duplicate group, all columns unchanged.

    Repeated rows (same doc_id and text) count as one document; rows whose
    doc_id is null stay when no other row of their group has an id.
    """
    marked = near_duplicates(docs, **options)
    one, two = fresh("_id", docs), fresh("_key", docs)
    kept = marked.where("kept").select(F.col("doc_id").alias(one), F.col("key").alias(two)).distinct()
    keyed = docs.withColumns({one: F.col("doc_id").cast("bigint"), two: text_key()})
    same = keyed[one].eqNullSafe(kept[one]) & keyed[two].eqNullSafe(kept[two])
    return keyed.join(kept, same, "left_semi").dropDuplicates([one, two]).drop(one, two)


#: The query's result in DuckDB SQL over ``documents`` (distinct doc_ids), by all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs p JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * p.n >= 85 * (a.n + b.n - p.n)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(y, d.doc_id) AS kept
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON x = d.doc_id
"""
