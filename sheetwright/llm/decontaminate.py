"""Benchmark decontamination with suffix arrays over the training texts.

The documents are read in shards of bounded size inside their scan tasks.  A
shard's words become numbers, a suffix array of the shard is sorted, and every
suffix of every benchmark item is looked up in it by binary search, word by
word, which gives the places of its window; from there the match is followed
along both texts to its longest.  Only suffixes that can begin a whole window
(its words all occur in the benchmark) are sorted; no other suffix can hold a
match.  Of the suffixes of one match only the first is listed, so a text of
ever the same words against such an item has as many matches as places where
one can begin, not one for each pair of places.

A window is 13 consecutive words of an item; an item of fewer words (but not
none) is one window.  A document word inside any occurrence of a window is
hit.

Scale: no shuffle at all; documents never leave their scan task.  The
benchmark goes to the tasks in blocks of at most ``block_bytes`` of text, each
block one pass, and the spans of the passes add up in a column, so its size is
bounded too.

Defined results: a null text (document or item) has no words; a null item_id
is written as the empty string; repeated items count once in ``items`` when
their ids are equal; an empty benchmark hits nothing; an empty table gives no
rows; long and repetitive texts have a match for each place one can begin;
further columns of documents stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.common import each
from sheetwright.llm.textbytes import NOT_WORDS, slices, text_bytes, word_table, words

SHARD_BYTES = 2 << 20
MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"
_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()),
                             ("n_words", pa.int32())]))


class Queries:
    """The suffixes of a block of benchmark items, as word numbers."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        _, _, row, hashes = words(data, offsets, word_table(NOT_WORDS))
        self.vocabulary = np.unique(hashes)
        self.tokens = np.searchsorted(self.vocabulary, hashes)
        counts = np.bincount(row, minlength=len(ids))
        begins = np.concatenate(([0], np.cumsum(counts)))
        self.item = row
        self.begin = begins[row]
        self.end = begins[row + 1]
        #: Words that a suffix must match to hold a window; 0 where it is too short for one.
        room = self.end - np.arange(len(row))
        self.window = np.where(room >= window, window, np.where((counts[row] < window) & (room == counts[row]), room, 0))
        self.ids = ids
        self.shortest = int(self.window[self.window > 0].min()) if (self.window > 0).any() else 0
        self.longest = int(counts.max()) if len(counts) else 0


def suffix_array(tokens: np.ndarray, stops: np.ndarray, positions: np.ndarray, depth: int, step: int = 12) -> np.ndarray:
    """``positions`` sorted by the word sequences that begin there, compared up to ``depth`` words.

    ``stops[p]`` is where the text of position p ends; what lies beyond sorts
    first.  Runs that tie after ``step`` words are sorted by their next words,
    run by run, until all differ or ``depth`` is reached.
    """
    order = positions.copy()
    rank = np.zeros(len(order), np.int64)
    todo = np.arange(len(order))
    done = 0
    while len(todo) > 1 and done < depth:
        own = order[todo]
        keys = [token_at(tokens, stops, own, done + j) for j in range(min(step, depth - done))]
        by = np.lexsort([*keys[::-1], rank[todo]])
        order[todo] = own[by]
        rows = np.stack([rank[todo][by], *(key[by] for key in keys)])
        new = np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(0)))
        group = np.cumsum(new) - 1
        rank[todo] = todo[np.flatnonzero(new)][group]
        tied = np.bincount(group)[group] > 1
        todo = todo[tied]
        done += step
    return order


def token_at(tokens: np.ndarray, stops: np.ndarray, positions: np.ndarray, shift: int) -> np.ndarray:
    """Word numbers ``shift`` words after ``positions``; -1 past the text's end."""
    at = positions + shift
    inside = at < stops[positions]
    return np.where(inside, tokens[np.minimum(at, len(tokens) - 1)], -1)


def search(queries: Queries, tokens: np.ndarray, stops: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval of ``array`` whose suffixes begin with a query suffix's window, for every query suffix (empty where none does)."""
    n = len(queries.tokens)
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.flatnonzero(queries.window)
    high[active] = len(array)
    depth = 0
    while len(active):
        wanted = queries.tokens[active + depth]
        for side in ("left", "right"):
            a, b = low[active].copy(), high[active].copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                value = token_at(tokens, stops, array[np.minimum(mid, len(array) - 1)], depth)
                below = open_ & ((value < wanted) if side == "left" else (value <= wanted))
                a = np.where(below, mid + 1, a)
                b = np.where(open_ & ~below, mid, b)
            if side == "left":
                new_low = a
            else:
                high[active] = a
        low[active] = new_low
        depth += 1
        active = active[(low[active] < high[active]) & (queries.window[active] > depth)]
    return low, high


def match_starts(queries: Queries, tokens: np.ndarray, begins: np.ndarray, array: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(query suffix, position) where a longest match begins: their windows agree and the words before them do not.

    Where the words before agree as well, the match has begun earlier, so such
    pairs are never listed: the positions of an interval stand by the word
    before them, and the run that agrees is left out.  Intervals of different
    windows of one size are disjoint, so their positions are few however often
    a window repeats in either text.
    """
    suffixes = np.flatnonzero(high > low)
    bounds, own = np.unique(np.stack([low[suffixes], high[suffixes]]), axis=1, return_inverse=True)
    own = own.ravel()
    length = bounds[1] - bounds[0]
    offsets = np.concatenate(([0], np.cumsum(length)))
    interval = np.repeat(np.arange(len(length)), length)
    position = array[np.arange(offsets[-1]) - np.repeat(offsets[:-1] - bounds[0], length)]
    size = len(queries.vocabulary) + 3
    # 0: the first word of a text, 1: a word that no item has
    before = np.where(np.isin(position, begins), 0, tokens[np.maximum(position - 1, 0)] + 2)
    key = interval * size + before
    order = np.argsort(key, kind="stable")
    key, position = key[order], position[order]
    first = queries.begin[suffixes] == suffixes
    same = own * size + np.where(first, size - 1, queries.tokens[np.maximum(suffixes - 1, 0)] + 2)
    skip, resume = np.searchsorted(key, same, "left"), np.searchsorted(key, same, "right")
    begin, end = offsets[own], offsets[own + 1]
    runs = np.stack([np.concatenate((begin, resume)), np.concatenate((skip, end))])
    of = np.tile(suffixes, 2)
    count = runs[1] - runs[0]
    where = np.arange(count.sum()) + np.repeat(runs[0] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return np.repeat(of, count), position[where]


def shard_matches(queries: Queries, row: np.ndarray, hashes: np.ndarray, n_rows: int):
    """Longest matches that hold a window, in one shard: (row, item, document word, item word, words), by row, item and diagonal."""
    empty = np.empty(0, np.int64)
    if not queries.shortest or not len(hashes):
        return (empty,) * 5
    at = np.minimum(np.searchsorted(queries.vocabulary, hashes), len(queries.vocabulary) - 1)
    tokens = np.where(queries.vocabulary[at] == hashes, at, -1)
    counts = np.bincount(row, minlength=n_rows)
    begins = np.concatenate(([0], np.cumsum(counts)))
    stops = begins[row + 1]
    unknown = np.concatenate(([0], np.cumsum(tokens < 0)))
    reach = np.arange(len(tokens)) + queries.shortest
    fits = reach <= stops
    fits[fits] = unknown[reach[fits]] == unknown[:-1][fits]
    positions = np.flatnonzero(fits)
    if not len(positions):
        return (empty,) * 5
    array = suffix_array(tokens, stops, positions, int(queries.window.max()))
    low, high = search(queries, tokens, stops, array)
    suffix, position = match_starts(queries, tokens, begins, array, low, high)
    size = queries.window[suffix]
    open_ = np.arange(len(suffix))
    while len(open_):  # word by word along both texts
        i, d = suffix[open_] + size[open_], position[open_] + size[open_]
        inside = (i < queries.end[suffix[open_]]) & (d < stops[position[open_]])
        open_, i, d = open_[inside], i[inside], d[inside]
        open_ = open_[queries.tokens[i] == tokens[d]]
        size[open_] += 1
    item, doc = queries.item[suffix], row[position]
    start, item_start = position - begins[doc], suffix - queries.begin[suffix]
    order = np.lexsort((start, start - item_start, item, doc))
    return doc[order], item[order], start[order], item_start[order], size[order]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int, item="item_id", text="text") -> Iterator[tuple[list, list]]:
    """The items in blocks of at most ``block_bytes`` of text (a longer item stands alone)."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    for row in rows.toLocalIterator():
        add = len((row["t"] or "").encode())
        if ids and size + add > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += add
    if ids:
        yield ids, texts


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = 8 << 20) -> DataFrame:
    """Rows (row, n_words, matches): each row of ``docs`` as a struct, its number of words and its matches.

    The matches are the longest verbatim ones that hold a window; each gives
    the item, its first word in the item and in the document (from 0) and its
    length in words.
    """
    docs = docs.select(F.struct("*").alias("row"), F.lit(0).cast("bigint").alias("n_words"), F.array().cast(MATCH).alias("matches"))
    schema = docs.schema
    blocks = benchmark_blocks(benchmark, block_bytes)
    for ids, texts in chain([next(blocks, ([], []))], blocks):  # an empty benchmark is one empty block
        block = docs.sparkSession.sparkContext.broadcast((ids, texts))

        def run(batches, block=block):
            queries = Queries(*block.value, window)
            lut = word_table(NOT_WORDS)
            for batch in each(batches):
                data, offsets = text_bytes(pc.struct_field(batch.column("row"), "text"))
                for a, b in slices(offsets, SHARD_BYTES):
                    own = offsets[a : b + 1] - offsets[a]
                    _, _, row, hashes = words(data[offsets[a] : offsets[b]], own, lut)
                    counts = np.bincount(row, minlength=b - a)
                    row, item, start, item_start, size = shard_matches(queries, row, hashes, b - a)
                    ids = pa.array(queries.ids, pa.string()).take(pa.array(item))
                    new = pa.StructArray.from_arrays(
                        [ids, *(pa.array(x.astype(np.int32)) for x in (item_start, start, size))], fields=list(_MATCH.value_type))
                    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=b - a)))).astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array(ends), new)
                    part = batch.slice(a, b - a)
                    earlier = part.column("matches")
                    if len(earlier.flatten()):
                        found = pa.array([[*x, *y] for x, y in zip(earlier.to_pylist(), found.to_pylist())], _MATCH)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), pa.array(counts.astype(np.int64)), found.cast(_MATCH)], names=batch.schema.names)

        docs = docs.mapInArrow(run, schema)
    return docs


def hit_words(matches="matches"):
    """Number of distinct document words covered by the matches."""
    ordered = F.sort_array(F.transform(matches, lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["n_words"]).alias("b"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(ordered, zero, lambda acc, m: F.struct(
        F.greatest(acc["end"], m["b"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(acc["end"], m["a"]))).alias("n")))["n"].cast("bigint")


def hit_items(matches="matches"):
    """The ids of the items with a match, each once, sorted as strings."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item_id"])))


def is_contaminated(n_hit, n_words):
    """A document goes when at least a twentieth of its words are hit."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows; columns unchanged."""
    found = benchmark_matches(docs, benchmark, **options)
    return found.where(~is_contaminated(hit_words(), F.col("n_words"))).select("row.*")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated): one per row of ``docs``."""
    found = benchmark_matches(docs.select("doc_id", "text"), benchmark, **options)
    found = found.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "n_words", hit_words().alias("n_hit"), hit_items().alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


#: The report in DuckDB SQL over ``documents`` and ``benchmark``.
SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM starts),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (SELECT r, i, p.n, item FROM places p JOIN windows v ON v.n = p.n AND v.s = array_to_string(w[i : i + p.n - 1], ' ')),
hits AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
