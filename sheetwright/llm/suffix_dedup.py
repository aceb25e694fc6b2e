"""Removal of long repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte covered by a ``SIZE``-byte string that also starts anywhere else in
the corpus is removed.  Two suffixes agree to that depth exactly when their
first ``SIZE`` bytes are equal, so the suffixes need to be ordered to that
depth only, and ranks of strings of a fixed depth can be 64-bit fingerprints.

* Cover sample: a perfect difference set D modulo ``v = q*q + q + 1`` (Singer)
  has, for any two positions i and j, a shift d < v with i+d and j+d both in
  the sample.  Equal ``SIZE``-byte strings at i and j so imply equal
  ``SIZE - v + 1``-byte strings at two sample positions.  Those strings are
  ranked first; the sample is about 1/q of all suffixes.
* Suffixes: a suffix can tie with another to depth ``SIZE`` only if a sample
  position within its first v bytes has a rank that occurs again.  Only such
  suffixes are sorted, and their ties are resolved by fingerprint at full depth.
* Buckets: ranks, then suffixes, are dealt to buckets by ranges of their
  fingerprints; a task sorts one bucket at a time.

Scale: distinct texts of at least ``SIZE`` bytes are packed, compressed, into
chunks of about ``chunk_bytes``, written once as a table bucketed by chunk, so
no later step shuffles text.  A chunk asks a bucket about its fingerprints,
each once and without positions (4 bytes for a sample rank, whose bucket adds
bits, and 8 for a suffix), and gets one bit back for each.  A string that very
many documents share is one fingerprint per chunk, copies of a whole text are
one text, and nothing is ever paired.

A false removal needs two suffixes with equal 64-bit fingerprints; a false
tie of sample ranks only adds a suffix to sort.

Passages: the same steps over words in place of bytes (strings of ``WORDS``
words, a cover of their positions) tell which documents hold a passage of more
than 50 words that another document has too, however few bytes it takes; these
are reported beside the bytes removed and change nothing in them.

Copies: a task sends a text once and its further copies as numbers, one a
batch.  A text with very many copies (counted first) is sent by the task that
has its first row only, so no chunk receives it from every task.

Defined results: a null text is empty; shorter texts than ``SIZE`` keep all
bytes; copies of a text of that size or more lose all theirs; repeated rows
count as copies; an empty table gives no rows; a text of any length is one text
of a chunk; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.common import each, placed, staged
from sheetwright.llm.minhash import text_key
from sheetwright.llm.textbytes import SPACES, U64, prefix_hash, random_words, spans_hash, text_bytes, words
from sheetwright.session import scratch_path

SIZE = 400
Q = 11
#: Passages of more than 50 words.
WORDS, WORDS_Q = 51, 5
#: A text with more copies than this, and than a millionth of all rows, is sent once in all.
MANY_COPIES = 1000
BYTE, WORD = "byte", "word"
_BYTES = random_words(256, 61)
_LETTERS = random_words(256, 67)
_LETTERS[list(SPACES)] = 0


def difference_set(q: int) -> tuple[int, np.ndarray]:
    """(v, D): for a prime q, the q + 1 exponents e with x**e in the plane spanned by 1 and x, in the field of q**3 elements."""
    v = q * q + q + 1
    for a, b, c in itertools.product(range(q), range(q), range(1, q)):
        power, found = (1, 0, 0), []
        for e in range(v):
            if power[2] == 0:
                found.append(e)
            low, mid, high = power  # times x, where x**3 = a*x**2 + b*x + c
            power = (c * high % q, (low + b * high) % q, (mid + a * high) % q)
        if len(found) == q + 1 and len({(x - y) % v for x in found for y in found}) == v:
            return v, np.array(found)
    raise ValueError(f"no difference set for {q}")


class Chunk:
    """The distinct texts of a chunk with their number of copies, as one array of units (bytes, or fingerprints of words)."""

    def __init__(self, table: pa.Table, size: int, q: int, unit: str = BYTE):
        self.size, self.unit = size, unit
        copies: dict[bytes, int] = {}
        texts: dict[bytes, bytes] = {}
        for raw, blob in zip(table.column("raw").to_pylist(), table.column("blob").to_pylist()):
            for key, n, text in unpacked(blob, raw):
                copies[key] = copies.get(key, 0) + n
                if text:
                    texts[key] = text
        self.keys = sorted(texts)
        self.copies = np.array([copies[k] for k in self.keys], np.int64)
        self.data = np.frombuffer(b"".join(texts[k] for k in self.keys), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(texts[k]) for k in self.keys]))).astype(np.int64)
        codes = _BYTES[self.data]
        if unit == WORD:
            _, _, row, codes = words(self.data, self.offsets, _LETTERS)
            self.data, self.offsets = codes, np.searchsorted(row, np.arange(len(self.keys) + 1))
        self.prefix = prefix_hash(codes)
        self.v, cover = difference_set(q)
        depth = size - self.v + 1
        lengths = np.diff(self.offsets)
        place = np.arange(len(self.data)) - np.repeat(self.offsets[:-1], lengths)
        room = np.repeat(lengths, lengths) - place
        member = np.zeros(self.v, bool)
        member[cover] = True
        self.sample = np.flatnonzero(member[place % self.v] & (room >= depth))
        self.ranks, self.rank_of, self.rank_count = unique(spans_hash(self.prefix, self.sample, self.sample + depth))

    def holders(self, at: np.ndarray, place: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each string stands here: its positions, or for words the texts that hold it, each with its copies."""
        if self.unit == BYTE or not len(at):
            return counts
        text = np.searchsorted(self.offsets, at, "right") - 1
        order = np.lexsort((text, place))
        text, place = text[order], place[order]
        first = np.concatenate(([True], (text[1:] != text[:-1]) | (place[1:] != place[:-1])))
        return np.bincount(place[first], weights=self.copies[text[first]], minlength=len(counts)).astype(np.int64)

    def live_suffixes(self, live: np.ndarray) -> np.ndarray:
        """Positions of the suffixes with a live sample rank within reach and room for ``size`` bytes."""
        at = self.sample[live[self.rank_of]]
        text = np.searchsorted(self.offsets, at, "right") - 1
        first = np.maximum(at - self.v + 1, self.offsets[text])
        last = np.minimum(at, self.offsets[text + 1] - self.size)
        some = last >= first
        return covered(len(self.data), first[some], last[some] + 1)

    def removed(self, suffixes: np.ndarray) -> np.ndarray:
        """Bytes covered by the given strings, and whole texts that have copies."""
        gone = np.zeros(len(self.data), bool)
        gone[covered(len(self.data), suffixes, suffixes + self.size)] = True
        lengths = np.diff(self.offsets)
        gone[np.repeat((self.copies > 1) & (lengths >= self.size), lengths)] = True
        return gone


def unique(values: np.ndarray):
    """Sorted distinct values, the place of each value among them, and their counts."""
    order = np.argsort(values)
    ordered = values[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(values) else np.zeros(0, bool)
    number = np.cumsum(first) - 1
    place = np.empty(len(values), np.int64)
    place[order] = number
    starts = np.flatnonzero(first)
    return ordered[starts], place, np.diff(np.concatenate((starts, [len(values)])))


def covered(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions below ``n`` that lie in one of the intervals."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.flatnonzero(np.cumsum(depth[:-1]) > 0)


def packed(texts: list[tuple[bytes, int, bytes]]) -> tuple[int, bytes]:
    """(size before compression, compressed keys, copies, lengths and texts)."""
    raw = len(texts).to_bytes(8, "little") + b"".join(k for k, _, _ in texts)
    raw += np.array([n for _, n, _ in texts], np.int64).tobytes() + np.array([len(t) for _, _, t in texts], np.int64).tobytes()
    raw += b"".join(t for _, _, t in texts)
    return len(raw), pa.Codec("zstd", 3).compress(raw, asbytes=True)


def unpacked(blob: bytes, size: int):
    raw = pa.Codec("zstd").decompress(blob, size, asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    copies, lengths = (np.frombuffer(raw, np.int64, n, 8 + 16 * n + 8 * n * i) for i in (0, 1))
    at = 8 + 32 * n
    for i, (count, length) in enumerate(zip(copies.tolist(), lengths.tolist())):
        yield raw[8 + 16 * i : 24 + 16 * i], count, raw[at : at + length]
        at += length


def chunked(docs: DataFrame, size: int, chunks: int) -> DataFrame:
    """Rows (chunk, raw, blob): the texts of ``size`` bytes or more, packed by chunk, with their copies.

    A text's bytes go once per task, or once in all if it has very many copies.
    """
    named, (file, line) = placed(docs.select("text"))
    long = named.where(F.octet_length("text") >= size).select(text_key().alias("key"), "text", F.struct(file, line).alias("place"))
    n = docs.count()
    counts = long.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    many = staged(counts.where(F.col("n") > max(MANY_COPIES, n // 1_000_000)).select("key", "first"), "suffix-many-copies")  # a million at most
    sent = long.join(F.broadcast(many), "key", "left").select("key", "text", F.coalesce(F.col("first") == F.col("place"), F.lit(True)).alias("send"),
                                                              F.col("first").isNotNull().alias("many"))

    def run(batches):
        seen: set[bytes] = set()
        for batch in each(batches):
            data, offsets = text_bytes(batch.column("text"))
            counts: dict[bytes, int] = {}
            texts: dict[bytes, bytes] = {}
            for i, (key, send, many) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "send", "many")))):
                counts[key] = counts.get(key, 0) + 1
                if send and (many or key not in seen):
                    texts[key] = data[offsets[i] : offsets[i + 1]].tobytes()
                    seen.add(key)
            parts: dict[int, list] = {}
            for key, count in counts.items():
                parts.setdefault(int.from_bytes(key[:8], "little") % chunks, []).append((key, count, texts.get(key, b"")))
            rows = [(chunk, *packed(own)) for chunk, own in sorted(parts.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["chunk", "raw", "blob"])

    return sent.mapInArrow(run, "chunk bigint, raw bigint, blob binary")


QUESTION = "chunk bigint, bucket bigint, width int, questions binary, several binary"
ANSWER = "chunk bigint, bucket bigint, bits binary"


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each fingerprint: a range of their upper bits."""
    return ((values >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)


def questions(chunk: int, values: np.ndarray, counts: np.ndarray, buckets: int, kind) -> pa.Table:
    """One row for each bucket that has some of the sorted distinct ``values``, as numbers of type ``kind``."""
    bucket = bucket_of(values, buckets)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
    ends = np.concatenate((starts[1:], [len(bucket)])) if len(bucket) else starts
    short = values.astype(kind)  # keeps the lower bits
    rows = [(short[a:b].tobytes(), np.packbits(counts[a:b] > 1).tobytes()) for a, b in zip(starts, ends)]
    return pa.table({
        "chunk": pa.array(np.full(len(rows), chunk), pa.int64()), "bucket": pa.array(bucket[starts], pa.int64()),
        "width": pa.array(np.full(len(rows), np.dtype(kind).itemsize), pa.int32()),
        "questions": pa.array([r[0] for r in rows], pa.binary()), "several": pa.array([r[1] for r in rows], pa.binary())})


def answered(asked: DataFrame) -> DataFrame:
    """For every question a bit for each fingerprint: whether it stands anywhere else; buckets are sorted one at a time."""

    def run(batches):
        bucket, rows = None, []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(n).to_pylist() for n in ("bucket", "chunk", "width", "questions", "several"))):
                if row[0] != bucket:
                    out.extend(sort_bucket(rows))
                    bucket, rows = row[0], []
                rows.append(row)
            yield table(out)
        yield table(sort_bucket(rows))

    def sort_bucket(rows):
        if not rows:
            return []
        parts = [np.frombuffer(r[3], f"u{r[2]}") for r in rows]
        values, place, counts = unique(np.concatenate(parts))
        again = (counts > 1)[place]
        out, at = [], 0
        for (bucket, chunk, _, _, several), part in zip(rows, parts):
            bits = again[at : at + len(part)] | np.unpackbits(np.frombuffer(several, np.uint8), count=len(part)).astype(bool)
            at += len(part)
            out.append((chunk, bucket, np.packbits(bits).tobytes()))
        return out

    def table(out):
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
            names=["chunk", "bucket", "bits"])

    return asked.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, ANSWER)


def live(values: np.ndarray, buckets: int, names: list[int], bits: list[bytes]) -> np.ndarray:
    """The answers for sorted distinct ``values`` as a bitmap."""
    bucket = bucket_of(values, buckets)
    out = np.zeros(len(values), bool)
    for name, answer in zip(names, bits):
        a, b = np.searchsorted(bucket, [name, name + 1])
        out[a:b] = np.unpackbits(np.frombuffer(answer, np.uint8), count=b - a).astype(bool)
    return out


class Chunks:
    """The texts as a table bucketed by chunk, over which strings are asked about unit by unit."""

    def __init__(self, docs: DataFrame, size: int, chunk_bytes: int):
        self.spark = docs.sparkSession
        total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
        chunks = max(1, -(-total // chunk_bytes))
        self.parts = min(max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), chunks // 16), 100_000)
        self.name = f"suffix_chunks_{uuid.uuid4().hex[:12]}"
        packed_texts = chunked(docs, size, chunks).repartition(self.parts, "chunk").sortWithinPartitions("chunk")
        packed_texts.write.bucketBy(self.parts, "chunk").sortBy("chunk").option("path", scratch_path(self.spark, self.name)).option(
            "compression", "none").saveAsTable(self.name)

    def __enter__(self):
        return self

    def __exit__(self, *error):
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def repeats(self, size: int, q: int, unit: str, found, schema: str) -> DataFrame:
        """``found(chunk, gone)`` of every chunk, ``gone`` marking the units covered by a string of ``size`` units that stands elsewhere too; staged."""
        grouped, buckets = self.spark.table(self.name).groupBy("chunk"), self.parts

        def ask_ranks(table: pa.Table) -> pa.Table:
            chunk = Chunk(table, size, q, unit)
            return questions(table.column("chunk")[0].as_py(), chunk.ranks, chunk.rank_count, buckets, np.uint32)

        def suffixes(table: pa.Table, answers: pa.Table):
            """The chunk, its live suffixes and their fingerprints."""
            chunk = Chunk(table, size, q, unit)
            of = answers.filter(pa.compute.equal(answers.column("width"), 4))
            ranks = live(chunk.ranks, buckets, of.column("bucket").to_pylist(), of.column("bits").to_pylist())
            at = chunk.live_suffixes(ranks)
            values, place, counts = unique(spans_hash(chunk.prefix, at, at + size))
            return chunk, at, values, place, chunk.holders(at, place, counts)

        def ask_suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows:
                return questions(0, np.empty(0, U64), np.empty(0, np.int64), buckets, np.uint64)
            _, _, values, _, counts = suffixes(table, answers)
            return questions(table.column("chunk")[0].as_py(), values, counts, buckets, np.uint64)

        def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows:
                return found(None, None)
            chunk, at, values, place, _ = suffixes(table, answers)
            of = answers.filter(pa.compute.equal(answers.column("width"), 8))
            again = live(values, buckets, of.column("bucket").to_pylist(), of.column("bits").to_pylist())
            return found(chunk, chunk.removed(at[again[place]]))

        ranks = staged(answered(grouped.applyInArrow(ask_ranks, QUESTION)).withColumn("width", F.lit(4)), f"suffix-{unit}-ranks")
        asked = grouped.cogroup(ranks.groupBy("chunk")).applyInArrow(ask_suffixes, QUESTION)
        ties = staged(answered(asked).withColumn("width", F.lit(8)), f"suffix-{unit}-ties")
        return staged(grouped.cogroup(ranks.unionByName(ties).groupBy("chunk")).applyInArrow(mark, schema), f"suffix-{unit}-spans")


def spans_of(chunks: Chunks, size: int, q: int, with_kept: bool) -> DataFrame:
    """Rows (key, n_removed, n_spans, kept_sha256, kept) of the distinct texts of ``size`` bytes or more."""

    def cut(chunk: Chunk | None, gone) -> pa.Table:
        rows = []
        for i, key in enumerate(chunk.keys if chunk else ()):
            a, b = chunk.offsets[i : i + 2]
            if b - a < size:
                continue
            out = gone[a:b]
            kept = chunk.data[a:b][~out].tobytes()
            runs = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
            rows.append((key, int(out.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        columns = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                        names=["key", "n_removed", "n_spans", "kept_sha256", "kept"])

    return chunks.repeats(size, q, BYTE, cut, "key binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def passages_of(chunks: Chunks, size: int, q: int) -> DataFrame:
    """Rows (key, n_passage_words): words that stand in a passage of ``size`` words that another row has too; texts without any have no row."""

    def count(chunk: Chunk | None, gone) -> pa.Table:
        if chunk is None:
            return pa.table([pa.array([], pa.binary()), pa.array([], pa.int64())], names=["key", "n_passage_words"])
        sums = np.concatenate(([0], np.cumsum(gone)))
        n = sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]
        some = np.flatnonzero(n)
        return pa.table([pa.array([chunk.keys[i] for i in some], pa.binary()), pa.array(n[some], pa.int64())], names=["key", "n_passage_words"])

    return chunks.repeats(size, q, WORD, count, "key binary, n_passage_words bigint")


def spans_removed(docs: DataFrame, size: int = SIZE, q: int = Q, chunk_bytes: int = 2 << 20, with_kept: bool = False) -> DataFrame:
    """Rows (key, n_removed, n_spans, kept_sha256, kept): one per distinct text of ``size`` bytes or more.

    ``kept`` has the remaining bytes if ``with_kept``, else null.
    """
    with Chunks(docs, size, chunk_bytes) as chunks:
        return spans_of(chunks, size, q, with_kept)


def deduplicated(docs: DataFrame, size: int = SIZE, q: int = Q, chunk_bytes: int = 2 << 20, words: int = WORDS, words_q: int = WORDS_Q) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words, has_passage): one per row of ``docs``.

    n_passage_words counts the words in passages of ``words`` words or more that another row of ``docs`` holds too.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"),
                      F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    with Chunks(docs, min(size, 2 * words - 1), chunk_bytes) as chunks:
        cut = spans_of(chunks, size, q, False).select("key", "n_removed", "n_spans", "kept_sha256")
        passages = passages_of(chunks, words, words_q)
    found = own.join(cut.join(passages, "key", "full"), "key", "left")

    def number(c):
        return F.coalesce(c, F.lit(0)).cast("bigint").alias(c)

    return found.select("doc_id", "n_bytes", number("n_removed"), number("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
                        number("n_passage_words"), (F.coalesce("n_passage_words", F.lit(0)) > 0).alias("has_passage"))
