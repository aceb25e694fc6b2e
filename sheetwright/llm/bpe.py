"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

A text is split at its special tokens, then into words by the byte-level
pattern; a word is the unit of merging.  A short word (up to ``LONG`` bytes)
holds the boundaries of its parts and, beside them, the rank of every adjacent
pair, in two contiguous arrays.  The least rank (the leftmost of equal ones)
is found by a scan, the boundary between its parts goes, and the ranks of the
two pairs that touch the new part are looked up again, until no pair can merge.
The scan is quadratic in the word, so a longer word (a run of letters without
spaces, of any length) keeps the same ranks in a heap over linked parts and
gives the same ids in n log n.

The vocabulary is a tokenizer file of public libraries, named by path, read on
the driver and broadcast as the file's own bytes (1.5 MB; a file over
``MAX_FILE`` bytes raises).  Ids, special tokens and decoded text equal that library's
with add_special_tokens=False and skip_special_tokens=False.

Scale: one pass over the texts, no shuffle.  A task remembers the ids of the
words it has met, and the bytes they decode to, for about ``MEMORY_WORDS``
words that it met last; a long text is encoded ``PIECE`` words at a time, so
beside the text itself memory does not grow with it.

Defined results: a null text is empty; an empty text has no tokens and the
hashes of the empty string; repeated rows each give a row; an empty table
gives no rows; columns other than those named are not read, whatever their
names.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetwright.llm.common import each, fresh

LONG = 96
PIECE = 1 << 16
MEMORY_WORDS = 800_000
MAX_FILE = 64 << 20
NEVER = 1 << 60


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def later_characters(file: str) -> str:
    """Letters and numbers of ``regex`` that the tokenizer library does not know yet, as the inside of a character set.

    The two follow different versions of Unicode.  Only characters on which
    ``regex`` and Python's own tables differ are asked about.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_str(file).pre_tokenizer
    known = regex.compile(r"[\p{L}\p{N}]")
    out: list[list[int]] = []
    for code in itertools.chain(range(0xD800), range(0xE000, 0x110000)):
        c = chr(code)
        if unicodedata.category(c) == "Cn" and known.match(c):
            starts = {span[0] for _, span in split.pre_tokenize_str(f"a{c}1{c}")}
            if 1 in starts and 3 in starts:  # it joins neither a letter nor a number
                if out and out[-1][1] == code - 1:
                    out[-1][1] = code
                else:
                    out.append([code, code])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out)


def word_pattern(later: str = "") -> regex.Pattern:
    """The byte-level pattern; the characters ``later`` count as neither letters nor numbers."""
    letter, number, other = (rf"[\p{{L}}--[{later}]]", rf"[\p{{N}}--[{later}]]", rf"[[^\s\p{{L}}\p{{N}}]||[{later}]]") if later else (
        r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
    return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+", regex.V1 if later else 0)


class Vocabulary:
    """Ids, merge ranks and splitting rules of a byte-level tokenizer file."""

    def __init__(self, file: str, later: str):
        found = json.loads(file)
        check_supported(found)
        model, of = found["model"], byte_characters()

        def raw(token: str) -> bytes:
            return bytes(of[c] for c in token)

        self.ids = {raw(token): i for token, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = merge_ranks([(raw(a), raw(b)) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.bytes_of = {i: token for token, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.plain = word_pattern()
        self.careful, self.later = (word_pattern(later), regex.compile(f"[{later}]")) if later else (self.plain, None)
        self.memory = Memory(self)

    def word_ids(self, word: str) -> list[int]:
        """The ids of one word of the pattern."""
        raw = word.encode()
        bounds = merged_short(raw, self.ranks) if len(raw) <= LONG else merged_long(raw, self.ranks)
        return [self.ids[raw[a:b]] for a, b in itertools.pairwise(bounds)]

    def decoded(self, ids: Sequence[int]) -> bytes:
        """The bytes of ``ids``; ids that are not in the vocabulary have none."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids])

    def pieces(self, text: str) -> Iterator[tuple[str, bytes]]:
        """(decimal ids joined by commas, the bytes they decode to) of ``text``, some words at a time; pieces are not empty."""
        at = 0
        for special in self.special_pattern.finditer(text) if self.special_pattern else ():
            yield from self.plain_pieces(text, at, special.start())
            own = self.special[special.group()]
            yield str(own), self.decoded([own])
            at = special.end()
        yield from self.plain_pieces(text, at, len(text))

    def plain_pieces(self, text: str, start: int, end: int) -> Iterator[tuple[str, bytes]]:
        if start == end:
            return
        text = text[start:end]  # the pattern looks ahead, so it must end where the part ends
        pattern = self.careful if self.later and not text.isascii() and self.later.search(text) else self.plain
        if len(text) <= PIECE:
            yield self.memory.piece(pattern.findall(text))
            return
        words = (m.group() for m in pattern.finditer(text))
        while part := list(itertools.islice(words, PIECE)):
            yield self.memory.piece(part)

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``."""
        return [int(i) for ids, _ in self.pieces(text) for i in ids.split(",")]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 give U+FFFD, ids that are not in the vocabulary nothing."""
        return self.decoded(ids).decode("utf-8", "replace")


class Memory(dict):
    """The ids (decimal, joined by commas) of words met lately and the bytes these ids decode to, in two generations."""

    def __init__(self, of: Vocabulary):
        self.of, self.older = of, {}

    def __missing__(self, word: str) -> tuple[str, bytes]:
        found = self.older.get(word)
        if found is None:
            ids = self.of.word_ids(word)
            found = ",".join(map(str, ids)), self.of.decoded(ids)
        if len(word) <= LONG:
            self[word] = found
        return found

    def piece(self, words: Sequence[str]) -> tuple[str, bytes]:
        if len(self) > MEMORY_WORDS // 2:
            self.older = dict(self)
            self.clear()
        found = [self[word] for word in words]
        return ",".join([ids for ids, _ in found]), b"".join([raw for _, raw in found])


def merge_ranks(pairs: list[tuple[bytes, bytes]]) -> dict[bytes, int]:
    """Rank by what a pair merges to.

    Two adjacent parts that together are a token are the pair the vocabulary
    merges to it, if no two pairs give the same token and the token's own bytes
    merge to that pair; both are checked.
    """
    ranks = {a + b: rank for rank, (a, b) in enumerate(pairs)}
    if len(ranks) < len(pairs):
        raise ValueError("not a plain byte-level BPE file: two merges give the same token")
    for rank, (a, b) in enumerate(pairs):
        if merged_short(a + b, ranks, rank) != [0, len(a), len(a) + len(b)]:
            raise ValueError(f"not a plain byte-level BPE file: merge {rank} cannot be reached")
    return ranks


def check_supported(found: dict) -> None:
    """Raise for tokenizer files that ask for more than byte-level BPE."""
    model, split = found["model"], found.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += ["normalizer"] * bool(found.get("normalizer"))
    odd += ["pre_tokenizer"] * (split.get("type") != "ByteLevel" or bool(split.get("add_prefix_space")) or not split.get("use_regex", True))
    odd += [t["content"] for t in found["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"not a plain byte-level BPE file: {odd}")


def merged_short(word: bytes, ranks: dict[bytes, int], below: int = NEVER) -> list[int]:
    """Boundaries of the parts of ``word`` after all merges ranked ``below``, by scans of a contiguous array of adjacent ranks."""
    bounds = list(range(len(word) + 1))
    rank_of = ranks.get
    adjacent = [rank_of(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
    while adjacent:
        least = min(adjacent)
        if least >= below:
            break
        i = adjacent.index(least)
        del bounds[i + 1], adjacent[i]
        if i < len(adjacent):
            adjacent[i] = rank_of(word[bounds[i] : bounds[i + 2]], NEVER)
        if i:
            adjacent[i - 1] = rank_of(word[bounds[i - 1] : bounds[i + 1]], NEVER)
    return bounds


def merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merged_short``, with the ranks in a heap: entries that a merge has made stale are skipped when they come up."""
    n = len(word)
    after = list(range(1, n + 2))  # start of the next part, by start of a part
    before = list(range(-1, n))
    live = [True] * n
    heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(left: int, right: int) -> None:
        end = after[right]
        rank = ranks.get(word[left:end])
        if rank is not None:
            heapq.heappush(heap, (rank, left, right, end))

    while heap:
        _, left, right, end = heapq.heappop(heap)
        if not (live[left] and right < n and live[right] and after[left] == right and after[right] == end):
            continue
        live[right] = False
        after[left] = end
        if end < n:
            before[end] = left
            offer(left, end)
        if left:
            offer(before[left], left)
    return [i for i in range(n) if live[i]] + [n]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(file: str, later: str) -> Vocabulary:
    """The vocabulary of a tokenizer file, kept as long as the worker lives."""
    name = hashlib.sha256(file.encode()).hexdigest()
    if name not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[name] = Vocabulary(file, later)
    return _VOCABULARIES[name]


def shipped(spark: SparkSession, path: str):
    """The tokenizer file at ``path`` (on the driver) and its later characters, as a broadcast of proven size."""
    with open(path, encoding="utf-8") as f:
        file = f.read(MAX_FILE + 1)
    if len(file) > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} characters")
    check_supported(json.loads(file))  # here, so that the caller gets the error itself and not a failed task's
    return spark.sparkContext.broadcast((file, later_characters(file)))


def encoded(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with ``name``: the token ids of column ``text`` (array of int); a column of that name is replaced."""
    return _with_column(docs, path, F.col(f"`{text}`").cast("string"), name, pa.list_(pa.int32()), "array<int>", lambda found, text: found.encode(text or ""))


def decoded(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with ``name``: the text of the token ids in column ``ids`` (a null list is empty); a column of that name is replaced."""
    return _with_column(rows, path, F.col(f"`{ids}`").cast("array<int>"), name, pa.string(), "string", lambda found, ids: found.decode(ids or []))


def _with_column(df: DataFrame, path: str, value: Column, name: str, kind: pa.DataType, sql_type: str, of) -> DataFrame:
    """``df`` with ``name``: ``of(vocabulary, value)``, some megabytes of values at a time."""
    sent, source = shipped(df.sparkSession, path), fresh("_value", df)
    kept = [c for c in df.columns if c.lower() != name.lower()]
    wide = df.select(*[F.col(f"`{c}`") for c in kept], value.alias(source))
    schema = wide.drop(source).withColumn(name, F.lit(None).cast(sql_type)).schema

    def run(batches):
        found = vocabulary(*sent.value)
        for batch in each(batches):
            column = batch.column(source)
            step = max(1, min(batch.num_rows, batch.num_rows * (1 << 20) // max(1, column.nbytes)))
            for a in range(0, batch.num_rows, step):
                made = pa.array([of(found, v.as_py()) for v in column.slice(a, step)], kind)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, step) for c in kept), made], names=[*kept, name])

    return wide.mapInArrow(run, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): one per row of ``docs``.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the
    UTF-8 text that these ids decode to.
    """
    sent = shipped(docs.sparkSession, path)

    def digest(found: Vocabulary, text: str) -> tuple[int, str, str]:
        n, ids, whole, partial = 0, hashlib.sha256(), hashlib.sha256(), b""
        for piece, raw in found.pieces(text):
            ids.update(b"," * (n > 0) + piece.encode())
            n += piece.count(",") + 1
            partial += raw
            cut = whole_characters(partial)
            whole.update(partial[:cut].decode("utf-8", "replace").encode())
            partial = partial[cut:]
        whole.update(partial.decode("utf-8", "replace").encode())
        return n, ids.hexdigest(), whole.hexdigest()

    def run(batches):
        found = vocabulary(*sent.value)
        for batch in each(batches):
            texts = batch.column("text")
            rows = [digest(found, texts[i].as_py() or "") for i in range(batch.num_rows)]
            n, ids, whole = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(whole, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def whole_characters(raw: bytes) -> int:
    """Length of ``raw`` without a character that may go on beyond its end."""
    for back in range(1, min(4, len(raw) + 1)):
        byte = raw[-back]
        if byte < 0x80:
            return len(raw)
        if byte >= 0xC0:  # the first byte of a character of 2 to 4 bytes
            return len(raw) - back if back < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4) else len(raw)
    return len(raw)
