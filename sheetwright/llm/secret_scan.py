"""Secrets found through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
trigrams that every match must contain, joined by AND and OR.  Documents are
indexed in blocks; a block's index has, for each trigram that a query names, a
posting bitmap of the block's documents.  A rule's query intersects and unites
postings, which leaves the candidates, and the regular expression is run on
those only.  A rule without mandatory trigrams scans every document.

Scale: a block is a bounded slice of the scan, indexed, searched and forgotten
in its task: every row is indexed, nothing is shuffled, and a task holds one
block's index.

Defined results: a null text is empty; spans are code points, end exclusive;
spans of different kinds may overlap; an empty table gives no rows; repeated
rows each give a row; every rule takes a time linear in the text, also in long
repetitive ones; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.textbytes import slices, text_bytes

BLOCK_BYTES = 2 << 20
MOST_STRINGS, MOST_CHARS = 64, 10


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``keep`` says which matches of the pattern count.

    ``find`` gives the pattern's matches in a time linear in the text, for a
    pattern that the regular expression engine cannot run so.
    """

    kind: str
    pattern: str
    flags: int = 0
    keep: Callable[[re.Match], bool] = lambda m: True
    find: Callable[[str], Iterator[tuple[int, int]]] | None = None

    @property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags | re.ASCII)


#: Every run of dotted parts, also of one part, and nothing given back: else a long run without a dot is tried from each place.
_DOTTED = re.compile(r"[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)*+")


def web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the ``jwt`` pattern: three parts of ten or more characters, the first after ``eyJ``.

    Runs of dotted parts are found first.  Within a part the first ``eyJ``
    leaves the most characters, so the others need not be tried.
    """
    for run in _DOTTED.finditer(text):
        start = run.start()
        parts = []
        for part in run.group().split("."):
            parts.append((start, part))
            start += len(part) + 1
        free = 0  # parts before this one belong to a match
        for i in range(len(parts) - 2):
            begin, part = parts[i]
            at = part.find("eyJ") if i >= free else -1
            if at >= 0 and len(part) - at - 3 >= 10 and len(parts[i + 1][1]) >= 10 and len(parts[i + 2][1]) >= 10:
                yield begin + at, parts[i + 2][0] + len(parts[i + 2][1])
                free = i + 3


# The base kinds, in the order in which spans that start together are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE,
         lambda m: len(m[2]) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 18),
    Rule("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 16),
)
# Public formats of keys and tokens, listed after the base kinds.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", find=web_tokens),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,100}@"),
)
RULES = BASE + MORE

# A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def both(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    return a if a == b else ("and", (a, b))


def either(queries: list[Query]) -> Query:
    if any(q is True for q in queries):
        return True
    queries = list(dict.fromkeys(queries))
    return queries[0] if len(queries) == 1 else ("or", tuple(queries))


def of_strings(strings: set[str]) -> Query:
    """Condition that one of ``strings`` occurs."""

    def one(s: str) -> Query:
        found: Query = True
        for i in range(len(s) - 2):
            found = both(found, s[i : i + 3])
        return found

    return either([one(s) for s in sorted(strings)]) if strings else True


def characters(items) -> set[str] | None:
    """The characters of a class when they are few, lower-cased; None otherwise."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_CHARS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARS else None


def analysed(node) -> tuple[set[str] | None, Query]:
    """(all strings the node can match, or None where they are many; a condition on what contains a match)."""
    run: set[str] = {""}  # strings of the parts since the last one that can match too much
    finite, query = True, True
    for kind, value in node:
        part, condition = analysed_part(kind, value)
        query = both(query, condition)
        if part is not None and len(run) * len(part) <= MOST_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        finite, query = False, both(query, of_strings(run))
        run = {""} if part is None else part
    return (run, query) if finite else (None, both(query, of_strings(run)))


def analysed_part(kind, value) -> tuple[set[str] | None, Query]:
    """``analysed`` for one part of a sequence."""
    if kind is op.LITERAL:
        return {chr(value).lower()}, True
    if kind is op.IN:
        return characters(value), True
    if kind is op.SUBPATTERN:
        return analysed(value[-1])
    if kind is op.AT:
        return {""}, True
    if kind is op.BRANCH:
        found = [analysed(x) for x in value[1]]
        if all(s is not None for s, _ in found):
            return set().union(*(s for s, _ in found)), True
        return None, either([both(q, of_strings(s) if s is not None else True) for s, q in found])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        part, condition = analysed(inner)
        if part is not None and (low, high) == (0, 1):
            return part | {""}, True
        return None, both(condition, of_strings(part) if part is not None else True) if low else True
    return None, True


def trigram_query(rule: Rule) -> Query:
    """What the lower-cased trigrams of a text must fulfil for the rule to match; True if nothing follows from the pattern."""
    strings, query = analysed(parser.parse(rule.pattern, rule.flags | re.ASCII))
    return both(query, of_strings(strings)) if strings is not None else query


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class BlockIndex:
    """Posting bitmaps of a block of texts for the given trigrams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: list[str]):
        self.size = len(offsets) - 1
        self.number = {t: i for i, t in enumerate(wanted)}
        self.postings = np.zeros((len(wanted), self.size), bool)
        if len(data) < 3 or not wanted:
            return
        low = LOWER[data].astype(np.uint32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        names = np.array([int.from_bytes(t.encode("latin-1"), "big") for t in wanted], np.uint32)
        known = np.zeros(1 << 24, bool)
        known[names] = True
        at = np.flatnonzero(known[codes])
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        order = np.argsort(names)
        trigram = order[np.searchsorted(names[order], codes[at[inside]])]
        self.postings[trigram, row[inside]] = True

    def candidates(self, query: Query) -> np.ndarray:
        """Bitmap of the texts that fulfil ``query``."""
        if query is True:
            return np.ones(self.size, bool)
        if isinstance(query, str):
            return self.postings[self.number[query]]
        parts = [self.candidates(q) for q in query[1]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


def matches(rule: Rule, regex: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    if rule.find:
        yield from rule.find(text)
        return
    for m in regex.finditer(text):
        if rule.keep(m):
            yield m.span()


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows (row, spans): each row of ``docs`` as a struct and its secrets, array<struct<kind, start, end>>, by start, then kind as listed."""
    rows = docs.select(F.struct("*").alias("row"))
    schema = rows.select("row", F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)").alias("spans")).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        queries = [trigram_query(r) for r in rules]
        wanted = sorted(set().union(*(trigrams(q) for q in queries)))
        regexes = [r.regex for r in rules]
        for batch in batches:
            data, offsets = text_bytes(batch.column("row").field("text"))
            found = []
            for a, b in slices(offsets, BLOCK_BYTES):
                own = offsets[a : b + 1] - offsets[a]
                block = data[offsets[a] : offsets[b]]
                index = BlockIndex(block, own, wanted)
                hits = np.stack([index.candidates(q) for q in queries])
                for i in range(b - a):
                    text = block[own[i] : own[i + 1]].tobytes().decode()
                    of_text = [(start, n, end) for n in np.flatnonzero(hits[:, i])
                               for start, end in matches(rules[n], regexes[n], text)]
                    found.append([{"kind": rules[n].kind, "start": start, "end": end} for start, n, end in sorted(of_text)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], names=["row", "spans"])

    return rows.mapInArrow(run, schema)


def joined(spans_, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans (of ``kinds``), comma-joined."""
    if kinds:
        spans_ = F.filter(spans_, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, spans): one per row of ``docs``."""
    found = spans(docs.select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE]
    return found.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"), *counts,
        F.sha2(joined(F.col("spans"), tuple(r.kind for r in BASE)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
