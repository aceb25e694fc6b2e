import random
import re
import tracemalloc

import duckdb
import numpy as np
from brute import contamination
from odd import SF

from sheetwright.llm import decontaminate as op

WORDS = re.compile("[a-z0-9]+")
ITEMS = "item_id bigint, text string"


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)


def test_query_matches_brute_force(spark, documents):
    from sheetwright.llm.queries import QUERIES

    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = rows(QUERIES["op3_benchmark_decontamination"](spark, SF))
    want = contamination([(d, t) for d, t, *_ in documents], items)
    assert sorted(got) == sorted(want)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def odd_items(passage):
    words = passage.split()
    return [(1, " ".join(words[40:70])), (2, "one"), (3, None), (4, ""), (None, " ".join(words[100:113])),
            (5, "the same short"), (5, "SAME SHORT TEXT"), (6, " ".join(words[40:70])), (7, "c d"), (8, "absent " * 20)]


def test_odd_rows(spark, make_docs, odd_rows):
    from odd import PASSAGE

    odd_rows = [*odd_rows, (None, PASSAGE, None, None), (5, PASSAGE, "b", "en"), (90, " ".join(["one"] * 60), "x", "en")]
    items = odd_items(PASSAGE)
    want = sorted(contamination([(d, t) for d, t, *_ in odd_rows], items), key=key)
    docs, bench = make_docs(odd_rows), spark.createDataFrame(items, ITEMS)
    assert sorted(rows(op.report(docs, bench)), key=key) == want
    blocks = op.report(docs, bench, block_bytes=150)  # several passes give the same
    assert sorted(rows(blocks), key=key) == want


def test_longest_matches_and_places(spark, make_docs):
    text = "zero " + " ".join(f"w{i}" for i in range(40)) + " tail"
    bench = spark.createDataFrame([(7, "head " + " ".join(f"w{i}" for i in range(5, 30)) + " other")], ITEMS)
    match = op.benchmark_matches(make_docs([(1, text)]), bench).first()["matches"]
    assert [tuple(m) for m in match] == [("7", 1, 6, 25)]


def test_decontaminated_keeps_columns_and_clean_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows).selectExpr("*", "1 AS n_words", "2 AS matches", "3 AS row", "4 AS item_id")
    bench = spark.createDataFrame(odd_items(odd_rows[4][1]), ITEMS)
    kept = op.decontaminated(docs, bench)
    assert kept.schema == docs.schema
    gone = {r[0] for r in contamination([(d, t) for d, t, *_ in odd_rows], odd_items(odd_rows[4][1])) if r[5]}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, *_ in odd_rows if d not in gone)


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "some words")], ITEMS)
    assert rows(op.report(make_docs([]), bench)) == []
    assert rows(op.report(make_docs([(1, "some words")]), bench.limit(0)))[0][1:4] == (2, 0, 0)


def longest_matches(text, item, window=13):
    """(item word, document word, words) of every longest verbatim match that holds a window, by brute force."""
    a, b = (WORDS.findall(t.lower()) for t in (item, text))
    least = min(window, len(a))
    out = []
    for i in range(len(a)):
        for d in range(len(b)):
            if a[i] != b[d] or (i and d and a[i - 1] == b[d - 1]):
                continue
            n = 0
            while i + n < len(a) and d + n < len(b) and a[i + n] == b[d + n]:
                n += 1
            if n >= least and (len(a) >= window or n == len(a)):
                out.append((i, d, n))
    return sorted(out, key=lambda m: (m[1] - m[0], m[1]))


def test_repetitive_texts_have_every_longest_match(spark, make_docs):
    rng = random.Random(2)
    items = [(0, " ".join(["a"] * 40)), (1, " ".join(["a", "b"] * 20)), (2, " ".join(rng.choices("ab", k=60))), (3, "a a a"), (4, "c " * 13), (5, "a b c " * 9)]
    texts = [" ".join(["a"] * 70), " ".join(["b", "a"] * 40), " ".join(rng.choices("ab", k=300)), "x " + "a b c " * 20 + "x a a a x", "c " * 12, "c " * 14]
    got = op.benchmark_matches(make_docs(list(enumerate(texts))), spark.createDataFrame(items, ITEMS)).collect()
    for r in got:
        for name, item in items:
            own = [tuple(m)[1:] for m in r["matches"] if m["item_id"] == str(name)]
            assert own == longest_matches(texts[r["row"]["doc_id"]], item), (name, r["row"]["doc_id"])


def test_long_repetitive_texts_in_bounded_memory(spark, make_docs):
    """A megabyte of one word, and of a period of three, against items of a thousand: a match for each place one can begin, not each pair."""
    item = " ".join(["same"] * 1000)
    period = "one two three " * 333
    docs = make_docs([(1, "same " * 200_000), (2, "one two three " * 80_000), (3, "other words")])
    bench = spark.createDataFrame([(1, item), (2, period)], ITEMS)
    got = {r["doc_id"]: tuple(r)[1:4] for r in op.report(docs, bench).select("doc_id", "n_words", "n_hit", "n_items").collect()}
    assert got == {1: (200_000, 200_000, 1), 2: (240_000, 240_000, 1), 3: (2, 0, 0)}
    queries = op.Queries(["1"], [item], 13)
    hashes = np.full(200_000, queries.vocabulary[0])
    tracemalloc.start()
    found = op.shard_matches(queries, np.zeros(200_000, np.int64), hashes, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == 200_000 + 1000 - 2 * 13 + 1 and peak < 200 << 20
