import duckdb
import numpy as np
import pytest
from odd import SF

from sheetwright.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows):
    """rows: (vec_id, vector, label) that take part, of one length."""
    rows = [(v, [int(np.floor(256 * x)) for x in e], (label + 1) % 10 if v is not None and v % 7 == 0 else label) for v, e, label in rows]
    last = float("inf")
    out = []
    for i, (anchor, a, own) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, e)), last if v is None else v, label) for j, (v, e, label) in enumerate(rows) if j != i))
        for score, positive, _ in [s for s in scored if s[2] == own][:5]:
            window = [s for s in scored if s[2] != own and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(anchor, None if positive == last else positive, k + 1, None if n == last else n, -score, -s) for k, (s, n, _) in enumerate(window)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    return sorted(map(tuple, hard_negatives.mined(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


def test_query_equals_brute_force(spark):
    from sheetwright.llm.queries import QUERIES

    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, SF).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block_rows", [7, 64, 4096])
def test_many_blocks_and_ties(spark, block_rows):
    """Small integers give many equal scores, zero scores and negative ones; a third of the rows have one label and one vector."""
    rng = np.random.default_rng(block_rows)
    rows = [(int(i), (rng.integers(-2, 3, size=3) / 256).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    rows += [(1000 + i, [1 / 256, 1 / 256, 0.0], 9) for i in range(300)]
    assert mined(spark, rows, block_rows=block_rows) == brute(rows)


def test_odd_rows(spark):
    good = [(i, [float(i % 5), 1.0 - i % 3], i % 3) for i in range(0, 450)] + [(100, [1.0, 1.0], 2), (100, [1.0, 1.0], 2), (None, [4.0, 4.0], 1), (None, [2.0, 1.0], 0), (-100, [2.0, 2.0], 1)]
    bad = [(200, None, 1), (300, [1.0, None], 1), (400, [float("nan"), 1.0], 0), (500, [float("inf"), 1.0], 0), (600, [1.0, 1.0], None), (700, [], 1), (800, [1.0], 1), (900, [1.0] * 3, 1)]
    wide = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "1 AS _v", "2 AS score", "3 AS row", "4 AS key", "5 AS rank")
    assert sorted(map(tuple, hard_negatives.mined(wide).collect()), key=str) == brute(good)


def test_tables_without_results(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert mined(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == []  # no positive
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2)]) == []  # no negative in the window
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(100, 1, 1, 2, 65536, 32768)]


def test_large_entries_are_limited(spark):
    rows = [(i, [1e30 if i % 2 else 1.0, -1e30], i % 3) for i in range(1, 230)]
    for r in mined(spark, rows):
        assert -(1 << 63) < r[5] < 1 << 63 and 30 * r[4] <= 100 * r[5] <= 90 * r[4]


def test_packed_pairs_sort_as_their_tuples():
    rng = np.random.default_rng(0)
    tuples = [(int(a), int(a) * 100 - 500, int(s), int(k), None if u else int(i)) for a, s, k, u, i in zip(
        rng.integers(0, 4, 500), rng.integers(-(1 << 50), 1 << 50, 500) * rng.integers(0, 2, 500), rng.integers(0, 2, 500), rng.integers(0, 2, 500), rng.integers(-9, 9, 500))]
    sign = 1 << 63
    keys = [hard_negatives.PAIR.pack(a, n + sign, sign - 1 - s, k, i is None, sign + (i or 0)) for a, n, s, k, i in tuples]
    assert [hard_negatives.unpacked(k) for k in keys] == tuples
    want = sorted(tuples, key=lambda t: (t[0], t[1], -t[2], t[3], t[4] is None, t[4] or 0))
    assert [hard_negatives.unpacked(k) for k in sorted(keys)] == want
    found = hard_negatives.sortable(np.array([-5, 0, 7], np.int64))
    assert found.tolist() == [sign - 5, sign, sign + 7]


def test_pairs_stream_without_being_held():
    """A generator of pairs is read one at a time: a row comes out before the last pair is made."""
    sign, made = 1 << 63, 0

    def pairs():
        nonlocal made
        for kind, score, n in [(0, 100, 1)] + [(1, 90 - i, 10 + i) for i in range(50)]:
            made += 1
            yield hard_negatives.PAIR.pack(1, sign + 100, sign - 1 - score, kind, 0, sign + n), None

    stream = hard_negatives.negatives(pairs())
    assert next(stream) == (100, 1, 1, 10, 100, 90) and made == 2
    assert len(list(stream)) == 9
