from fractions import Fraction

import duckdb
import numpy as np
import pytest
from odd import SF

from sheetwright.llm import whitening
from sheetwright.llm.vectors import commonest_length

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, components=32):
    """rows: (vec_id, vector) that count -> (ids, n, deviation, components by row, explained)."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums  # n times, exact
    cov = np.array([[float(Fraction(int(a @ b), n**3)) for b in centred.T] for a in centred.T])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, [int((r * r).sum()) for r in centred], centred.astype(float) / n @ vectors / np.sqrt(values), values / np.trace(cov)


def check(got, rows, components):
    n, deviation, want, explained = brute(rows, components)
    assert len(got) == n * components
    place = {}
    for i, (name, _) in enumerate(rows):
        place.setdefault(name, []).append(i)
    signs = {}
    for r in sorted(got, key=lambda r: (r["component"], str(r["vec_id"]))):
        i, k = place[r["vec_id"]][0], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(want[i, k]), abs=1e-6)
        if abs(want[i, k]) > 1e-3:
            signs.setdefault(k, set()).add(bool(r["whitened"] > 0) == bool(want[i, k] > 0))
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-6


def test_query(spark):
    from sheetwright.llm.queries import QUERIES

    df = QUERIES["op11_polarised_whitening"](spark, SF)
    assert [f.simpleString() for f in df.schema] == ["vec_id:bigint", "component:int", "n:bigint", "deviation:bigint", "whitened:double",
                                                     "explained:double", "identity_error:double"]
    check(df.collect(), duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall(), 32)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(None, [0.5, 1.0, 2.0]), (3, [4.0, 4.0, 4.0]), (99, [1e4, 1e4 + 1, -1e4])]
    good += [good[-1]] * 5  # repeated rows
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [1.0, float("inf"), 0.0]), (55, [1.0]), (56, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in good + bad], SCHEMA).selectExpr("*", "1 AS n", "2 AS whitened", "3 AS _v", "4 AS component")
    distinct = {n for n, _ in good if n not in (3, 99)}
    got = whitening.report(df).collect()
    n, deviation, want, explained = brute(good, 3)
    assert len(got) == 3 * len(good) and {r["n"] for r in got} == {n}
    assert sorted(r["deviation"] for r in got) == sorted(d for d in deviation for _ in range(3))
    for name in distinct:
        i = [g[0] for g in good].index(name)
        mine = sorted((r["component"], abs(r["whitened"])) for r in got if r["vec_id"] == name)
        assert [w for _, w in mine] == pytest.approx(np.abs(want[i]).tolist(), abs=1e-6)
    assert got[0]["identity_error"] <= 1e-6


def test_far_from_zero_and_very_large_entries(spark):
    """Digits that a plain sum of squares in doubles would lose; entries past the bound do not fail."""
    rows = [(i, [1e9 + i % 7, 1e9 + (i * i) % 11]) for i in range(200)]
    got = whitening.report(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    check(got, rows, 2)
    wide = whitening.report(spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [0.0, 5e11], 0)], SCHEMA)).collect()
    assert {r["deviation"] for r in wide} == {None} and all(np.isfinite(r["whitened"]) for r in wide)


def test_few_or_constant_vectors(spark):
    def run(vectors):
        return whitening.report(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()

    assert run([]) == run([[1.0, 2.0]]) == run([[1.0, 2.0]] * 9) == run([None, []]) == []
    assert {r["component"] for r in run([[1.0, 2.0, 5.0], [2.0, 1.0, 5.0], [3.0, 3.0, 5.0]])} == {1, 2}  # the third dimension is constant


def test_model_and_columns(spark):
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(mixed)], SCHEMA).withColumnRenamed("embedding", "My Vec").selectExpr("*", "1 AS Whitened")
    rows = whitening.vectors_of(df, "My Vec")
    model = whitening.fit(rows, components=4)
    out = whitening.whitened(df, model, "My Vec")
    assert out.columns == ["vec_id", "My Vec", "label", "whitened"]
    w = np.array([r["whitened"] for r in out.collect()])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9 and np.abs(w.mean(axis=0)).max() < 1e-9
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(4), atol=1e-12) and (np.diff(model.values) <= 0).all()
    assert commonest_length(rows, "_v") == 6
    with pytest.raises(ValueError, match="dimensions"):
        whitening.fit(whitening.vectors_of(spark.createDataFrame([([0.0] * (whitening.MAX_DIMENSIONS + 1),)], "e array<double>"), "e"))


def test_covariances_come_from_variances_exactly():
    rng = np.random.default_rng(4)
    z = rng.integers(-50, 50, size=(500, 5))
    squares = {(i, j): int(((z[:, i] + z[:, j] * (i != j)) ** 2).sum()) for i in range(5) for j in range(i, 5)}
    found = whitening.covariance(500, [int(s) for s in z.sum(axis=0)], squares)
    assert np.allclose(found, np.cov(z.T, bias=True), rtol=1e-13, atol=1e-10)


def test_sums_are_handed_on_before_they_overflow():
    sums, big = whitening.Sums([(0, 0), (1, 1)]), 1 << 61
    handed = []
    for _ in range(5):
        handed += list(sums.add(np.array([big - 1, 5]), big))
    handed += list(sums.add(np.array([1 << 90, 1], dtype=object), 1 << 90))
    handed += list(sums.rest())
    totals = [sum(int(b.column("total")[k].as_py()) for b in handed) for k in (0, 1)]
    assert totals == [5 * (big - 1) + (1 << 90), 26]
