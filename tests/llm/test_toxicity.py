from zlib import crc32

import duckdb
import pytest
from odd import SF

from sheetwright.llm import toxicity as op

LABELS = "doc_id bigint, quality int, toxic int"


def test_query_on_held_out_labels(spark, documents):
    from sheetwright.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity_grammar"](spark, SF).collect()}
    assert len(got) == len(documents)
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    for d, r in got.items():
        assert r["held_out"] == (crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [d for d in label if got[d]["held_out"]]
    bad, good = [[got[d]["score"] for d in held if label[d] == y] for y in (1, 0)]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc >= 0.8 and sum(got[d]["predicted"] for d in held if not label[d]) <= 0.02 * len(good)


def features(text):
    lexicon = op.Lexicon({"idiot": 2.0, "moro*": 3.0})
    return {k: v for k, v in op.clause_features(lexicon, text).items() if k != "more"}


@pytest.mark.parametrize("clause, found", [
    ("the idiot came", {"plain": 2.0}), ("morons everywhere", {"plain": 3.0}), ("you are an idiot", {"targeted": 2.0}),
    ("an idiot like you", {"targeted": 2.0}), ("that is not an idiot", {"negated": 2.0}), ("you are not an idiot", {"negated": 2.0}),
    ("he said you are an idiot", {"reported": 2.0}), ("an idiot said so", {"plain": 2.0}), ("we will kill time", {"threat": 1.0}),
    ("he said he will kill", {"reported": 1.0}), ("you never said that", {}), ("kill", {}),
    ("idiot moron", {"plain": 5.0}), ("not one of them was there when the idiot came", {"plain": 2.0})])
def test_grammar(clause, found):
    assert features(clause) == found


def test_whole_texts_and_clauses():
    import pyarrow as pa

    lexicon = op.Lexicon({"idiot": 2.0, "über*": 1.0})
    texts = ["not here. idiot", "IDIOT! you\nsaid idiot", None, "", "fill " * 60_000 + "Idiot", "ÜBERALL", "plain idiotic", "idiot, idiot"]
    got = op.text_features(lexicon, pa.array(texts, pa.string()))
    assert got.tolist() == [
        [2, 0, 0, 0, 0, 0], [2, 0, 0, 2, 0, 1], [0] * 6, [0] * 6, [2, 0, 0, 0, 0, 0], [1, 0, 0, 0, 0, 0], [0] * 6, [4, 0, 0, 0, 0, 1]]


def test_learning_and_odd_rows(spark, make_docs, odd_rows):
    clean = [(i, f"plain text number {i} with nothing in it. more of the same") for i in range(200, 320)]
    toxic = [(i, f"some text {i}. such a grumbleton and zarkface here") for i in range(400, 460)]
    docs = make_docs([*clean, *toxic, *odd_rows, (None, "zarkface", "s", "en")]).selectExpr("*", "1 AS toxic", "2 AS features", "3 AS score")
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in clean] + [(d, 0, 1) for d, _ in toxic] + [(1, 1, 0), (1, 1, None), (None, 1, 1), (99999, 0, 1)], LABELS)
    got = {r["doc_id"]: r for r in op.scored(docs, labels).collect()}
    assert all(got[d]["predicted"] == 1 for d, _ in toxic) and all(got[d]["predicted"] == 0 for d, _ in clean)
    assert all(got[d]["predicted"] == 0 for d, *_ in odd_rows) and got[None]["held_out"] is False
    assert op.scored(make_docs([]), labels).collect() == []
    none = op.scored(docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0}


@pytest.mark.parametrize("clause, found", [
    ("c'est l'idiot", {"plain": 2.0}), ("c'est l\u2019idiot", {"plain": 2.0}), ("d'idiot", {"plain": 2.0}), ("qu'idiot", {"plain": 2.0}),
    ("'idiot'", {"plain": 2.0}), ("\u2018idiot\u2019 \u201cmoron\u201d", {"plain": 5.0}), ("\u00a1idiot", {"plain": 2.0}),
    ("\u00abidiot\u00bb", {"plain": 2.0}), ("so\u2013idiot\u2026", {"plain": 2.0}), ("that isn't an idiot", {"negated": 2.0}),
    ("that isn\u2019t an idiot", {"negated": 2.0}), ("tu es l'idiot", {"targeted": 2.0}), ("l'idiotie", {})])
def test_words_are_cut_as_they_were_learned(clause, found):
    """Signs and elisions beside a learned word do not hide it, in the grammar and in the search for its clause."""
    import pyarrow as pa

    assert features(clause) == found
    row = op.text_features(op.Lexicon({"idiot": 2.0, "moro*": 3.0}), pa.array(["first. " + clause.upper()]))[0]
    assert dict(zip(op.KINDS, row)) == dict.fromkeys(op.KINDS, 0.0) | found
