import random
import re
from collections import defaultdict

import pytest
from brute import repeated_bytes
from odd import SF

from sheetwright.llm import suffix_dedup as op

WORD = re.compile("[^\x20\x09-\x0d]+")


BYTES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def rows(df):
    return sorted(map(tuple, df.select(BYTES).collect()), key=str)


def passage_words(docs, size=51):
    """(doc_id, words in windows of ``size`` words that another row has too), by brute force."""
    texts = [WORD.findall(t or "") for _, t, *_ in docs]
    holders = defaultdict(set)
    for i, words in enumerate(texts):
        for a in range(len(words) - size + 1):
            holders[tuple(words[a : a + size])].add(i)
    out = []
    for (doc_id, *_), words in zip(docs, texts):
        hit = set()
        for a in range(len(words) - size + 1):
            if len(holders[tuple(words[a : a + size])]) > 1:
                hit.update(range(a, a + size))
        out.append((doc_id, len(hit), bool(hit)))
    return sorted(out, key=str)


def passages(df):
    return sorted(map(tuple, df.select("doc_id", "n_passage_words", "has_passage").collect()), key=str)


def want(docs, size=400):
    return sorted(repeated_bytes([(d, t) for d, t, *_ in docs], size), key=str)


def test_query_matches_brute_force(spark, documents):
    from sheetwright.llm.queries import QUERIES

    df = QUERIES["op8_suffix_array_dedup"](spark, SF).cache()
    assert df.columns == [*BYTES, "n_passage_words", "has_passage"]
    got = rows(df)
    assert got == want(documents)
    assert passages(df) == passage_words(documents)
    assert any(0 < r[2] < r[1] for r in got)


@pytest.mark.parametrize("q", [2, 3, 5, 11])
def test_difference_set_meets_every_distance(q):
    v, cover = op.difference_set(q)
    assert v == q * q + q + 1 and len(cover) == q + 1
    assert {(a - b) % v for a in cover.tolist() for b in cover.tolist()} == set(range(v))


@pytest.mark.parametrize("chunk_bytes", [1 << 21, 3000])
def test_repeats_at_all_shifts(spark, make_docs, chunk_bytes):
    """Repeats of just under, exactly and over the size, at odd shifts, across and within texts, with multi-byte characters."""
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choices("abcdefghij é\n", k=n))

    shared = noise(1500)
    docs = [(i, noise(rng.randint(0, 300)) + shared[s : s + n] + noise(rng.randint(0, 200)))
            for i, (s, n) in enumerate((rng.randint(0, 900), rng.choice([300, 350, 365, 380, 400, 500])) for _ in range(40))]
    docs += [(100, "ab" * 500), (101, "x" * 401), (102, "y" * 400), (103, noise(50) + shared + noise(9) + shared), (104, shared), (105, shared)]
    assert rows(op.deduplicated(make_docs(docs), chunk_bytes=chunk_bytes)) == want(docs)
    assert rows(op.deduplicated(make_docs(docs), size=60, q=5)) == want(docs, 60)


def test_odd_rows(spark, make_docs, odd_rows):
    odd_rows = [d for d in odd_rows if d[0] != 9] + [(9, "x" * 3000, "hot", "en"), (None, None, None, None), (5, odd_rows[4][1], "b", "en")]
    docs = make_docs(odd_rows).selectExpr("*", "1 AS key", "2 AS chunk", "3 AS n_removed", "4 AS kept")
    assert rows(op.deduplicated(docs)) == want(odd_rows)
    assert passages(op.deduplicated(docs)) == passage_words(odd_rows)
    assert rows(op.deduplicated(make_docs([]))) == []
    assert rows(op.deduplicated(make_docs([(1, None), (2, "short")]))) == want([(1, None), (2, "short")])
    kept = {r["key"]: r["kept"] for r in op.spans_removed(docs, with_kept=True).collect()}
    assert b"" in kept.values() and all(k is not None for k in kept.values())


@pytest.mark.parametrize("chunk_bytes", [1 << 21, 2000])
def test_passages_of_short_words(spark, make_docs, chunk_bytes):
    """Passages of 49 to 60 words of one letter or more, few bytes or many, at all places; one that only repeats within its own text."""
    rng = random.Random(8)

    def noise(n):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.choice([1, 5, 9]))) + str(rng.randint(0, 9999)) for _ in range(n))

    shared = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200)]
    docs = []
    for i in range(60):
        n, at = rng.choice([49, 50, 51, 52, 60]), rng.randint(0, 140)
        docs.append((i, f"{noise(rng.randint(0, 40))} {' '.join(shared[at : at + n])}\n{noise(rng.randint(0, 40))}"))
    alone = noise(60)
    docs += [(100, f"{alone} and again {alone}"), (101, noise(51)), (102, " ".join(["z"] * 300)), (103, noise(30))]
    docs += [(200, docs[0][1]), (201, noise(55)), (202, None), (203, "")]
    docs.append((204, docs[-3][1]))  # a copy of 201
    got = op.deduplicated(make_docs(docs), chunk_bytes=chunk_bytes)
    assert passages(got) == passage_words(docs) and any(r[1] for r in passages(got))
    assert rows(got) == want(docs)


def test_texts_with_very_many_copies(spark, make_docs, monkeypatch, tmp_path):
    """A third of all rows one text, spread over all tasks: counted, and its bytes sent once."""
    monkeypatch.setattr(op, "MANY_COPIES", 20)
    hot = " ".join(f"hot{i}" for i in range(90))
    docs = [(i, hot if i % 3 == 0 else f"{hot[:300]} {i} " + " ".join(f"w{i}x{j}" for j in range(80))) for i in range(300)]
    make_docs(docs).repartition(12).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    sent = op.chunked(df, 101, 3).collect()
    entries = [e for r in sent for e in op.unpacked(r["blob"], r["raw"])]
    assert sum(n for _, n, _ in entries) == 300
    texts = [t for _, _, t in entries if t]
    assert texts.count(hot.encode()) == 1 and len(texts) == 201
    got = op.deduplicated(df)
    assert rows(got) == want(docs) and passages(got) == passage_words(docs)
