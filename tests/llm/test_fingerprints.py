import hashlib
import re

import pytest
from odd import SF
from pyspark.sql import functions as F

from sheetwright.llm import fingerprints as op


def winnow(hashes, w=op.W):
    """Winnowing by its definition: (position) of the smallest hash of each window, the rightmost of equal ones."""
    if not hashes:
        return []
    picked = []
    for i in range(max(1, len(hashes) - w + 1)):
        window = hashes[i : i + w]
        low = min(h >> 32 for h in window)
        at = i + max(j for j, h in enumerate(window) if h >> 32 == low)
        if at not in picked:
            picked.append(at)
    return picked


def test_selection_is_the_rightmost_minimum_of_each_window(spark, make_docs, odd_rows, documents):
    docs = [(d, t) for d, t, *_ in odd_rows + documents[:200]] + [(999, "a b " * 40), (998, "x " * 50)]
    rows = make_docs(docs).select("text", op.gram_hashes(F.coalesce("text", F.lit(""))).alias("g"), op.winnowed(F.col("text")).alias("p"))
    for r in rows.collect():
        units = re.findall(r"[^ \t\n\x0b\f\r]{1,8}", r["text"] or "")
        assert len(r["g"]) == (max(1, len(units) - op.K + 1) if units else 0)
        assert [(p["pos"], p["hash"]) for p in r["p"]] == [(i, r["g"][i]) for i in winnow(r["g"])]


def test_shared_run_shares_a_hash(spark, make_docs):
    """A run of K + W - 1 units common to two texts is always detected."""
    run = " ".join(f"u{i}" for i in range(op.K + op.W - 1))
    a, b = make_docs([(1, f"left words before {run} right"), (2, f"{run} quite other words after the run")]).select(
        op.winnowed(F.col("text")).alias("p")).collect()
    assert {p["hash"] for p in a["p"]} & {p["hash"] for p in b["p"]}


def edited(docs):
    """(doc_id, edited text, next text) by the contract; docs sorted by id."""
    for i, (d, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1] or ""
        text = text or ""
        q = len(text) // 4
        yield d, text[: len(text) - q] + after[:q], after


def check(got, docs):
    got = {r["doc_id"]: r for r in got}
    assert len(got) == len(docs)
    text_of, prints = {}, {}
    for (d, text), (_, changed, after) in zip(docs, edited(docs)):
        r = got[d]
        assert r["n_chars"] == len(text or "")
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        for t, p in ((text or "", r["fingerprint"]), (changed, r["edited_fingerprint"])):
            assert prints.setdefault(t, p) == p
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"])
        if changed == (text or ""):
            assert r["near_edited"] == 1
        if after == (text or ""):
            assert r["near_next"] == 1
        text_of[d] = text
    for (d, _), (after, _) in zip(docs, [*docs[1:], docs[0]]):
        assert got[d]["near_next"] == likeness(got[d]["fingerprint"], got[after]["fingerprint"])
    return got


def pairs(written):
    """(hash, position) pairs of a fingerprint as it is written, by reading."""
    return [[(h, int(pos)) for h, _, pos in (x.partition(":") for x in part.split(",") if x)] for part in written.split(";")]


def likeness(a, b):
    """Share of hashes that two written fingerprints have in common."""
    a, b = ({h for part in pairs(x) for h, _ in part} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_the_written_fingerprint_has_every_hash_and_position(spark, make_docs, odd_rows):
    docs = make_docs([*odd_rows, (70, "x" * 60 + " some plain words beside a long run " + "yz" * 40), (71, "one two three")])
    rows = docs.select("text", op.winnowed(F.col("text")).alias("units"), op.rolling(F.col("text")).alias("runs"),
                       op.written(op.readings(F.col("text"))).alias("w")).collect()
    for r in rows:
        want = [[(f"{(p['hash'] >> 32) & 0xffffffff:x}", p["pos"]) for p in r[c]] for c in ("units", "runs")]
        assert pairs(r["w"]) == want[: 2 if want[1] else 1]
    assert any(";" in r["w"] for r in rows) and any(r["w"] == "" for r in rows)


@pytest.mark.parametrize("rows", [500, 7])
def test_query_follows_the_definition(spark, documents, rows, monkeypatch):
    from sheetwright.llm.queries import QUERIES

    monkeypatch.setattr(op, "BUCKET_ROWS", rows)
    monkeypatch.setattr(op, "FAN", 8)
    docs = [(d, t) for d, t, *_ in documents]
    got = check(QUERIES["op1_winnowing_fingerprints"](spark, SF).collect(), docs)
    long = [r for r in got.values() if r["n_chars"] > 1000]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5
    assert sorted(r["near_next"] for r in long)[len(long) // 2] < 0.05


def test_odd_rows(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 3)
    docs = [(d, t) for d, t, *_ in odd_rows]
    wide = make_docs(odd_rows).selectExpr("*", "1 AS _bucket", "2 AS prints", "3 AS next_text", "4 AS _order", "5 AS sketch")
    check(op.fingerprinted(wide).collect(), docs)
    assert op.fingerprinted(make_docs([])).collect() == []
    alone = op.fingerprinted(make_docs([(5, "one two three four")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"one two three one ").hexdigest()


def test_null_and_repeated_ids(spark, make_docs, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 1)
    docs = make_docs([(None, "abcdefgh"), (None, None), (4, "same text"), (4, "same text"), (4, "same text"), (9, "other words here")])
    got = op.fingerprinted(docs).collect()
    assert len(got) == 6
    nulls = [r for r in got if r["doc_id"] is None]
    assert {r["edited_sha256"] for r in nulls} == {hashlib.sha256(b"abcdef").hexdigest(), hashlib.sha256(b"").hexdigest()}
    fours = sorted(r["near_next"] for r in got if r["doc_id"] == 4)
    assert fours == [0.0, 1.0, 1.0]
    assert [r["edited_sha256"] for r in got if r["doc_id"] == 9] == [hashlib.sha256(b"other words same").hexdigest()]


def test_main_path_is_native(spark, make_docs):
    plan = op.fingerprinted(make_docs([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def roll(text):
    """Positions of the rolling grams of a text without white space, selected by the definition."""
    return text and [text[i : i + op.RUN] for i in range(len(text) - op.RUN + 1)]


@pytest.mark.parametrize("signs", ["abcdefghijklmnopqrstuvwxyz0123456789+/", "日本語中文字漢仮名交文章検索学習言語模型資料去重複数値計算機科学"])
def test_a_passage_without_spaces_is_found_at_every_offset(spark, make_docs, signs):
    """RUN + RUN_W - 1 shared characters share a selected hash whatever stands before them, in runs without white space."""
    import random

    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choices(signs, k=n))

    passage = noise(op.RUN + op.RUN_W - 1)
    docs = [(i, noise(i) + passage + noise(40)) for i in range(18)] + [(50, noise(200)), (51, "a " + passage + "\U0001F600" + noise(9))]
    got = {r["doc_id"]: {p["hash"] for p in r["p"]} for r in make_docs(docs).select("doc_id", op.fingerprint(F.col("text")).alias("p")).collect()}
    assert all(got[0] & got[i] for i in (*range(18), 51)) and not got[0] & got[50]
    same = [(0, noise(2000))]
    same.append((1, same[0][1][:3] + "#" + same[0][1][3:]))  # one character more, early
    first = op.fingerprinted(make_docs(same)).orderBy("doc_id").first()
    assert first["near_next"] > 0.3


def test_rolling_selection_by_definition(spark, make_docs, odd_rows):
    texts = [t for _, t, *_ in odd_rows if t and len(t) < 5000] + ["x" * 100, "é日" * 40 + " " + "ab" * 30, "y" * op.RUN, "z" * (op.RUN - 1)]
    rows = make_docs(list(enumerate(texts))).select("text", op.rolling_hashes(F.col("text")).alias("g"), op.rolling(F.col("text")).alias("p"))
    for r in rows.collect():
        grams = [x for run in re.findall(r"[^ \t\n\x0b\f\r]+", r["text"]) for x in roll(run)]
        assert len(r["g"]) == len(grams) and len(set(r["g"])) == len(set(grams))
        assert [(p["pos"], p["hash"]) for p in r["p"]] == [(i, r["g"][i]) for i in winnow(r["g"], op.RUN_W)]
