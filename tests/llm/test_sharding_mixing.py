from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from brute import PLAIN_WORD, mixing_targets
from odd import SF

from sheetwright.llm import common, mixing, sharding


def check_shards(got, docs, shards=8):
    """Row law, gapless slots, sizes and checksums; every source spread within one row or so of its share."""
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted(
        ((d if d is not None else -1), len((t or "").encode()) + 1, crc32((t or "").encode())) for d, t, *_ in docs)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_shard_query(spark, documents):
    from sheetwright.llm.queries import QUERIES

    got = QUERIES["op4_stratified_sharding"](spark, SF).collect()
    check_shards(got, documents)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op4_stratified_sharding"](spark, SF).collect()))
    source = {d: s for d, _, _, s in documents}
    whole = Counter(source.values())
    part = Counter((r["shard"], source[r["doc_id"]]) for r in got)
    assert all(abs(part[s, x] - n / 8) <= 2 for x, n in whole.items() for s in range(8))


def test_shards_of_odd_rows(spark, make_docs, odd_rows):
    docs = [*odd_rows, (None, None, None, None), (5, odd_rows[4][1], "b", "en"), *((200 + i, "t", f"only{i}", "en") for i in range(40))]
    check_shards(sharding.sharded(make_docs(docs)).collect(), docs)
    assert sharding.sharded(make_docs([])).collect() == []
    wide = make_docs(docs).selectExpr("*", "1 AS shard", "2 AS _bucket", "3 AS _row", "4 AS _n")
    placed = sharding.sharded_documents(wide)
    assert placed.columns == ["doc_id", "text", "lang", "source", "n_chars", "_bucket", "_row", "_n", "shard", "slot"]
    counts = Counter(r["shard"] for r in placed.collect())
    assert sum(counts.values()) == len(docs) and max(counts.values()) - min(counts.values()) <= 1


def check_mix(got, docs, slack):
    sizes = [len(PLAIN_WORD.findall(t or "")) for _, t, *_ in docs]
    by = Counter()
    for (_, _, source, *_), n in zip(docs, sizes):
        by[source] += n
    want = mixing_targets(by)
    source = {d: s for d, _, s, *_ in docs}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == by[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert sorted(r["size"] for r in got) == sorted(sizes)
    for s in by:
        assert abs(taken[s] - want[s]) <= slack, (s, taken[s], want[s])
    assert abs(sum(want.values()) - 1.5 * sum(sizes)) < 1 or all(abs(want[s] - 2 * by[s]) < 1 for s in by)


def test_mix_query(spark, documents):
    from sheetwright.llm.queries import QUERIES

    got = QUERIES["op5_source_mixing"](spark, SF).collect()
    docs = [(d, t, s) for d, t, _, s in documents]
    check_mix(got, docs, slack=100)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op5_source_mixing"](spark, SF).collect()))


def test_mix_of_odd_rows(spark, make_docs, odd_rows):
    docs = [(d, t, s) for d, t, s, _ in odd_rows]
    check_mix(mixing.mixed(make_docs(docs)).collect(), docs, slack=64)
    assert mixing.mixed(make_docs([])).collect() == []
    assert mixing.mixed(make_docs([(1, None), (2, " ")])).select("taken").collect() == [(0,), (0,)]


def test_mixed_documents_hold_the_words_taken(spark, make_docs, odd_rows):
    odd_rows = [(d, t, s, lang) for d, t, s, lang in odd_rows if d != 6]
    docs = make_docs(odd_rows).selectExpr("*", "1 AS size", "2 AS _start", "'p' AS pieces")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += len(PLAIN_WORD.findall(r["text"]))
    assert words == Counter({r["doc_id"]: r["taken"] for r in mixing.mixed(docs).collect() if r["taken"]})


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_one_to_one(n):
    found = mixing.permuted(np.arange(n), n, 9)
    assert sorted(found.tolist()) == list(range(n))


def test_shards_of_the_mix_agree():
    totals = np.array([700, 2500, 1, 0, 83])
    shards, before = 4, np.zeros(5, np.int64)
    for s in range(shards):
        start, counts = mixing.shard_counts(totals, s, shards, 1024, 3)
        assert (start == before).all() and counts.sum() in (1024, int(totals.sum()) - 3 * 1024)
        before = before + counts
    assert (before == totals).all()


def test_groups_of_shards_share_the_totals_evenly():
    """Beyond one group every group gets its share of each source, exactly; inside a group the draw is as before."""
    totals = np.array([70_000, 250_000, 1, 0, 8_300])
    n = int(totals.sum())
    seen = np.zeros_like(totals)
    shards = -(-n // 64)
    for group in range(-(-shards // 100)):
        before, own = mixing.group_counts(totals, group, 6400)
        assert (before == seen).all() and (own >= 0).all() and own.sum() == min(6400, n - seen.sum())
        assert (np.abs(own - totals * own.sum() / n) <= 1.01).all()
        seen = seen + own
    assert (seen == totals).all()
    before = np.zeros_like(totals)
    for shard in range(0, 250):  # across the border of two groups
        start, counts = mixing.shard_counts(totals, shard, shards, 64, 7, group_shards=100)
        assert (start == before).all() and (counts >= 0).all() and counts.sum() == 64
        before = before + counts


def test_a_mix_past_one_group_reaches_its_totals():
    """Sizes that the sampler cannot take at once: ten thousand million slots, of which any shard is drawn alone."""
    totals = np.array([6_000_000_000, 3_999_999_000, 1000])
    for shard in (0, 524_287, 524_288, 5_000_000, 9_765_624):
        start, counts = mixing.shard_counts(totals, shard, 9_765_625, 1024, 3)
        assert counts.sum() == 1024 and (counts >= 0).all() and start.sum() == shard * 1024
        assert abs(start[0] - 0.6 * shard * 1024) < 1e-5 * totals[0] + 1


def test_ranking_moves_no_text(spark, make_docs, tmp_path):
    """Of the stages' plans one exchange holds the text, and none of their sorts does."""
    path = str(tmp_path / "docs")
    make_docs([(i, f"some words of document {i} " * 9, f"s{i % 3}") for i in range(400)]).write.parquet(path)
    docs = spark.read.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (sharding.sharded_documents(docs), mixing.mixed_documents(docs)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan
            for line in plan.split("\n"):
                if "Sort [" in line or "Window" in line:
                    assert "text#" not in line and "_row#" not in line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sharding.sharded_documents(docs).count() == 400


def test_a_key_of_a_small_side_can_be_salted(spark, monkeypatch):
    from sheetwright.llm import common

    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "1 AS _salt")
    small = df.groupBy("k").count()
    want = sorted(map(tuple, df.join(small, "k").collect()))
    assert sorted(map(tuple, common.attached(df, small, "k").collect())) == want
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 3)
    out = common.attached(df, small, "k")
    assert sorted(map(tuple, out.collect())) == want and out.columns == df.join(small, "k").columns


def test_rows_are_named_by_their_place(spark, make_docs, tmp_path):
    from sheetwright.llm import common

    path = str(tmp_path / "docs")
    make_docs([(i, "same") for i in range(50)]).repartition(4).write.parquet(path)
    for df in (spark.read.parquet(path).selectExpr("doc_id", "text", "1 AS _FILE"), spark.read.parquet(path), make_docs([(1, "a"), (1, "a")]).selectExpr("*", "1 AS `a.b`", "2 AS _metadata")):
        named, place = common.placed(df)
        assert named.columns == [*df.columns, *place] and len(set(c.lower() for c in named.columns)) == len(named.columns)
        first, again = (sorted(map(str, named.collect())) for _ in range(2))
        assert first == again and named.select(*place).distinct().count() == df.count()


def test_the_sources_of_a_mix_start_no_python_workers(spark, make_docs):
    """Rows of Python went through workers of their own, which stayed beside those of the mix."""
    rows = mixing.mix_rows(make_docs([(1, "a b c"), (2, "d")]), 42)
    table = mixing.Mix(rows).table()
    assert "PythonRDD" not in table._jdf.queryExecution().toRdd().toDebugString()
    assert [(r["source_no"], r["source_size"], r["target"]) for r in table.collect()] == [(0, 4, 6.0)]


def test_workers_give_memory_back_after_each_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_TRIM", calls.append, raising=False)
    batch = pa.RecordBatch.from_pylist([{"a": 1}])
    assert list(common.each(iter([batch, batch.slice(0, 0), batch]))) == [batch, batch]
    assert calls == [0, 0, 0]
