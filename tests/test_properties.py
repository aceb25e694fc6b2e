"""Properties of the catalogue chain and the functions."""

import json
import math
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from sheetwright.constants import CATALOGUE_ORDER, COL_CNT, COL_CNT_PK, LEVELS
from sheetwright.functions.jsonfmt import py_float, python_json
from sheetwright.functions.naming import camel_case, slugify
from sheetwright.operators.catalogue import distinct_collapse, object_rollup, pk_catalogue, pk_entries, pk_view
from sheetwright.operators.records import clean_empties
from sheetwright.plans.mapping import clean_mapping
from sheetwright.sources.fixtures import SHEET_FLAGS, raw_mapping


def _mappings(spark):
    return clean_mapping(raw_mapping(spark, SF_SMALL), SHEET_FLAGS)


def test_rollup_counts_every_row(spark):
    m = _mappings(spark)
    total = object_rollup(m).agg(F.sum(COL_CNT)).first()[0]
    assert total == m.count()


def test_list_sizes_sum_to_pk_count(spark):
    cat = pk_catalogue(_mappings(spark))
    per_obj = cat.groupBy(*LEVELS).agg(
        F.coalesce(F.sum(F.size("cols")), F.lit(0)).alias("n"), F.first(COL_CNT_PK).alias("pk"))
    bad = per_obj.filter(F.greatest(F.col("n"), F.lit(0)) != F.col("pk")).count()
    assert bad == 0


def _hot(spark):
    """One object with a third of all rows."""
    m = _mappings(spark)
    hot = m.withColumn("viewObjectModelTop", F.when(F.col("rowIndex") % 3 == 0, F.lit("HOT"))
                       .otherwise(F.col("viewObjectModelTop")))
    return hot.withColumns({c: F.when(F.col("viewObjectModelTop") == "HOT", F.lit("x")).otherwise(F.col(c))
                            for c in LEVELS[1:]})


def test_lists_are_whole_and_fields_are_the_contract(spark):
    hot = _hot(spark)
    cat = pk_catalogue(hot)
    assert tuple(cat.columns) == CATALOGUE_ORDER
    rows = cat.filter(F.col("viewObjectModelTop") == "HOT").collect()
    assert len({r["databaseTable"] for r in rows}) == len(rows)   # one record per table, however long its list
    n_pk = hot.filter((F.col("viewObjectModelTop") == "HOT") & (F.col("primaryKeyColumn") == 1)).count()
    assert sum(len(r["cols"]) for r in rows) == n_pk
    assert {r["colCntPK"] for r in rows} == {n_pk}


def test_entries_are_the_lists_as_rows(spark):
    """Small buckets: positions are exact all the same."""
    hot = _hot(spark)
    lists = {tuple(r[:5]): list(zip(r["cols"], r["colsDB"])) for r in pk_catalogue(hot).collect() if r["cols"]}
    got = {}
    for r in pk_entries(hot, bucket_width=50).collect():
        got.setdefault(tuple(r[:5]), {})[r["position"]] = (r["viewObjectAttribute"], r["databaseColumn"])
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == lists


def test_lists_of_several_sheets_do_not_interleave(spark):
    row = dict.fromkeys(LEVELS, "o") | {"databaseTable": "T", "primaryKeyColumn": 1}
    rows = [row | {"sheet": s, "rowIndex": i, "viewObjectAttribute": f"{s}{i}", "databaseColumn": "c"}
            for i in range(3) for s in ("a", "b")]
    m = spark.createDataFrame(rows)
    want = ["a0", "a1", "a2", "b0", "b1", "b2"]
    assert pk_catalogue(m).first()["cols"] == want
    entries = {r["position"]: r["viewObjectAttribute"] for r in pk_entries(m, bucket_width=2).collect()}
    assert [entries[i] for i in range(6)] == want


def test_catalogue_reads_the_mappings_once_and_runs_no_job(spark):
    m = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").selectExpr(
        "l_returnflag AS a", "l_linestatus AS databaseTable", "1 AS primaryKeyColumn", "l_orderkey AS rowIndex",
        "'x' AS viewObjectAttribute", "'y' AS databaseColumn")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    cat = pk_catalogue(m, levels=["a"])
    assert set(tracker.getJobIdsForGroup(None)) == before
    cat.collect()  # adaptive execution shares the branches' common part while it runs
    plan = cat._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def test_clean_is_idempotent(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    once = clean_empties(ev)
    twice = clean_empties(once)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_slugify_is_idempotent(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(slugify("text").alias("s"))
    assert docs.filter(slugify("s") != F.col("s")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=20),
                min_size=1, max_size=20))
def test_camel_case_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(camel_case("s")).collect()]
    assert got == [_camel(t) for t in texts]


def _camel(text):
    """The naming rule character by character: a word is a run without other characters; white space but ' ' stays in it."""
    words, word = [], ""
    for ch in text + " ":
        if (ch.isascii() and ch.isalnum()) or (ch.isspace() and ch != " "):
            if ch.isalpha():
                after_letter = word[-1:].isalpha()
                ch = ch.lower() if after_letter or not words else ch.upper()
            word += ch
        elif word:
            words.append(word)
            word = ""
    return "".join(words) or None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=50))
def test_py_float_matches_json_dumps(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "d double")
    got = [r[0] for r in df.select(py_float(F.col("d"))).collect()]
    assert got == [json.dumps(x) for x in xs]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(-2**63, 2**63 - 1), st.text(max_size=15),
                          st.floats(allow_nan=False).filter(math.isfinite), st.booleans(),
                          st.lists(st.text(max_size=4), max_size=3)), min_size=1, max_size=10))
def test_python_json_matches_json_dumps(spark, rows):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("f", T.DoubleType()), T.StructField("b", T.BooleanType()),
                           T.StructField("l", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(python_json(F.struct(*df.columns), schema)).collect()]
    want = [json.dumps(dict(zip(["i", "s", "f", "b", "l"], r))) for r in rows]
    assert got == want


def test_hash_record_equals_python_json_dumps(spark):
    import hashlib

    from sheetwright.functions.hashing import hash_record

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").drop("o_orderdate")  # JSON-native fields
    rows = orders.select("*", hash_record(orders).alias("h")).collect()
    for r in rows:
        d = r.asDict()
        h = d.pop("h")
        assert h == hashlib.sha512(json.dumps(d).encode("utf-8")).hexdigest(), d


def test_pk_view_equals_plain_left_join_with_null_keys(spark):
    """The rewritten PK view equals rollup LEFT JOIN pk-rows ON '=' even when levels are null."""
    rows = [("a", "b", "c", None, "A1", "T", "C1", 1, 1), ("a", "b", "c", None, "A2", "T", "C2", 0, 2),
            ("a", "b", "c", "d", "A3", "T", "C3", 1, 3), ("x", "y", "z", "w", "A4", "T", "C4", 0, 4),
            ("x", "y", "z", "w", "A5", "T", "C5", 1, 5), ("k", "k", "k", "k", "A6", "T", "C6", 0, 6)]
    cols = list(LEVELS) + ["viewObjectAttribute", "databaseTable", "databaseColumn", "primaryKeyColumn", "rowIndex"]
    m = spark.createDataFrame(rows, cols).withColumn("primaryKeyColumn", F.col("primaryKeyColumn").cast("int"))
    m.createOrReplaceTempView("m_nulls")
    lv = ", ".join(LEVELS)
    on = " AND ".join(f"t.{x} = v.{x}" for x in LEVELS)
    brute = spark.sql(f"""
        SELECT t.*, v.viewObjectAttribute, v.databaseTable, v.databaseColumn, v.rowIndex
        FROM (SELECT {lv}, COUNT(*) AS colCnt, CAST(SUM(primaryKeyColumn) AS BIGINT) AS colCntPK
              FROM m_nulls GROUP BY {lv}) t
        LEFT JOIN (SELECT * FROM m_nulls WHERE primaryKeyColumn = 1) v ON {on}""")
    got = pk_view(m)
    assert sorted(map(repr, got.select(*brute.columns).collect())) == sorted(map(repr, brute.collect()))


def test_distinct_collapse_keeps_the_form_of_the_group(spark):
    df = spark.createDataFrame([("g", v) for v in ["b", "a", "c", "a"]] + [("h", "x"), ("h", "x"), ("n", None)], "k string, v string")
    assert {r["k"]: r["v"] for r in distinct_collapse(df, ["k"], "v").collect()} == {"g": '["a","b","c"]', "h": "x", "n": "[]"}


_SLUG_ALPHABET = list("aZ09_-.  \t\n\x0b\x0c\r\x1c\x1f!?#/\\") + ["é", "ﬁ", "№", "½", "ß", "Ω", " ", "　",
                                                               "ǆ", "̈", "😀", "中", "​", "\x85"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(_SLUG_ALPHABET), max_size=16), min_size=1, max_size=40),
       st.booleans())
def test_slugify_matches_python(spark, texts, allow_unicode):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(slugify("s", allow_unicode=allow_unicode)).collect()]
    assert got == [_slug(t, allow_unicode) for t in texts]


def _slug(text, allow_unicode):
    """The slug rule character by character, per part between dots."""
    parts = []
    for part in text.split("."):
        folded = unicodedata.normalize("NFKC" if allow_unicode else "NFKD", part)
        if not allow_unicode:
            folded = "".join(ch for ch in folded if ch.isascii())  # before anything else, so also a space that is not ASCII
        out = ""
        for ch in folded:
            if ch == "-" or ch.isspace():
                out += "" if out.endswith("-") else "-"
            elif ch.isalnum() or ch == "_":
                out += ch
        parts.append(out.strip("-_"))
    return ".".join(parts)


def test_ascii_text_never_reaches_the_fold(spark):
    """The Python fold sees null for ASCII rows."""
    from sheetwright.functions import naming

    plan = spark.range(1).select(slugify(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and "CASE WHEN" in plan[plan.index("_fold_ascii"):]
    assert naming.text_values(spark, slugify, ["plain ascii", None]) == ["plain-ascii", "None"]


def _nested(depth):
    kind = T.StructType([T.StructField("v", T.LongType())])
    for _ in range(depth - 1):
        kind = T.StructType([T.StructField("v", T.LongType()), T.StructField("s", kind), T.StructField("l", T.ArrayType(T.StringType()))])
    return kind


def test_clean_plan_grows_linearly_with_depth(spark):
    sizes = []
    for depth in (3, 6, 12):
        df = spark.createDataFrame([], T.StructType([T.StructField("r", _nested(depth))]))
        sizes.append(len(clean_empties(df)._jdf.queryExecution().analyzed().toString()))
    assert sizes[2] < 14 * sizes[0]


def _py_clean(v):
    """Independent statement of the cleaning rule: drop None, '', 'None', 0 and empty containers, keep bools."""
    def keep(x):
        return isinstance(x, bool) or (bool(x) and x != "None")
    if isinstance(v, dict):
        return {k: c for k, c in ((k, _py_clean(x)) for k, x in v.items()) if keep(c)}
    if isinstance(v, list):
        return [c for c in (_py_clean(x) for x in v) if keep(c)]
    return v


def _drop_nulls(v):
    if isinstance(v, dict):
        return {k: _drop_nulls(x) for k, x in v.items() if x is not None}
    if isinstance(v, list):
        return [_drop_nulls(x) for x in v]
    return v


_small_text = st.sampled_from(["", "None", "x", "y z"])
_record = st.fixed_dictionaries({
    "a": st.one_of(st.none(), st.integers(-2, 2)),
    "s": st.one_of(st.none(), _small_text),
    "b": st.one_of(st.none(), st.booleans()),
    "l": st.one_of(st.none(), st.lists(st.one_of(st.none(), _small_text), max_size=3)),
    "m": st.one_of(st.none(), st.dictionaries(st.sampled_from(["k1", "k2"]), st.one_of(st.none(), st.integers(0, 1)),
                                              max_size=2)),
    "n": st.one_of(st.none(), st.fixed_dictionaries({"x": st.one_of(st.none(), st.integers(0, 1)),
                                                     "y": st.one_of(st.none(), _small_text)})),
})


@settings(max_examples=20, deadline=None)
@given(st.lists(_record, min_size=1, max_size=12))
def test_clean_empties_matches_python_rule(spark, records):
    schema = "a int, s string, b boolean, l array<string>, m map<string,int>, n struct<x:int,y:string>"
    df = spark.createDataFrame([(r["a"], r["s"], r["b"], r["l"], r["m"],
                                 None if r["n"] is None else (r["n"]["x"], r["n"]["y"])) for r in records], schema)
    canon = lambda d: json.dumps(d, sort_keys=True)
    got = sorted((_drop_nulls(r.asDict(recursive=True)) for r in clean_empties(df).collect()), key=canon)
    want = sorted((c for c in (_py_clean(r) for r in records) if c), key=canon)
    assert got == want


def _py_flatten(rec, prefix=""):
    """Independent statement of flattening: nested records join names with '_', text lists join with '>',
    other lists become compact JSON, empty lists become None."""
    out = {}
    for k, v in rec.items():
        name = f"{prefix}_{k}" if prefix else k
        if isinstance(v, dict):
            out.update(_py_flatten(v, name))
        elif isinstance(v, list):
            if not v:
                out[name] = None
            elif all(isinstance(x, str) or x is None for x in v):
                out[name] = ">".join(x for x in v if x is not None)
            else:
                out[name] = json.dumps(v, separators=(",", ":"))
        else:
            out[name] = v
    return out


_flat_record = st.fixed_dictionaries({
    "a": st.one_of(st.none(), st.integers(0, 2)),
    "t": st.one_of(st.none(), st.lists(_small_text, max_size=3)),
    "k": st.one_of(st.none(), st.lists(st.integers(0, 3), max_size=3)),
    "n": st.one_of(st.none(), st.fixed_dictionaries({"x": st.one_of(st.none(), st.integers(0, 1)),
                                                     "d": st.one_of(st.none(), st.fixed_dictionaries(
                                                         {"y": st.one_of(st.none(), _small_text)}))})),
})


@settings(max_examples=20, deadline=None)
@given(st.lists(_flat_record, min_size=1, max_size=12))
def test_flatten_records_matches_python_rule(spark, records):
    from sheetwright.operators.records import flatten_records

    schema = "a int, t array<string>, k array<int>, n struct<x:int, d:struct<y:string>>"
    rows = [(r["a"], r["t"], r["k"],
             None if r["n"] is None else (r["n"]["x"], None if r["n"]["d"] is None else (r["n"]["d"]["y"],)))
            for r in records]
    df = spark.createDataFrame(rows, schema)
    canon = lambda d: json.dumps(d, sort_keys=True)
    got = sorted((_drop_nulls(r.asDict()) for r in flatten_records(df).collect()), key=canon)
    full = lambda r: {**r, "n": r["n"] if r["n"] is not None else {"x": None, "d": {"y": None}}}
    with_d = lambda r: {**r, "n": {**r["n"], "d": r["n"]["d"] if r["n"]["d"] is not None else {"y": None}}}
    want = sorted((c for c in (_py_clean(_py_flatten(with_d(full(r)))) for r in records) if c), key=canon)
    assert got == want


def _hot_over_many_tables(spark):
    """A third of all rows in one object, over many tables; objects with null levels, null tables and null flags."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("o"), F.col("id") % 70)).alias(LEVELS[0]),
        *[F.lit("x").alias(lv) for lv in LEVELS[1:]],
        F.when(F.col("id") % 41 != 0, F.concat(F.lit("T"), F.col("id") % 1200)).alias("databaseTable"),
        F.when(F.col("id") % 13 != 0, (F.col("id") % 4 == 0).cast("int")).alias("primaryKeyColumn"),
        F.col("id").alias("rowIndex"), F.concat(F.lit("a"), "id").alias("viewObjectAttribute"), F.concat(F.lit("c"), "id").alias("databaseColumn"))


def test_hot_object_over_many_tables_equals_python(spark):
    m = _hot_over_many_tables(spark)
    objects, lists = {}, {}
    for r in m.collect():
        key = tuple(r[lv] for lv in LEVELS)
        n, pk = objects.get(key, (0, None))
        flag = r["primaryKeyColumn"]
        objects[key] = (n + 1, pk if flag is None else (pk or 0) + flag)
        if flag == 1 and None not in key:
            lists.setdefault(key, {}).setdefault(r["databaseTable"], []).append((r["rowIndex"], r["viewObjectAttribute"], r["databaseColumn"]))
    want = []
    for key, (n, pk) in objects.items():
        for t, entries in lists.get(key, {None: None}).items():
            want.append((*key, t, n, pk, *([[e[i] for e in sorted(entries)] for i in (1, 2)] if entries else [None, None])))
    got = [tuple(r) for r in pk_catalogue(m).collect()]
    assert sum(r[0] == "HOT" for r in got) > 90
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_lists_move_once_and_never_by_object(spark, tmp_dir):
    """With every join by shuffle: one exchange holds lists, keyed by object and table, and no window or sort does."""
    _hot_over_many_tables(spark).write.parquet(f"{tmp_dir}/m")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cat = pk_catalogue(spark.read.parquet(f"{tmp_dir}/m"))
        cat.collect()
        plan = cat._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum("FileScan" in line for line in plan) == 1
    assert not any("Window" in line for line in plan)
    holding = [line for line in plan if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert sum("hashpartitioning(_key#" in line and "_table#" in line.split("ENSURE")[0] for line in holding) >= 1
    partial = [i for i, line in enumerate(plan) if "partial_collect_list" in line]
    assert len(partial) == 1  # computed once, reused by all branches
    joined = next(i for i, line in enumerate(plan) if "ShuffledHashJoin" in line)
    below = next(i for i in range(joined, len(plan)) if "ObjectHashAggregate" in plan[i])
    assert not any("Exchange" in line or "Sort [" in line for line in plan[joined:below])  # the lists stay where the aggregate put them
