import re
from collections import Counter, defaultdict

import duckdb
from odd import SF

from sheetwright.llm import lines as op

PAGES = "page_id bigint, url string, html string"


def brute(pages, ratio=0.5, least=3):
    hosts, cut = [], []
    for _, url, html in pages:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        hosts.append(m[1].lower() if m else None)
        cut.append([x.strip(" ") for x in re.split(r"<[^>]*>|\n", html or "") if x.strip(" ")])
    total, seen = Counter(h for h in hosts if h), defaultdict(Counter)
    for h, own in zip(hosts, cut):
        seen[h].update(set(own))
    out = []
    for (page, *_), h, own in zip(pages, hosts, cut):
        kept = [x for x in own if h is None or total[h] < least or seen[h][x] <= ratio * total[h]]
        out.append((page, h, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_brute_force_and_sql(spark):
    from sheetwright.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    pages = con.sql("SELECT page_id, url, html FROM pages").fetchall()
    got = rows(QUERIES["op2_line_dedup"](spark, SF))
    assert got == brute(pages)
    assert got == sorted(con.sql(ORACLES["op2_line_dedup"]).fetchall(), key=str)
    assert any(r[3] for r in got)


def test_odd_rows(spark):
    page = "<p>menu</p><p>body {}</p> \n footer <br> "
    pages = [*((i, f"http://user@A.example:80/{i}", page.format(i)) for i in range(6)), (6, "http://a.example", None),
             (7, "http://a.example", ""), (8, None, page), (9, "no host", page), (9, "no host", page), (None, "http://b.example/x", page),
             (11, "http://b.example", page), (12, "http://c.example", "<p>menu</p>"), (12, "http://c.example", "<p>menu</p>"),
             (12, "http://c.example", "<p>menu</p><p>menu</p>"), (13, "http://d.example?q", "word " * 50_000)]
    df = spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS host", "2 AS lines", "3 AS keys", "4 AS key")
    got = rows(op.without_boilerplate(df))
    assert got == brute(pages)
    assert rows(op.without_boilerplate(df.limit(0))) == []


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.example", "<p>x</p>")], PAGES)
    plan = op.without_boilerplate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
