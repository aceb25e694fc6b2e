"""Time the SQL twin of every registered query on single-node DuckDB (a comparison point for bench.py).

Usage: python scripts/single_node_baseline.py [sf_dir] [threads]
Prints one JSON line shaped like bench.py's output.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from scripts.oracle_check import TABLES  # noqa: E402
from sheetwright.plans.oracles import ORACLES  # noqa: E402


def main() -> None:
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    for name, sql in ORACLES.items():
        con.sql(sql).fetchall()  # warm
        t0 = time.perf_counter()
        con.execute(f"CREATE OR REPLACE TEMP TABLE _bench_out AS {sql}")
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "duckdb_sql_twin_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1], "threads": threads}))


if __name__ == "__main__":
    main()
