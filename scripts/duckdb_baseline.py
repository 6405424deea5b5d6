"""Time the oracle SQL of the headline queries in DuckDB, as a single-node yardstick for ``bench.py``.

Usage: python scripts/duckdb_baseline.py [sf_dir] [threads]
Prints a Markdown table (best of three runs, all rows fetched).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from airshed import catalog  # noqa: E402
from bench import HEADLINE  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    catalog.load_all()
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in ("events", "region", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    print("| query | rows | DuckDB s |\n| --- | --- | --- |")
    total = 0.0
    for name in HEADLINE:
        best, rows = float("inf"), 0
        for _ in range(3):
            began = time.perf_counter()
            rows = con.execute(catalog.ORACLE[name]).to_arrow_table().num_rows
            best = min(best, time.perf_counter() - began)
        total += best
        print(f"| {name} | {rows:,} | {best:.2f} |")
    print(f"| all {len(HEADLINE)} | | {total:.2f} |")


if __name__ == "__main__":
    main()
