"""Run registered queries and their SQL twins side by side and report differences.

    python tests/oracle_check.py <sf_dir> [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return repr(float(value) + 0.0)
    return str(value)


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows) if all(
        None not in [r[i] for i in order] for r in rows
    ) else sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf: str, fn, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    frame = fn(spark, sf)
    mine = frame.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    a, b = normal_rows(frame.columns, mine), normal_rows(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. spark={bad[0][0]} sql={bad[0][1]}"
    return None


def types_of(spark, con, sf, fn, sql):
    result = con.execute(sql)
    return {d[0]: str(d[1]) for d in result.description}, dict(fn(spark, sf).dtypes)


def main() -> int:
    import __spark_entry__ as entry
    from weirgate.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in wanted or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf, queries[name], oracles[name])
                kind = "sql "
            else:
                rows = queries[name](spark, sf).count()
                problem, kind = None, f"rows={rows} "
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, kind = f"{type(error).__name__}: {str(error)[:700]}", "error "
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {kind}{name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main() and 1)
