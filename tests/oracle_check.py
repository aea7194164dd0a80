"""Compare registered queries with their SQL: ``python -m tests.oracle_check [name…]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
SF_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


_KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, text: str) -> list[str]:
    """What differs between a Spark result and the SQL's; empty if nothing."""
    result = con.execute(text)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    want = [tuple(map(_plain, row)) for row in result.fetchall()]
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    mine = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if _KINDS.get(mine[name], mine[name]) != kind:
            out.append(f"type of {name}: {mine[name]} != {kind}")
    got = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    got.sort(key=key), want.sort(key=key)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        near = all(
            x == y or (isinstance(x, float) and isinstance(y, float)
                       and math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6))
            for a, b in bad for x, y in zip(a, b)
        )
        out.append(f"{len(bad)} rows differ{' (by rounding)' if near else ''}: {bad[0]}")
    return out


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from caretide.session import build_session

    spark = build_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect()
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in queries:
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = queries[name](spark, SF_DIR)
            if name in oracles:
                found = differences(df, con, oracles[name])
            else:
                rows = df.collect()
                found = [] if rows else ["no rows"]
        except Exception as error:  # report every query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        mark = "ok  " if not found else "FAIL"
        kind = "S" if name in oracles else "R"
        print(f"{mark} {kind} {name} {time.time() - start:.1f}s {'; '.join(found)}", flush=True)
    print(f"{failed} failed of {len(queries)}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
