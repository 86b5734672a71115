"""Compare registered queries with their SQL on DuckDB. Run as a script, or from tests.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlake.catalog.queries import ORACLES, QUERIES  # noqa: E402
from fleetlake.catalog.shapes import BASE_TABLES  # noqa: E402

_KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
          "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL; None when they agree."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in ORACLES:
        return None if rows else "no rows"
    expected = con.sql(ORACLES[name])
    if sorted(df.columns) != sorted(expected.columns):
        return f"columns {sorted(df.columns)} != {sorted(expected.columns)}"
    kinds = dict(zip(expected.columns, (str(k) for k in expected.types)))
    wrong = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema
             if _KINDS.get(kinds[f.name], kinds[f.name]) != f.dataType.simpleString()}
    if wrong:
        return f"types {wrong}"
    got, want = _rows(rows, df.columns), _rows(expected.fetchall(), expected.columns)
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows vs {len(want)}\n   {sorted(df.columns)}\n   spark {only_got}\n   sql   {only_want}"
    return None


def main() -> int:
    from conftest import make_session
    spark = make_session()
    sf_dir = sys.argv[1]
    con = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:40s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{failed} of {len(sys.argv[2:] or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
