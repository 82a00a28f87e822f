"""Run registered queries next to their SQL in DuckDB.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.plans.inputs import TABLES  # noqa: E402

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "double": "double",
    "string": "varchar", "varchar": "varchar", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
    "boolean": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v) if not isinstance(v, float) else f"{v:.6e}") for v in r))


def same(a, b, tolerance: float = 0.0) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= tolerance * max(abs(a), abs(b), 1.0)
    return a == b


def difference(frame, con, sql: str, tolerance: float = 0.0) -> str | None:
    """None when columns, types and rows agree, else what differs first."""
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    theirs = {r[0]: KINDS.get(r[1].lower(), r[1].lower()) for r in con.execute("describe " + sql).fetchall()}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    wrong = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    if wrong:
        return f"types {wrong}"
    cursor = con.execute(sql)
    expected = _rows([c[0] for c in cursor.description], cursor.fetchall())
    got = _rows(frame.columns, frame.collect())
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for a, b in zip(got, expected, strict=True):
        if not all(same(x, y, tolerance) for x, y in zip(a, b, strict=True)):
            return f"values {a} != {b}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sql:
                result = difference(frame, con, sql[name])
                if result and difference(frame, con, sql[name], 1e-9) is None:
                    result = "close, not exact: " + result
            else:
                result = f"no SQL; {frame.count()} rows"
        except Exception as exc:
            result = f"{type(exc).__name__}: {str(exc)[:600]}"
        ok = result is None or result.startswith("no SQL")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print("failing:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
