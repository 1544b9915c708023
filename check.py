"""Compare the registered queries with their SQL in DuckDB: ``python check.py <sf dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

from siltline.catalog import REGISTRY
from siltline.catalog.base import TABLES
from siltline.session import local_session

KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return (0.0 + v,)
    return (v,)


def _sorted(rows):
    return sorted([tuple(_cell(v) for v in r) for r in rows], key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def differences(df, con, name: str) -> list[str]:
    """What is different between the frame of a query and its SQL; empty when they agree."""
    entry, found = REGISTRY[name], []
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    if entry.sql is None:
        return []
    cur = con.execute(entry.sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    order = [d[0] for d in cur.description]
    if sorted(order) != columns:
        return [f"columns {columns} and {sorted(order)}"]
    expected = [tuple(r[order.index(c)] for c in columns) for r in cur.fetchall()]
    for field in df.schema.fields:
        kind = KINDS.get(field.dataType.simpleString())
        if types[field.name] != kind:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} and {types[field.name]}")
    if len(rows) != len(expected):
        found.append(f"rows: {len(rows)} and {len(expected)}")
    ours, theirs = _sorted(rows), _sorted(expected)
    if ours != theirs:
        a, b = set(ours), set(theirs)
        found.append(f"only in query: {sorted(a - b, key=repr)[:3]}; only in SQL: {sorted(b - a, key=repr)[:3]}")
    if not rows:
        found.append("no rows")
    return found


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark, con, bad = local_session(8), connect(sys.argv[1]), 0
    for name in names:
        start = time.time()
        try:
            found = differences(REGISTRY[name].run(spark, sf_dir), con, name)
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:900]}"]
            if len(names) == 1:
                traceback.print_exc()
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.2f}s", *found, sep="\n      " if found else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
