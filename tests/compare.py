"""Compare a Spark frame with a DuckDB query: column names, types and the multiset of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when both agree exactly, else what differs."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    expected = relation.fetchall()
    mine = sorted(df.columns)
    if mine != sorted(names):
        return f"columns {sorted(set(mine) ^ set(names))}"
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    got = Counter(tuple(r) for r in df.select(*mine).collect())
    order = [names.index(c) for c in mine]
    want = Counter(tuple(r[i] for i in order) for r in expected)
    if got == want:
        return None
    return f"{sum(got.values())} rows against {sum(want.values())}; only here {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
