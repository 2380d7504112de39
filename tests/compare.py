"""Run a query and its SQL counterpart and compare names, types, counts and values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SAME_TYPE = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.sql(f"create view {name} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if not isinstance(v, float) else round(v, 9)) for v in row)


def _equal(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return type(a) is type(b) and a == b


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} against {sorted(relation.columns)}"]
    theirs_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    out = [
        f"type of {f.name}: {f.dataType.simpleString()} against {theirs_types[f.name]}"
        for f in spark_df.schema.fields
        if SAME_TYPE.get(f.dataType.simpleString()) != theirs_types[f.name]
    ]
    ours = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=_key)
    order = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"select {order} from ({sql}) q").fetchall(), key=_key)
    if len(ours) != len(theirs):
        out.append(f"{len(ours)} rows against {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if not all(map(_equal, a, b))]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {names} {str(bad[0][0])[:700]} AGAINST {str(bad[0][1])[:700]}")
    return out
