"""Compare registered queries with their SQL: schema and value multiset."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

from tunelake.registry.inputs import TABLES

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def compare(df, con, sql: str) -> list[str]:
    """Problems found, none when results agree."""
    con.execute(sql)
    duck_cols = [(d[0], str(d[1])) for d in con.description]
    duck_rows = con.fetchall()
    cols = sorted(df.columns)
    problems = []
    if sorted(c for c, _ in duck_cols) != cols:
        return [f"columns: spark {cols} sql {sorted(c for c, _ in duck_cols)}"]
    duck_types = dict(duck_cols)
    for field in df.schema:
        want = SPARK_TO_DUCK.get(field.dataType.simpleString())
        if want != duck_types[field.name]:
            problems.append(
                f"type of {field.name}: spark {field.dataType.simpleString()}"
                f" sql {duck_types[field.name]}")
    pos = {c: i for i, (c, _) in enumerate(duck_cols)}
    want = Counter(tuple(_cell(r[pos[c]]) for c in cols) for r in duck_rows)
    got = Counter(tuple(_cell(r[c]) for c in cols) for r in df.collect())
    if want != got:
        problems.append(
            f"rows: spark {sum(got.values())} sql {sum(want.values())};"
            f" only spark {[str(x)[:400] for x in list((got - want))[:3]]};"
            f" only sql {[str(x)[:400] for x in list((want - got))[:3]]}")
    return problems
