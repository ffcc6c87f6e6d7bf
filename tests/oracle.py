"""Run registered queries next to their SQL in DuckDB and compare types and values."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "float": "float", "double": "float",
    "string": "text", "varchar": "text", "boolean": "bool", "timestamp": "time", "timestamp_ntz": "time",
}


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str, query, sql: str | None) -> str | None:
    """A description of the first difference, or nothing."""
    df = query(spark, folder)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if mine else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    types = dict(con.execute(f"select column_name, column_type from (describe {sql})").fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    for c, t in df.dtypes:
        other = types[c].lower()
        if KINDS.get(t, t) != KINDS.get(other, other):
            return f"type of {c}: {t} against {other}"
        if {t, other} == {"int", "bigint"} or (t == "bigint") != (other == "bigint"):
            return f"width of {c}: {t} against {other}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    a, b = _sorted(mine, df.columns), _sorted(theirs, columns)
    for x, y in zip(a, b):
        if x != y:
            return f"{str(x)[:300]} against {str(y)[:300]}"
    return None


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry

    from textgauge.session import local_session

    spark, con = local_session(), duck(folder)
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, query, oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(queries)} queries, {len(oracles)} with SQL, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) > 0)
