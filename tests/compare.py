"""Run registered queries next to their SQL twins and report differences."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        return repr(0.0 if number == 0 else number)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", seconds, len(got)
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", seconds, len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return (f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None), seconds, len(got)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from gridloom.plans.catalog import QUERIES
    from gridloom.plans.oracles import ORACLES as TABLE_ORACLES
    from gridloom.plans.tree_queries import TREE_ORACLES
    from gridloom.session import build_session

    ORACLES = {**TABLE_ORACLES, **TREE_ORACLES}
    sf = sys.argv[1]
    only = sys.argv[2:] or list(QUERIES)
    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    for query_name in only:
        try:
            if query_name in ORACLES:
                problem, took, n = compare(session, connection, query_name, QUERIES[query_name], ORACLES[query_name], sf)
            else:
                began = time.time()
                n = len(QUERIES[query_name](session, sf).collect())
                problem, took = None, time.time() - began
        except Exception as err:  # noqa: BLE001
            problem, took, n = f"{type(err).__name__}: {str(err)[:600]}", 0.0, -1
        print(f"{'ok  ' if problem is None else 'FAIL'} {query_name:26s} {took:7.2f}s {n:8d} rows {'' if query_name in ORACLES else '(no sql)'} {problem or ''}", flush=True)
    session.stop()
