"""DuckDB results over small frames, for comparison with an operator's rows."""
import duckdb
import pandas as pd


def duck(sql: str, **tables: pd.DataFrame | object) -> list[tuple]:
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


def rows(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
