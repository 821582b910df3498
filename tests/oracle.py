"""Compare a query with its SQL on one folder of tables."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    if value is None or (not isinstance(value, (list, dict)) and pd.isna(value)):
        return "None"
    return repr(round(float(value), 6)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, r)) for r in frame[columns].itertuples(index=False))


def expected(sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con.sql(sql).df()


def check(query, sql, spark, folder):
    got, want = rows(query(spark, folder).toPandas()), rows(expected(sql, folder))
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
