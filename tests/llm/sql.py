"""A query's rows against those of its DuckDB SQL."""

import os
from collections import Counter

import duckdb

from receiptflow.llm.queries import ORACLE_SQL, QUERIES


def equals_sql(spark, name, folder):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    df = QUERIES[name](spark, folder)
    said = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    whole = lambda rows: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert whole(df.collect()) == whole(said)
