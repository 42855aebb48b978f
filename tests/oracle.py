"""Compare a Spark result with the same query's SQL in DuckDB, by value."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def text(v) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, row)) for row in df.itertuples(index=False))


def same(spark_df, con, sql: str) -> None:
    ours, theirs = spark_df.toPandas(), con.execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = plain(ours), plain(theirs)
    assert len(a) == len(b)
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not wrong, wrong[:2]
