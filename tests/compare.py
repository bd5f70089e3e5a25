"""Run named queries and their SQL side by side: python -m tests.compare [folder] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as entry
from basketlens.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def open_sql(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64").round(9) + 0.0
        else:
            df[c] = df[c].astype("object").where(df[c].notna(), None).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark_result: pd.DataFrame, sql_result: pd.DataFrame) -> str | None:
    if sorted(spark_result.columns) != sorted(sql_result.columns):
        return f"columns {sorted(spark_result.columns)} / {sorted(sql_result.columns)}"
    if len(spark_result) != len(sql_result):
        return f"rows {len(spark_result)} / {len(sql_result)}"
    a, b = normal(spark_result), normal(sql_result)
    unlike = (a != b) & ~(a.isna() & b.isna())
    if unlike.to_numpy().any():
        rows = unlike.any(axis=1)
        return f"{int(rows.sum())} rows differ\n{a[rows].head(5)}\n{b[rows].head(5)}"
    kinds = [(c, str(spark_result[c].dtype), str(sql_result[c].dtype)) for c in spark_result if spark_result[c].dtype != sql_result[c].dtype]
    return f"types {kinds}" if kinds else None


def main(folder: str, names: list[str]) -> int:
    spark = local_session()
    con = open_sql(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in names or queries:
        start = time.time()
        try:
            mine = queries[name](spark, folder).toPandas()
            took = time.time() - start
            start = time.time()
            theirs = con.execute(sql[name]).df()
            wrong = difference(mine, theirs)
        except Exception as error:  # report and go on with the next query
            wrong, took, mine = str(error)[:1500], time.time() - start, []
        failures += wrong is not None
        print(f"{'ok ' if wrong is None else 'BAD'} {name} rows={len(mine)} spark={took:.1f}s sql={time.time() - start:.1f}s", flush=True)
        if wrong:
            print("   ", wrong, flush=True)
    return failures


if __name__ == "__main__":
    given = sys.argv[1:]
    sys.exit(main(given[0] if given else "/root/testdata/sf0.01", given[1:]))
