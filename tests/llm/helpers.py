"""DuckDB views over the test tables for the SQL comparisons."""

import os

import duckdb

LLM_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck_llm(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in LLM_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def sf_copy(spark, tmp_path, **tables) -> str:
    """A folder with the given frames as its tables."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
