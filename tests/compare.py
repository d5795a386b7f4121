"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "tinyint": "TINYINT",
}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(t, t)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: spark_type(f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: str(c[1]).upper().replace(" ", "") for c in res.description}
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns_equal": sorted(s_cols) == sorted(d_cols)}
    out["hash_equal"] = out["columns_equal"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    out["type_diff"] = {c: (s_types[c], d_types.get(c)) for c in s_cols if s_types[c] != d_types.get(c)}
    if not out["hash_equal"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        if out["columns_equal"]:
            order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
            d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
            a = sorted("|".join(norm(r[i]) for i in order) for r in s_rows)
            b = sorted("|".join(norm(r[i]) for i in d_order) for r in d_rows)
            sa, sb = set(a), set(b)
            out["only_spark"] = sorted(sa - sb)[:3]
            out["only_oracle"] = sorted(sb - sa)[:3]
    return out
