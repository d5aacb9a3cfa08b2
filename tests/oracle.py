"""Compare a Spark result with a DuckDB oracle the way the driver does:
columns sorted by name, rows order-insensitive, doubles rounded."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type names -> DuckDB type names, for the schema check
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
          "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE"}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type(spark_type[6:-1]) + "[]"
    return _TYPES.get(spark_type, spark_type.upper())


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (v if digits is None else round(v, digits)) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    return v


def canon(columns, rows, digits=6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return cols, sorted(out, key=repr)


def compare(spark_df, con, sql, digits=6, types=False):
    """``digits=None`` compares doubles exactly; ``types=True`` also checks
    that every column has the DuckDB type matching its Spark type."""
    srows = [tuple(r) for r in spark_df.collect()]
    scols, srows = canon(spark_df.columns, srows, digits)
    res = con.execute(sql)
    dcols_raw = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    dcols, drows = canon(dcols_raw, res.fetchall(), digits)
    problems = []
    if scols != dcols:
        problems.append(f"columns differ: spark={scols} duckdb={dcols}")
    elif types:
        bad = {c: (duck_type(t), dtypes[c]) for c, t in spark_df.dtypes if duck_type(t) != dtypes[c]}
        if bad:
            problems.append(f"types differ (spark, duckdb): {bad}")
    if len(srows) != len(drows):
        problems.append(f"row count differs: spark={len(srows)} duckdb={len(drows)}")
    elif srows != drows:
        bad = [(a, b) for a, b in zip(srows, drows) if a != b]
        problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} duckdb={bad[0][1]}")
    return problems, len(srows)
