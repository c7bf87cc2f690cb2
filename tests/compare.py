"""Compare registered queries with their SQL in DuckDB: names, types, row counts and exact values."""

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
KINDS = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def connect(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
            v = float(v)
            return int(v) if v.is_integer() else v
        return v
    return sorted(columns), sorted(repr([cell(r[i]) for i in order]) for r in rows)


def differences(df, db, sql):
    """A short text on the first difference, empty when both results are the same."""
    found = df.collect()
    got_columns, got = _rows(df.columns, found)
    kinds = {r[0]: r[1] for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    other = [(c, kind, kinds[c]) for c, kind in df.dtypes if c in kinds and KINDS.get(kind) != kinds[c]]
    if other:
        return f"types {other}"
    relation = db.execute(sql)
    want_columns, want = _rows([c[0] for c in relation.description], relation.fetchall())
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"got {a} expected {b}"
    return ""
