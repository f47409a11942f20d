"""Compare a Spark result with a DuckDB result, as multisets of rows."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value != value:
        return "<null>"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return names, sorted(tuple(_cell(v) for v in row) for row in zip(*columns, strict=True))


def kinds_of(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}
