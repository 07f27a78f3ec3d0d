"""The smallest given tables, read by DuckDB."""

import duckdb

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def table(name: str, columns: str, sf: str = SF_SMALL) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()
