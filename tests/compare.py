"""Compare a Spark result with a DuckDB statement over the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: tuple((v is None, str(v)) for v in row)
    )
