"""Compare a Spark result with the same query in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Oracle:
    """DuckDB with the driver's tables as views."""

    def __init__(self, sf_dir: str) -> None:
        self.connection = duckdb.connect()
        for name in TABLES:
            self.connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )

    def run(self, sql: str) -> pd.DataFrame:
        return self.connection.execute(sql).df()


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name; numbers as floats, stamps as text, missing values alike."""
    out = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        elif pd.api.types.is_numeric_dtype(column):
            column = column.astype("float64") + 0.0
        out[name] = column.astype(object).where(column.notna(), None)
    plain = pd.DataFrame(out)
    order = sorted(range(len(plain)), key=lambda i: [repr(v) for v in plain.iloc[i]])
    return plain.iloc[order].reset_index(drop=True)


def differences(found: pd.DataFrame, wanted: pd.DataFrame) -> str:
    """Empty if both hold the same rows, exactly; otherwise what differs first."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    found, wanted = _plain(found), _plain(wanted)
    same = (found == wanted) | (found.isna() & wanted.isna())
    if same.all(axis=None):
        return ""
    row = (~same).any(axis=1).idxmax()
    return (
        f"{(~same).any(axis=1).sum()} rows differ, first {found.loc[row].to_dict()} != "
        f"{wanted.loc[row].to_dict()}"
    )
