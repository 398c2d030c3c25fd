"""Compare registered queries with their SQL twins.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(series: pd.Series) -> str:
    return str(series.dtype)


def _whole_numbers_with_gaps(frame: pd.DataFrame) -> pd.DataFrame:
    """Integers with missing values are of one kind on one side and of another on the other side."""
    gaps = [c for c in frame.columns if pd.api.types.is_numeric_dtype(frame[c]) and frame[c].isna().any()]
    return frame.assign(**{c: frame[c].astype(float) for c in gaps})


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.apply(lambda s: s.map(lambda v: "NULL" if v is None or v != v else repr(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """Empty text when equal, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    spark_frame, sql_frame = _whole_numbers_with_gaps(spark_frame), _whole_numbers_with_gaps(sql_frame)
    notes = []
    for c in spark_frame.columns:
        if _kind(spark_frame[c]) != _kind(sql_frame[c]):
            notes.append(f"type of {c}: {_kind(spark_frame[c])} != {_kind(sql_frame[c])}")
    if notes:
        return "; ".join(notes)
    left, right = _canonical(spark_frame), _canonical(sql_frame)
    differs = (left != right).any(axis=1)
    if differs.any():
        i = differs.idxmax()
        cols = [c for c in left.columns if left.at[i, c] != right.at[i, c]]
        return f"{int(differs.sum())} rows differ, first {left.loc[i, cols].to_dict()} != {right.loc[i, cols].to_dict()}"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    from flowsieve.plans import registry
    from flowsieve.session import build_session

    spark = build_session()
    queries, sql = registry.queries(), registry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in sql:
                start = time.time()
                want = con.execute(sql[name]).df()
                note = compare(got, want) or f"ok (sql {time.time() - start:.1f}s)"
            else:
                note = "no sql"
        except Exception as error:  # noqa: BLE001
            took, got, note = time.time() - start, [], f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += not note.startswith(("ok", "no sql"))
        print(f"{name:28s} {took:6.1f}s rows={len(got):6d} {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
