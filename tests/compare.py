"""Run queries beside their SQL: python tests/compare.py SF NAME... (no names: all)."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def frame(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = {}
    for c in df.columns:
        v = df[c]
        if v.dtype.kind == "f":
            out[c] = v.map(lambda x: None if pd.isna(x) else int(x) if float(x).is_integer() else round(float(x), 6))
        else:
            out[c] = v.map(lambda x: None if x is None or x is pd.NaT or (isinstance(x, float) and x != x) else x)
    return pd.DataFrame({c: pd.Series(v).map(lambda x: "~" if x is None or x != x else str(x)) for c, v in out.items()}).sort_values(list(df.columns)).reset_index(drop=True)


def duck(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def edge_tables(src: str, dst, kind: str) -> str:
    """Copies of the tables without rows (``empty``), or with a few rows that are NULL throughout (``nulls``)."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for p in Path(src).glob("*.parquet"):
        t = pq.read_table(p)
        t = t.slice(0, 0) if kind == "empty" else pa.table({f.name: pa.nulls(3, f.type) for f in t.schema}, schema=t.schema)
        pq.write_table(t, Path(dst) / p.name)
    return str(dst)


def differences(spark, con, sf_dir: str, query, sql: str | None) -> tuple[str, float, float]:
    t = time.time()
    got = query(spark, sf_dir).toPandas()
    took, t = time.time() - t, time.time()
    if sql is None:
        return f"no SQL; {len(got)} rows", took, 0
    want = con.execute(sql).fetch_df() if hasattr(con.execute("select 1"), "fetch_df") else con.sql(sql).df()
    other = time.time() - t
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} {sorted(want.columns)}", took, other
    a, b = frame(got), frame(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} {len(b)}", took, other
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        return f"VALUES differ in {int(bad.sum())} of {len(a)}:\n{a[bad].head(4).to_string()}\n{b[bad].head(4).to_string()}", took, other
    return f"ok {len(a)}", took, other


if __name__ == "__main__":
    import __spark_entry__ as e
    from strandloom.session import local_session

    sf = f"/root/testdata/{sys.argv[1]}"
    spark, con = local_session(8), duck(sf)
    queries, sql = e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or queries:
        try:
            said, a, b = differences(spark, con, sf, queries[name], sql.get(name))
        except Exception as x:  # noqa: BLE001
            said, a, b = f"ERROR {str(x)[:1500]}", 0, 0
        print(f"{name}: {said} ({a:.1f} s, SQL {b:.1f} s)", flush=True)
