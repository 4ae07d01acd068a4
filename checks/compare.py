"""Run queries beside their SQL: ``python -m checks.compare SF_DIR [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks import oracle, registry  # noqa: E402
from checks.session import local_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(frame: pd.DataFrame) -> list[tuple]:
    rows = []
    for row in frame[sorted(frame.columns)].itertuples(index=False):
        rows.append(tuple("~" if pd.isna(v) else str(v) for v in row))
    return sorted(rows)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What is wrong, or ``None`` when both hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    for c in got.columns:
        if got[c].dtype.kind in "iuf" and want[c].dtype.kind in "iuf":
            got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
        if got[c].dtype.kind == "M":
            got[c], want[c] = (
                got[c].astype("datetime64[us]"),
                pd.to_datetime(want[c]).astype("datetime64[us]"),
            )
    a, b = _normal(got), _normal(want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, sql = local_session(), duck(sf_dir), oracle.queries()
    failed = 0
    for name in names or registry.QUERIES:
        start = time.time()
        got = registry.QUERIES[name](spark, sf_dir).toPandas()
        spent = time.time() - start
        if name in sql:
            wrong = differences(got, con.execute(sql[name]).df())
            verdict = f"FAIL {wrong}" if wrong else "ok"
        else:
            verdict = "rows only" if len(got) else "FAIL no rows"
        failed += verdict.startswith("FAIL")
        print(f"{name:32} {len(got):8} rows {spent:6.2f}s  {verdict}", flush=True)
    for name in sorted(set(sql) - set(registry.QUERIES)):
        print(f"{name}: SQL without a query")
        failed += 1
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
