from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def spark():
    from sheafwork.session import session

    s = session("tests", "local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows_of(df: pd.DataFrame, columns: list[str]) -> list[str]:
    """Rows as sorted text: nulls of all kinds alike, numbers to six digits."""
    plain = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(str(tuple(plain(x) for x in r)) for r in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def same_rows():
    def check(got: pd.DataFrame, want: pd.DataFrame) -> None:
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns
        assert rows_of(got, columns) == rows_of(want, columns)

    return check
