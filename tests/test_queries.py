"""Every library query that has SQL against DuckDB, on the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from quillstream.plans.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return str(round(float(v), 6)) if isinstance(v, (float, Decimal)) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(tuple(plain(v) for v in r) for r in got.select(columns).collect())
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())
