"""Every registered query of the library's own operators against its SQL in DuckDB."""

import duckdb
import numpy as np
import pytest

from almoner.plans.analogs import TABLES
from almoner.registry import ORACLES, QUERIES


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(map(plain, v)) + "]"
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(df.columns)
        order = [columns.index(c) for c in df.columns]
        assert sorted("|".join(map(plain, r)) for r in rows) == sorted("|".join(plain(r[i]) for i in order) for r in found.fetchall())


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
