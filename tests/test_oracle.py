"""Every query with SQL against that SQL in another engine, as sets of rows with their types' values."""

import math
from pathlib import Path

import duckdb
import pytest

from apportion.plans import catalogue, extras, places  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return round(x, 9) + 0.0 if math.isfinite(x) else str(x)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "no rows"
    if name in catalogue.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        found = con.execute(catalogue.ORACLES[name])
        want = rows_of([c[0] for c in found.description], found.fetchall())
        assert got == want
