"""Every query with an oracle gives the same rows as DuckDB on the smallest tables; the others run."""

import math
from pathlib import Path

import duckdb
import pytest

from strandline.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [str([plain(r[c]) for c in columns]) for r in df.collect()]
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [str([plain(r[i]) for i in at]) for r in result.fetchall()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).columns
