"""Every query with SQL gives the rows that DuckDB gives."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from lodestone import catalog

DATA = Path("/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return float(v) if type(v).__name__ == "Decimal" else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, str(DATA))
    got = rows(df.columns, df.collect())
    assert got
    if name in catalog.oracles():
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        cur = con.execute(catalog.oracles()[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = rows(names, cur.fetchall())
        assert len(got) == len(want)
        assert got == want
