"""Every query of the catalog against the SQL that states the same result, at the smallest scale."""

import math
from pathlib import Path

import pytest

from emberflux import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    found = duck.execute(catalog.ORACLE[name])
    kinds = {c[0]: str(c[1]) for c in found.description}
    columns = sorted(df.columns)
    assert columns == sorted(kinds)
    for c, kind in df.dtypes:
        assert TYPES.get(kind, kinds[c]) == kinds[c], c
    at = [list(kinds).index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_without_sql_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
