"""Every query of the reference operators against its SQL."""

import duckdb
import pytest

from quarrymill.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels conversations events pages benchmark".split()


def rows(found):
    return sorted(repr(tuple(r)) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.select(columns).collect()) == rows(want.fetchall())


def test_required_columns(spark):
    from quarrymill.operators import tables

    with pytest.raises(ValueError, match="image"):
        tables.require_columns(spark.range(1), "image")
