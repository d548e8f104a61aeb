"""Every query with SQL gives DuckDB's rows."""

import duckdb
import pytest

from minutesmith.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    out = []
    for r in rows:
        out.append(tuple(v.isoformat()[:10] if hasattr(v, "isoformat") else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = catalog.queries()[name](spark, SF)
    got = db.sql(catalog.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(got.columns)
    order = [got.columns.index(c) for c in cols]
    assert plain(map(tuple, df.select(*cols).collect())) == plain(tuple(r[i] for i in order) for r in got.fetchall())
