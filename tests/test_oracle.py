from pathlib import Path

import duckdb
import pytest

from linkgraph.plans import wire  # noqa: F401 - registers its queries
from linkgraph.plans.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLE:
        assert len(got)
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    one, two = (sorted(map(repr, map(tuple, x[cols].astype(object).where(x[cols].notna(), None).values.tolist()))) for x in (got, want))
    assert one == two
