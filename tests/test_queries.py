import duckdb
import pytest

from helioquery import label_queries, roof_queries, run_queries, shape_queries  # noqa: F401  they register queries
from helioquery.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    assert rows and not any(isinstance(v, float) and v != v for r in rows for v in r)
    if name not in ORACLES:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = [got.columns.index(n) for n in names]
    a, b = sorted([tuple(r[i] for i in order) for r in rows], key=str), sorted(want.fetchall(), key=str)
    assert len(a) == len(b)
    differ = [(x, y) for x, y in zip(a, b) if x != y]
    assert not differ, (len(differ), [[p for p in zip(names, x, y) if p[1] != p[2]] for x, y in differ[:4]])
