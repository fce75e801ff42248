"""The queries against their SQL on the 0.01 tables."""
import pytest

from tallyho.llm.queries import ORACLE, QUERIES
from tools.check_oracle import TABLES, rows_of, spark_type_as_duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert {c: spark_type_as_duck(t) for c, t in df.dtypes} == {d[0]: str(d[1]).replace(" ", "") for d in res.description}
    assert rows_of(df.columns, rows) == rows_of(columns, res.fetchall())
