import duckdb
import pytest

from grainmill.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    result = connection.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = queries()[name](spark, folder)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(row[names.index(c)] for c in df.columns) for row in result.fetchall()) == sorted(map(tuple, df.collect()))
