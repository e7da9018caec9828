import duckdb
import pytest
from test_files import rounded

from satloom.plans.sequences import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_against_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in ("benchmark", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = rounded(con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
    assert want and rounded(tuple(r[c] for c in columns) for r in df.collect()) == want
