import duckdb
import pytest

from satloom.plans.files import ORACLES, QUERIES
from satloom.plans.views import TABLES

NAMES = sorted({t for t, _ in TABLES.values()} | {"customer", "supplier"})


def rounded(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_against_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = rounded(con.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall())
    assert want and rounded(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and all(ORACLES.values())
