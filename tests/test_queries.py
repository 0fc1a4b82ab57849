"""Every core query against its SQL, on the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from corpusloom.plans.oracle import ORACLE
from corpusloom.plans.queries import QUERIES


def canonical(df):
    df = df[sorted(df.columns)]
    return sorted(repr([None if v is None or v != v else round(v, 9) if isinstance(v, float) else v for v in row]) for row in df.itertuples(index=False))


@pytest.fixture(scope="module")
def con(data):
    db = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def test_sql_has_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    got = QUERIES[name](spark, data).toPandas()
    if name in ORACLE:
        assert canonical(got) == canonical(con.execute(ORACLE[name]).fetchdf())
