import glob
import os

import duckdb
import pytest

from keyscout.checks.queries import ORACLE, QUERIES


def test_every_query_but_the_sample_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"sample_rows"} and len(QUERIES) == 77


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, folder, name):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, folder).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    # The engines round halves differently in the fourth digit.
    plain = lambda rows: sorted(repr([round(v, 3) + 0.0 if isinstance(v, float) else v for v in r]) for r in rows)
    assert plain(got[columns].astype(object).values.tolist()) == plain(want[columns].astype(object).values.tolist())
