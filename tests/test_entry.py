"""The driver contract, and a few bound queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
NAMES = ["e3_rejected_with_reasons_temp", "e6_quality_score", "j1_curated", "w1_rank_best_year", "a14_distribution", "m2_features", "m17_roc_auc", "x9_drift_report"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 150


def test_flagship_query(spark):
    df = contract.entry(spark)
    assert df.columns == ["crop_name", "avg_yield_hg_ha", "n_observations"] and df.count() == 5


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got = contract.queries()[name](spark, FOLDER)
    want = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert rows == sorted((tuple(r) for r in want.fetchall()), key=repr)
