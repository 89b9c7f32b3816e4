"""A sample of registered queries against their DuckDB oracle at sf0.001
(the full set runs with tools/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as entry
from foldline.sources.tables import TABLES
from tools.oracle_check import _digest

SAMPLE = ["fill_group_median", "clean_data", "recipe_chain", "target_encode_oof", "kfold_balanced",
          "skew_apply", "preprocess_linear", "one_hot", "ridge_oof", "metric_table",
          "submission_frame", "tune_grid"]


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_query_has_a_callable_and_sql_names_match():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 75
