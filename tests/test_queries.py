"""Every registered query against its SQL, on the smallest tables that give it rows."""

import functools

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_queries import TABLES, rows_of

SLOW = ("feature_vectors", "regress_shift", "classify_shift", "model_report", "importances",
        "ablation", "forest_table", "scoring_parity", "score_live")


@functools.lru_cache(maxsize=None)
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{tables}/{name}.parquet'")
    return connection


def test_names_match():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", [name for name in queries() if name not in SLOW])
def test_query(spark, sf, name):
    tables = sf
    frame = queries()[name](spark, tables)
    got = rows_of(frame.columns, frame.collect())
    assert got
    if name in oracle_sql():
        result = duck(tables).execute(oracle_sql()[name])
        names = [column[0] for column in result.description]
        assert sorted(names) == sorted(frame.columns)
        assert got == rows_of(names, result.fetchall())
