"""Every registered query of the engine's own operators against DuckDB at the smallest scale."""

import glob
import os

import duckdb
import pytest

from sluice import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"create view {os.path.basename(path).split('.')[0]} as select * from '{source}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    ours = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in frame.collect())
    if name not in SQL:
        assert ours
        return
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == columns
    theirs = [dict(zip(found.columns, r)) for r in found.fetchall()]
    assert ours == sorted(repr(tuple(plain(r[c]) for c in columns)) for r in theirs)


def test_plans_have_no_nested_loops(spark):
    for name in ("or_join_union", "reconcile_prefix", "semi_either_path", "anti_unfinished"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["optional_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,de)" in plan and "text" not in plan.split("ReadSchema")[1].split("\n")[0]
