"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from compared import DATA, same
from geoloom import plans

QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    same(QUERIES[name](spark, DATA), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.count() >= 0 and len(df.schema) > 0


def test_no_nested_loop_in_the_spatial_join(spark):
    plan = QUERIES["pip_code_zone"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_box_filter_reaches_the_scan(spark, tmp_path):
    from geoloom.operators import features as FE

    spark.sql("SELECT id, id % 50 AS minx, id % 40 AS miny, id % 50 AS maxx, id % 40 AS maxy FROM range(1000)").write.parquet(str(tmp_path / "f"))
    plan = FE.filtered(spark.read.parquet(str(tmp_path / "f")), (1, 1, 5, 5))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "LessThanOrEqual(minx" in plan
