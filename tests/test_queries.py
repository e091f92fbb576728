"""Every query whose name isn't one of a training-data problem, against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import canonical

CORE = sorted(k for k in entry.queries() if not k.startswith("p") or not k[1].isdigit() or k.startswith("p1_"))


@pytest.fixture(scope="session")
def con(small):
    c = duckdb.connect()
    for p in glob.glob(f"{small}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_same_as_sql(spark, small, con, name):
    got = entry.queries()[name](spark, small).toPandas()
    if (sql := entry.oracle_sql().get(name)) is None:
        return
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_no_cartesian_products(spark, small):
    for name in ("reject_reason_counts", "cell_matrix", "jaccard_pairs", "best_synonym", "apply_topic_map", "seed_rank_pairs"):
        plan = entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin Inner" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Cross", "")
