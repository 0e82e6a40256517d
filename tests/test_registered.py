from __future__ import annotations

import os

import check
import pytest

import __spark_entry__ as entry
from replat.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.registered(), oracles.statements()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables are not here")
    return check.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got, _, diff = check.compare(spark, con, FOLDER, QUERIES[name], SQL[name])
    assert not diff
    assert got > 0


def test_entry(spark, con):
    assert entry.entry(spark).count() == 1


def test_building_a_query_starts_no_job(spark):
    """Plans are built without running anything; work begins when the result is asked for."""
    sc = spark.sparkContext
    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables are not here")
    names = sorted(QUERIES)
    sc.setJobGroup("building", "building queries")
    try:
        for name in names:
            QUERIES[name](spark, FOLDER)
        started = sc.statusTracker().getJobIdsForGroup("building")
        # a Parquet schema is inferred by a job of one task; nothing else may run
        assert all(sc.statusTracker().getJobInfo(j) is None or len(sc.statusTracker().getJobInfo(j).stageIds) == 1 for j in started)
        tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in started for s in sc.statusTracker().getJobInfo(j).stageIds]
        assert all(n <= 1 for n in tasks)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
