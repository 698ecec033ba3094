"""Every query against its SQL twin, and no join that pairs everything with everything."""

import pytest
from compare import connect, difference

from ledgertone.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf_dir, con):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert difference(result, con, ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_csv_files_grow_with_the_partitions(spark, sf_dir, monkeypatch):
    """Each shape is written by as many tasks as it has partitions, and the records stay the same."""
    from pathlib import Path

    from ledgertone.plans.catalog import sources

    roots, scratch = [], sources.scratch_path
    monkeypatch.setattr(sources, "scratch_path", lambda *a: roots.append(scratch(*a)) or roots[-1])
    rows = sources.union_csv_files(spark, sf_dir).count()
    parts = [frame.rdd.getNumPartitions() for frame, _ in sources.I.source_shapes(spark, sf_dir)]
    assert min(parts) > 2 and rows == sources.I.raw_records(spark, sf_dir).count()
    for folder, n in zip(("shape_0", "shape_1", "shape_2", "shape_3", "other"), [*parts, parts[0]]):
        assert len(list(Path(roots[0].removeprefix("file:"), folder).glob("*.csv"))) == n
