import pytest

from lake_ingest.operators.keyed import KeyedLog
from tests.conftest import rows


@pytest.fixture
def log(spark, tmp_path, table_name):
    return KeyedLog(spark, table_name, str(tmp_path / "log"), "k string, at bigint, v string", "k", ["at"])


def _add(spark, log, batch, *records):
    log.append(spark.createDataFrame(list(records), "k string, at bigint, v string"), batch)


def test_base_and_deltas_say_the_latest(spark, log):
    assert rows(log.read()) == []
    _add(spark, log, "b1", ("a", 1, "x"), ("b", 1, "x"), ("a", 3, "y"))
    assert rows(log.read()) == [("a", 3, "y"), ("b", 1, "x")] and log.wants_fold()
    log.fold()
    assert rows(log.read()) == [("a", 3, "y"), ("b", 1, "x")] and not log.wants_fold()
    # A late record does not replace a newer one of the base.
    _add(spark, log, "b2", ("a", 2, "late"), ("b", 2, "z"), ("c", 1, "new"))
    assert rows(log.read()) == [("a", 3, "y"), ("b", 2, "z"), ("c", 1, "new")]
    # A batch that is repeated replaces itself.
    _add(spark, log, "b2", ("b", 2, "again"))
    assert rows(log.read()) == [("a", 3, "y"), ("b", 2, "again")]
    before = log.read()
    for i in range(3):
        _add(spark, log, f"c{i}", ("d", i, str(i)))
        log.fold()
        if i == 0:
            # Readers of the old base go on while the new one is in force.
            assert rows(before) == [("a", 3, "y"), ("b", 2, "again")]
    assert rows(log.read()) == [("a", 3, "y"), ("b", 2, "again"), ("d", 2, "2")]


def test_a_fold_that_was_interrupted_is_repeated(spark, log, monkeypatch):
    from lake_ingest.operators import keyed

    _add(spark, log, "b1", ("a", 1, "x"))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        def stop(*_):
            raise RuntimeError("lost")

        patched.setattr(keyed, "write_batch", stop)
        log.fold()
    assert rows(log.read()) == [("a", 1, "x")]
    log.fold()
    assert rows(log.read()) == [("a", 1, "x")]


def test_the_base_is_not_shuffled(spark, log):
    _add(spark, log, "b1", *((f"k{i}", 1, "x") for i in range(100)))
    log.fold()
    _add(spark, log, "b2", ("k1", 2, "y"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = log.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # One exchange for the latest change of each key, whose partitions are the base's buckets.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    exchange = plan.index("Exchange hashpartitioning")
    assert "Bucketed: true" not in plan[exchange : plan.index("FileScan", exchange) + 400]
