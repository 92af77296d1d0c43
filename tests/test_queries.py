import pytest

from compare import rows, twin
from tidemark.plans import catalog

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows_as_sql(spark, name):
    assert rows(catalog.QUERIES[name](spark, SF001).toPandas()) == rows(twin(catalog.SQL[name], SF001))


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[:4] == ["symbol", "source_name", "currency", "metric_ts"] and df.count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_bars_are_one_shuffle(spark):
    plan = catalog.QUERIES["bars_1h"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    # one exchange for the dedupe window by event_id, one for the bars
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan and "Python" not in plan


def test_scan_pushes_down(spark):
    plan = catalog.QUERIES["scan_table"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,50.0)" in plan and "ReadSchema: struct<event_type:string,value:double>" in plan


@pytest.mark.parametrize("name", ["events_parsed", "events_valid", "events_quarantine"])
def test_json_is_parsed_once(spark, name):
    plan = catalog.QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    # the test view is a union of two branches
    assert 1 <= plan.count("from_json") <= 2

