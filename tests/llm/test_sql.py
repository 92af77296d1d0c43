import pytest

from compare import rows, twin
from tidemark.llm.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(twin(SQL[name], sf))
