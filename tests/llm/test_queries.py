"""Every corpus query that SQL can express against its SQL, over the whole tables."""

import __spark_entry__ as entry
import pytest

from checks.compare import compare, connect
from fieldweave.llm.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, folder, name):
    assert compare(entry.queries()[name](spark, folder), connect(folder), SQL[name]) is None


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
