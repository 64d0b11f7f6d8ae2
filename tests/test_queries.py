"""Every registered query against its SQL, over the whole tables."""

import __spark_entry__ as entry
import pytest

from checks.compare import compare, connect
from fieldweave.plans.catalog import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(SQL) <= set(entry.queries())


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    df = entry.queries()[name](spark, folder)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in FORBIDDEN if node in text] == []
    assert compare(df, con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


# Lookup sides too large to broadcast: the same rows must come out of shuffled joins.
SHUFFLED = [
    "dom_chemical", "domain_all", "itemsets", "chem_defaults", "append_with_oids", "act_stand_enrich", "overlay_worklist",
    "sync_chemicals", "rel_migrate_globalid", "rel_orphans", "decode_property_domain", "domain_violations", "form_match",
    "subtype_unknown",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_without_broadcast(spark, con, folder, name):
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for setting in settings:
        spark.conf.set(setting, "-1")
    try:
        assert compare(entry.queries()[name](spark, folder), con, SQL[name]) is None
    finally:
        for setting in settings:
            spark.conf.unset(setting)
