"""Rows that meet none of a day's keys stay where they are."""

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import activities as A
from fieldweave.operators import chemicals as C
from fieldweave.operators import joins
from fieldweave.plans import office, sync
from fieldweave.sources.store import Store
from fieldweave.sources.tables import BoundTables
from tests.conftest import rows


@pytest.fixture(params=[15, 26], ids=["one row", "many rows"])
def sieved(request, monkeypatch):
    """Every set of keys gets a sieve, however few they are."""
    monkeypatch.setattr(joins, "SIEVED_FROM", 0)
    monkeypatch.setattr(joins, "SIEVE_BITS", request.param)


def frames(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 700))
        .alias("key"), "id")
    few = spark.range(0, 900, 3).select(F.concat(F.lit("g"), "id").alias("key"), F.col("id").alias("value"))
    return many, few.unionByName(spark.createDataFrame([("hot", -1), (None, -2)], "key string, value long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_are_the_same_with_a_sieve(spark, sieved, how):
    many, few = frames(spark)
    by = joins.sieve(few, "key")
    assert by.rows.count() << joins.ROW_BITS == 1 << by.bits
    assert rows(joins.split_join(many, few, ["key"], how, by)) == rows(many.join(few, "key", how))


def test_a_full_sieve_loses_nothing(spark, sieved):
    """More keys than bits."""
    keys = spark.range(200_000).select(F.concat(F.lit("g"), "id").alias("key"))
    by = joins.sieve(keys, "key")._replace(bits=joins.ROW_BITS)
    small = joins.Sieve(spark.createDataFrame([(0, [-1] * (1 << (joins.ROW_BITS - joins.WORD_BITS)))], "_row int, _words array<long>"), joins.ROW_BITS)
    assert joins.sifted(keys, small, "key").count() == 200_000
    assert by is not None


def test_few_rows_without_a_key_pass(spark, sieved):
    many = spark.range(20_000).select(F.concat(F.lit("a"), "id").alias("key"))
    keys = spark.range(100).select(F.concat(F.lit("b"), "id").alias("key"))
    by = joins.sieve(keys, "key")
    assert joins.sifted(keys, by, "key").count() == 100
    passed = joins.sifted(many, by, "key")
    assert passed.count() < 200
    assert passed.count() + joins.sifted(many, by, "key", passed=False).count() == 20_000


def test_no_sieve_for_few_keys(spark):
    assert joins.sieve(spark.range(10).withColumnRenamed("id", "key"), "key") is None


def test_other_rows_are_not_shuffled(spark, sieved):
    """Of the office rows only those that may have a key of the day are moved."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(20_000).select(F.concat(F.lit("a"), "id").alias("Child_GUID"), F.lit(1).cast("long").alias("ActivityOID"),
                                          F.lit("x").alias("TFM_OP_ACTIVITY_GlobalID"))
        keys = spark.range(100).select(F.concat(F.lit("b"), "id").alias("Child_GUID"), F.lit(2).cast("long").alias("_oid"), F.lit("y").alias("_gid"))
        by = joins.sieve(keys, "Child_GUID")
        done = C.set_activity_keys(many, keys, by)
        assert done.count() == 20_000
        plan = done._jdf.queryExecution().executedPlan()
        assert "BroadcastHashJoin" in plan.toString()
        assert rows(done) == rows(C.set_activity_keys(many, keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_are_the_same_with_sieves(spark, folder, sieved, tmp_path):
    lazy = sync.sync(BoundTables(spark, folder))
    kept = sync.sync(BoundTables(spark, folder), folder=str(tmp_path / "run"))
    assert (tmp_path / "run" / "guid_sieve").exists() and (tmp_path / "run" / "stand_sieve").exists()
    for name in ("activities", "chemicals", "same_chemicals", "changed_chemicals", "overlay"):
        assert rows(getattr(kept, name)) == rows(getattr(lazy, name)), name
    parts = lazy.same_chemicals.unionByName(lazy.changed_chemicals).unionByName(lazy.new_chemicals)
    assert rows(kept.chemicals) == rows(parts)


def test_days_in_a_store_are_the_same_with_sieves(spark, tables, sieved, tmp_path):
    """Chemicals of known GUIDs on the second day, so that office rows are found and replaced."""
    found = {}
    for name, least in (("sieved", 0), ("plain", 10**9)):
        joins.SIEVED_FROM = least
        store = Store(spark, str(tmp_path / name))
        office.create(store, tables, 4)
        office.apply(store, tables, "first")
        more = tables["chem_mobile"].withColumn("OBJECTID", F.col("OBJECTID") + 500).filter("OBJECTID % 2 = 0")
        office.apply(store, {**tables, "chem_mobile": tables["chem_mobile"].unionByName(more)}, "second")
        found[name] = rows(store.table("chem_app"))
    assert found["sieved"] == found["plain"]


def test_overlay_with_a_sieve(spark, sieved):
    activities = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h"), (4, "i"), (5, None)], "OBJECTID long, Parent_GUID string")
    items = spark.createDataFrame([("g",), ("g",), ("h",), (None,)], "Parent_GUID string")
    assert rows(A.overlay_worklist(activities, items, joins.sieve(items, "Parent_GUID"))) == [(1, 2), (2, 2), (3, 1)]


def test_few_buckets_are_written_without_a_shuffle(spark, tables, tmp_path):
    """The plan of the write has no rebalancing step, and all rows arrive in their buckets."""
    store = Store(spark, str(tmp_path / "few"))
    rows_ = spark.range(0, 4000, 1, 4).select(F.concat(F.lit("g"), "id").alias("guid"), "id")
    store.create({"t": (rows_.schema, "guid")}, 4)
    run = store.begin("one")
    run.write("t", rows_)
    run.commit()
    files = list((tmp_path / "few" / "t").rglob("*.parquet"))
    assert len(files) == 16  # one for each task and bucket, as no task has had rows of others
    assert rows(store.table("t")) == rows(rows_)
    wrong = store.rows("t").filter(F.col("bucket") != store.bucket("guid", ["guid", "id"]))
    assert wrong.isEmpty()
