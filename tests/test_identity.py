from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import identity
from fieldweave.plans import prepare
from fieldweave.sources.tables import WITHOUT_GLOBAL_ID
from tests.conftest import rows

DATA = [("a", 1.5)] * 7 + [("a", None)] * 3 + [(None, None)] * 2 + [("b", 2.0), ("1:a", 2.0), ("", 2.0)]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, "text string, `a.b` double")


@pytest.mark.parametrize("copies", [1, 2, 1000])
def test_each_copy_has_an_identifier_of_its_own(spark, copies):
    got = identity.add_content_ids(frame(spark).repartition(3), "t", copies).collect()
    assert Counter((r.text, r["a.b"]) for r in got) == Counter(DATA)
    assert len({r.GlobalID for r in got}) == len(DATA)
    # Order, tasks and the size of blocks play no part.
    again = identity.add_content_ids(frame(spark, DATA[::-1]), "t").collect()
    assert {r.GlobalID for r in got} == {r.GlobalID for r in again}


def test_another_table_and_more_rows(spark):
    ids = lambda data, name="t": {r.GlobalID for r in identity.add_content_ids(frame(spark, data), name).collect()}
    assert not ids(DATA) & ids(DATA, "u")
    assert ids(DATA) < ids(DATA + [("a", 1.5), ("new", 1.0)])


def test_no_rows_and_no_second_column(spark):
    assert identity.add_content_ids(frame(spark, []), "t").columns == ["text", "a.b", "GlobalID"]
    assert identity.add_content_ids(frame(spark, []), "t").count() == 0
    has = frame(spark).withColumn("globalid", F.lit("g"))
    assert identity.add_content_ids(has, "t") is has


def test_values_never_run_together(spark):
    pairs = [("1", "1:2"), ("11", ":2"), (None, "N"), ("N", None), ("", None), (None, "")]
    texts = spark.createDataFrame(pairs, "x string, y string").select(identity.content(["x", "y"]).alias("c"))
    assert len({r.c for r in texts.collect()}) == len(pairs)


def test_one_row_that_fills_the_table_is_dealt_to_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = identity.add_content_ids(frame(spark, [("hot", 1.0)] * 4000), "t", copies=100)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) > 2 and max(sizes) < 2200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_rows_are_grouped_only_where_their_hash_repeats(spark, tmp_path, monkeypatch):
    grouped = []
    numbered = identity._numbered_copies
    monkeypatch.setattr(identity, "_numbered_copies", lambda rows, *others: grouped.append(rows) or numbered(rows, *others))
    data = [(f"alone-{n}", float(n)) for n in range(3000)] + [("twice", 1.0)] * 2 + [(None, None)] * 3
    got = identity.add_content_ids(frame(spark, data), "t").collect()
    assert Counter((r.text, r["a.b"]) for r in got) == Counter(data) and len({r.GlobalID for r in got}) == len(data)
    assert {("twice", 1.0), (None, None)} <= {tuple(r) for r in grouped[0].distinct().collect()}
    assert grouped[0].count() < 100
    whole = numbered(frame(spark, data), "t", [F.col("text"), F.col("`a.b`")], 10).collect()
    assert {r.GlobalID for r in got} == {r.GlobalID for r in whole}


def test_all_tables_get_identifiers(spark, tables, tmp_path):
    prepare.migrate(tables, str(tmp_path / "one"))
    prepare.migrate(tables, str(tmp_path / "two"))
    for name in WITHOUT_GLOBAL_ID:
        one, two = (spark.read.parquet(str(tmp_path / folder / name)) for folder in ("one", "two"))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
        assert one.count() == one.select("GlobalID").distinct().count() == tables[name].count()
