import os

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import cascade, lists
from fieldweave.plans import procedures, refresh
from fieldweave.sources import named_files, sinks
from tests.conftest import rows

LAYOUT = "domain_name string, code string, description string"
FIRST = [("a", "1", "x"), ("a", "2", "y"), ("a", "2", "y"), ("b", "1", "x"), ("c", None, None)]


def frame(spark, data):
    return spark.createDataFrame(data, LAYOUT)


def files(folder, name):
    own = f"{folder}/lists/domain_name={name}"
    return sorted(os.listdir(own)) if os.path.isdir(own) else []


def publish(df, folder):
    return sinks.publish_changed(df, f"{folder}/lists", f"{folder}/state")


def published(spark, folder):
    return rows(spark.read.schema(LAYOUT).parquet(f"{folder}/lists"), "domain_name", "code", "description")


def test_only_changed_lists_are_written(spark, tmp_path):
    folder = str(tmp_path)
    assert rows(publish(frame(spark, FIRST), folder)) == [("a", 3), ("b", 1), ("c", 1)]
    before = {name: files(folder, name) for name in "abc"}
    # Another order, then one copy less, another text, a new list; the list that is not sent stays.
    assert rows(publish(frame(spark, FIRST[::-1]).repartition(3), folder)) == []
    assert {name: files(folder, name) for name in "abc"} == before
    second = [("a", "1", "x"), ("a", "2", "y"), ("b", "1", "x"), ("d", "", "")]
    assert rows(publish(frame(spark, second), folder)) == [("a", 2), ("d", 1)]
    assert files(folder, "a") != before["a"] and files(folder, "b") == before["b"] and files(folder, "c") == before["c"]
    assert published(spark, folder) == rows(frame(spark, second + FIRST[-1:]))
    assert rows(publish(frame(spark, second + FIRST[-1:]), folder)) == []


@pytest.mark.parametrize("other", [("a", "2", "Y"), ("a", "2y", ""), ("a", "2", None), ("a", None, "y")])
def test_digests_tell_rows_apart(spark, other):
    base = FIRST[:2] + FIRST[3:]
    one, two = (sinks.list_digests(frame(spark, data)) for data in (base, [base[0], other, *base[2:]]))
    assert rows(one.join(two, one.columns, "left_anti"), "domain_name") == [("a",)]


def test_a_stop_before_the_digests_writes_the_lists_again(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    publish(frame(spark, FIRST), folder)
    second = [("a", "9", "z"), *FIRST[3:]]
    replace = sinks.replace_domains

    def stopping(*args):
        replace(*args)
        raise RuntimeError

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "replace_domains", stopping)
        with pytest.raises(RuntimeError):
            publish(frame(spark, second), folder)
    assert rows(publish(frame(spark, second), folder)) == [("a", 1)]
    assert published(spark, folder) == rows(frame(spark, second))


def test_refresh_twice_keeps_untouched_lists(spark, tables, tmp_path):
    folder = str(tmp_path)
    refresh.publish(tables, tables["property_flags"], tables["forms"], folder)
    own = f"{folder}/domains"
    before = {name: sorted(os.listdir(f"{own}/{name}")) for name in os.listdir(own) if "=" in name}
    changed = {**tables, "supervisor": tables["supervisor"].withColumn(
        "DESCRIPTION", F.when(F.col("PROPERTYOID") == 3, F.lit("other")).otherwise(F.col("DESCRIPTION")))}
    refresh.publish(changed, tables["property_flags"], tables["forms"], folder)
    after = {name: sorted(os.listdir(f"{own}/{name}")) for name in os.listdir(own) if "=" in name}
    assert {name for name in after if after[name] != before[name]} == {"domain_name=3_supervisor"}


def test_files_have_their_names_order_and_quotes(spark, tmp_path):
    folder = str(tmp_path / "media")
    data = [(1, "b", 'say "hi"', 1.5), (1, "a", None, None), (2, "c,d", "ünï", 2.0), (1, "a", "z", 1.0)]
    df = spark.createDataFrame(data, "k int, x string, y string, v double").repartition(3)
    name = F.concat(F.col("k").cast("string"), F.lit("sets.csv"))
    named_files.write_named(df, folder, name, ["x", "y"], hidden=["k"])
    assert sorted(os.listdir(folder)) == ["1sets.csv", "2sets.csv"]
    with open(f"{folder}/1sets.csv", encoding="utf-8") as file:
        assert file.read() == '"x","y","v"\n"a","",""\n"a","z","1.0"\n"b","say ""hi""","1.5"\n'
    # Written again: replaced where the name is the same, the others stay.
    named_files.write_named(df.filter("k = 2").withColumn("x", F.lit("new")), folder, name, hidden=["k"])
    assert rows(named_files.read_lines(spark, folder).filter("file = '2sets.csv'"), "place", "line") == [(0, '"x","y","v"'), (1, '"new","ünï","2.0"')]
    assert sorted(os.listdir(folder)) == ["1sets.csv", "2sets.csv"]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path / "media")
    df = spark.range(40).select(F.col("id").alias("k"), F.when(F.col("id") < 39, "x").otherwise(F.raise_error(F.lit("broken"))).alias("x"))
    with pytest.raises(Exception, match="broken"):
        named_files.write_named(df, folder, F.concat(F.col("k").cast("string"), F.lit(".csv")))
    assert not os.path.isdir(folder) or os.listdir(folder) == []


def test_many_rows_of_one_file(spark, tmp_path):
    folder = str(tmp_path / "media")
    df = spark.range(30_000).select(F.lit("one").alias("f"), F.col("id").alias("n"))
    named_files.write_named(df, folder, F.concat("f", F.lit(".csv")), ["n"], hidden=["f"])
    with open(f"{folder}/one.csv") as file:
        assert file.read().split("\n") == ['"n"', *[f'"{n}"' for n in range(30_000)], ""]


def test_form_files(spark, tables, tmp_path):
    folder = str(tmp_path / "media")
    props = lists.all_properties(tables).filter("property_oid IN (0, 7)")
    refresh.write_form_files(cascade.itemsets(tables, props, ordered=False), cascade.chem_defaults(tables, props), folder)
    assert set(os.listdir(folder)) <= {f"{p}{kind}.csv" for p in (0, 7) for kind in ("itemsets", "chemdefaults")}
    assert "0itemsets.csv" in os.listdir(folder)


def test_procedures(spark, tables):
    names = procedures.register(spark, tables)
    assert len(set(names)) == 9
    known = lists.domain(tables, "supervisor", lists.all_properties(tables)).filter("property_oid = 3").select("code", "description")
    assert rows(spark.sql(f"SELECT * FROM {procedures.BY_KIND['supervisor']}(3)")) == rows(known)
    # A property without such a list, and one that nobody knows.
    assert rows(spark.sql(f"SELECT * FROM {procedures.BY_KIND['supervisor']}(5)")) == [("1", "NA")]
    assert rows(spark.sql(f"SELECT * FROM {procedures.BY_KIND['supervisor']}(12345)")) == [("1", "NA")]


def test_a_call_for_each_property_is_one_plan(spark, tables):
    procedures.register(spark, tables)
    text = f"SELECT p.k, l.* FROM {{p}} p, LATERAL {procedures.BY_KIND['species']}(p.k) l"
    scans = []
    for count in (1, 500):
        props = spark.range(count).selectExpr("cast(id AS int) AS k")
        df = spark.sql(text, p=props)
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        assert df.select("k").distinct().count() == count
    assert scans == [1, 1]
