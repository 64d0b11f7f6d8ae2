from decimal import Decimal

from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from tests.conftest import rows


def values(spark, pairs, column):
    """Result of ``column`` for each input row, in input order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(pairs)], "i int, a string, b string")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_strip_location(spark):
    texts = ["a--b", "--b", "a---b--c", "ab", None, "", "a-b", " x --y"]
    got = values(spark, [(t, None) for t in texts], X.strip_location("a"))
    assert got == ["a", "", "a", "ab", None, "", "a-b", " x "]


def test_pair_label(spark):
    got = values(spark, [("A", "x"), ("A", None), (None, "x"), (None, None)], X.pair_label("a", "b"))
    assert got == ["A - x", "A", " - x", ""]


def test_lookup_key(spark):
    assert spark.range(423, 424).select(X.lookup_key("id")).collect()[0][0] == Decimal("423.0")


def test_integer_code(spark):
    got = values(spark, [("1", None), ("x1", None), (None, None), ("-7", None)], X.integer_code("a"))
    assert got == [1, None, None, -7]


def test_flag_key(spark):
    df = spark.createDataFrame([("042 - Pine Ridge",), ("0 - Home",)], "prop_key string")
    assert rows(df.select(X.flag_oid("prop_key"), X.flag_name("prop_key"))) == [(0, "Home"), (42, "Pine Ridge")]


def test_list_name(spark):
    assert spark.range(1).select(X.list_name(F.lit(42), F.lit("species"))).collect()[0][0] == "42_species"


def test_global_id_is_stable_and_shaped(spark):
    df = spark.range(1000).select(X.global_id("activity", "id").alias("g"))
    assert df.filter(~F.col("g").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).isEmpty()
    assert df.distinct().count() == 1000
    assert rows(df) == rows(spark.range(1000).repartition(7).select(X.global_id("activity", "id").alias("g")))


def test_contains_oid(spark):
    got = values(spark, [("Stand 423 form", None), ("Stand 43", None)], X.contains_oid("a", F.lit(42)))
    assert got == [True, False]
