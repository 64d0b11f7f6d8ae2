import glob

import pytest

from fieldweave.sources import sinks
from fieldweave.sources.tables import dataset_counts
from tests.conftest import rows

TRICKY = [(1, 'say "hi"', None), (1, "a,b", ""), (1, " pad ", "line\\n"), (2, "x", "é"), (2, "back\\slash", "--")]
SCHEMA = "property_oid int, code string, description string"


def test_csv_text(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame(TRICKY, SCHEMA), str(tmp_path / "out"))
    lines = []
    for path in glob.glob(f"{tmp_path}/out/property_oid=1/*.csv"):
        lines += open(path, encoding="utf-8").read().splitlines()
    assert '"code","description"' in lines
    assert '"say ""hi""",""' in lines and '"a,b",""' in lines and '" pad ","line\\n"' in lines


def test_csv_roundtrip(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame(TRICKY, SCHEMA), str(tmp_path / "out"))
    back = sinks.read_csv(spark, str(tmp_path / "out"), "code string, description string, property_oid int")
    assert rows(back.select("property_oid", "code", "description")) == rows(
        spark.createDataFrame(TRICKY, SCHEMA).na.fill("", ["description"])
    )


def test_code_lists_from_plain_files(spark, tmp_path):
    (tmp_path / "act status.csv").write_text('code,description\nO,open\n"","none"\nX,\n')
    got = sinks.read_code_lists(spark, str(tmp_path))
    assert rows(got) == [("act status", "", "none"), ("act status", "O", "open"), ("act status", "X", None)]


def test_replace_leaves_other_lists(spark, tmp_path):
    layout = "domain_name string, code string"
    folder = str(tmp_path / "domains")
    sinks.replace_domains(spark.createDataFrame([("0_a", "1"), ("0_b", "2"), ("1_a", "3")], layout), folder)
    sinks.replace_domains(spark.createDataFrame([("0_b", "9")], layout), folder)
    assert rows(spark.read.parquet(folder).select("domain_name", "code")) == [("0_a", "1"), ("0_b", "9"), ("1_a", "3")]


def test_truncate_keeps_schema(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame(TRICKY, SCHEMA)
    sinks.copy_dataset(df, folder)
    assert rows(spark.read.parquet(folder)) == rows(df)
    sinks.truncate(spark, folder)
    assert spark.read.parquet(folder).isEmpty()
    assert spark.read.parquet(folder).schema.simpleString() == df.schema.simpleString()


def test_work_folder_follows_the_session(spark):
    assert sinks.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert sinks.work_folder(spark) != sinks.work_folder(spark)


def test_dataset_counts(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert rows(dataset_counts(tables, ["a", "b"])) == [("a", 3), ("b", 0)]
    with pytest.raises(LookupError, match="c"):
        dataset_counts(tables, ["a", "c"])
