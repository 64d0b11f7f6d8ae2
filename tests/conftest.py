import pytest
from pyspark.sql import SparkSession

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture()
def tables(spark, folder):
    from fieldweave.sources.tables import BoundTables

    return BoundTables(spark, folder)


def rows(df, *columns):
    """Rows as sorted tuples, NULL first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])
