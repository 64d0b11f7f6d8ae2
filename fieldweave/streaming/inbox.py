"""Mobile rows as they arrive: files of a drop folder become batches of an inbox, each file in one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fieldweave.sources.sinks import FileTree

DONE = "_SUCCESS"


def take_up(spark: SparkSession, drop: str, folder: str, name: str, schema: T.StructType, files: int = 1000) -> None:
    """Bring all files that are in ``<drop>/<name>`` now to the inbox, at most ``files`` of them to a batch.

    The stream remembers in the inbox which files it has read. A batch is named by the stream and its number and written
    as a whole; one that is repeated, as its stream stopped before noting it, is written to the same place again.
    """
    def land(rows: DataFrame, number: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows.write.mode("overwrite").parquet(f"{folder}/{name}/{stream}-{number}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{drop}/{name}")
    query = (
        rows.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/streams/{name}")
        .foreachBatch(land).start()
    )
    query.awaitTermination()


def batches(spark: SparkSession, folder: str, name: str) -> list[str]:
    """The batches that are there as a whole."""
    files = FileTree(spark, folder)
    return [batch for batch in files.names(name) if DONE in files.names(f"{name}/{batch}")]


def read(spark: SparkSession, folder: str, name: str, chosen: list[str], schema: T.StructType) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{name}/{batch}" for batch in chosen])


def clear(spark: SparkSession, folder: str, name: str, chosen: list[str]) -> None:
    """Remove batches, if they are still there."""
    files = FileTree(spark, folder)
    for batch in set(chosen) & set(files.names(name)):
        files.remove(f"{name}/{batch}")
