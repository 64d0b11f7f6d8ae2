"""Tables, stored intermediate results and running totals that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.sources.sinks import remove_folder, work_folder

#: Characters that separate words.
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Shuffle files of a query go when it has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, folder: str | None = None, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps see fixed rows of a known size.

    Nothing needs the shuffle files of the step after that, so they are removed. A ``folder`` that is named keeps the rows
    that it has; each value of ``by`` gets a folder ``<by>=<value>`` within.
    """
    spark = df.sparkSession
    folder, before = folder or work_folder(spark), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("append").partitionBy(*[by] if by else []).option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(folder)
    kept.stored_in = folder
    return kept


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        remove_folder(table.sparkSession, table.stored_in)


def packed_row(columns: list[str] | tuple[str, ...]) -> Column:
    """A struct of columns of any name."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("struct<none:int>")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` does not have."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of some rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ranged(df: DataFrame, keys: list[str], group: str, *values: str) -> DataFrame:
    """``df`` with ``before_<value>``: the sum of each value over the rows of the same ``group`` that come earlier by ``keys``.

    ``keys`` begin with ``group``, which holds no NULL; values are whole numbers. Rows are sorted by range, so that a large
    group spans several tasks; each task sums its own rows, and the totals, one row for each task and group, are summed
    once more. The sorted rows are stored, as a second run might draw other range bounds.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys).withColumn("_task", F.spark_partition_id())
    columns = rows.columns

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, totals = None, [0] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(columns.index(group)).dictionary_encode()
            codes = own.indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            found = []
            for n, value in enumerate(values):
                sizes = batch.column(columns.index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.cumsum(sizes) - sizes
                before -= np.repeat(before[starts], np.diff(np.r_[starts, len(codes)]))
                if own[0].as_py() == last:
                    before[: starts[1] if len(starts) > 1 else len(codes)] += totals[n]
                totals[n] = int(before[-1] + sizes[-1])
                found.append(pa.array(before))
            last = own[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*columns, *(f"before_{v}" for v in values)])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(f"before_{v}", T.LongType()) for v in values)])
    kept = stored(rows.mapInArrow(sums, schema))
    totals = kept.groupBy(group, "_task").agg(*(F.sum(v).alias(f"_sum_{v}") for v in values))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_task", *(F.sum(f"_sum_{v}").over(earlier).alias(f"_offset_{v}") for v in values))
    joined = kept.join(offsets.filter(F.col(f"_offset_{values[0]}").isNotNull()), [group, "_task"], "left")
    return joined.withColumns({f"before_{v}": F.col(f"before_{v}") + F.coalesce(f"_offset_{v}", F.lit(0)) for v in values}).drop(
        "_task", *(f"_offset_{v}" for v in values))
