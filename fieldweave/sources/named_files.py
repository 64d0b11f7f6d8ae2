"""CSV files under names of their own, such as ``7itemsets.csv``, by Spark's Python data source interface."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "named_csv"
FILE = "_file"


@dataclass
class Drafts(WriterCommitMessage):
    """The drafts that a task wrote, by the names that their files are to have."""

    written: dict[str, str] = field(default_factory=dict)


class NamedFiles(DataSource):
    """``path`` is a folder that all executors share. The column ``_file`` names the file of a row; all columns are text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], [name for name in schema.names if name != FILE], schema.names.index(FILE))


class NamedFilesWriter(DataSourceArrowWriter):
    """Tasks write drafts, row by row; the commit gives them their names, and an abort removes them.

    All rows of a file come to one task, one file after another.
    """

    def __init__(self, folder: str, columns: list[str], file: int) -> None:
        self.folder, self.columns, self.file = folder.rstrip("/"), columns, file
        self.run = uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder if ":" in self.folder.split("/")[0] else f"file://{self.folder}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Drafts:
        files, folder = self._at()
        files.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        done, stream, current = Drafts(), None, None
        try:
            for batch in iterator:
                names = batch.column(self.file).to_pylist()
                values = [batch.column(n).to_pylist() for n in range(batch.num_columns) if n != self.file]
                text = io.StringIO()
                line = csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator="\n")
                for name, *row in zip(names, *values):
                    if name != current:
                        if stream:
                            stream.write(text.getvalue().encode())
                            stream.close()
                            text.seek(0)
                            text.truncate()
                        if name in done.written:
                            raise ValueError(f"rows of {name} do not come together")
                        current, done.written[name] = name, f".{self.run}-{attempt}-{len(done.written)}.draft"
                        stream = files.open_output_stream(f"{folder}/{done.written[name]}")
                        line.writerow(self.columns)
                    line.writerow(row)
                if stream:
                    stream.write(text.getvalue().encode())
        finally:
            if stream:
                stream.close()
        return done

    def commit(self, messages: list[Drafts | None]) -> None:
        files, folder = self._at()
        found = [(name, draft) for message in messages if message for name, draft in message.written.items()]
        if len(dict(found)) < len(found):
            raise ValueError("rows of one file came to several tasks")
        for name, draft in found:
            files.move(f"{folder}/{draft}", f"{folder}/{name}")
        self._clear()

    def abort(self, messages: list[Drafts | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Remove the run's drafts, those of failed and repeated tasks as well."""
        files, folder = self._at()
        for found in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if found.base_name.startswith(f".{self.run}-"):
                files.delete_file(found.path)


def write_named(df: DataFrame, folder: str, file: Column, order: list[Column | str] = (), hidden: list[str] = ()) -> None:
    """``df`` as one CSV file for each value of ``file``: header, every field quoted, quotes doubled, NULL empty.

    Files of the same name are replaced, others stay. Rows of a file are in the given order; ``hidden`` columns are left out.
    A file is written by one task, row by row as Spark sorts them.
    """
    df.sparkSession.dataSource.register(NamedFiles)
    rows = df.withColumn(FILE, file).repartition(FILE).sortWithinPartitions(FILE, *order)
    text = [F.col(name).cast("string").alias(name) for name in df.columns if name not in hidden]
    rows.select(FILE, *text).write.format(FORMAT).mode("append").option("path", folder).save()


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``file, place, line`` of the files that ``write_named`` wrote; the header has place 0."""
    files = spark.read.option("pathGlobFilter", "*.csv").text(folder, wholetext=True)
    name = F.url_decode(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    lines = F.split(F.regexp_replace("value", "\n$", ""), "\n")
    return files.select(name.alias("file"), F.posexplode(lines).alias("place", "line"))
