"""Published lists, merged tables and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Header, all fields quoted, quotes doubled, blanks kept. NULL and '' are both written as "".
CSV_WRITE = {
    "header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# An empty field in quotes is the empty text; only one without quotes is NULL.
CSV_READ = {"header": True, "escape": '"', "nullValue": "\0", "emptyValue": ""}


def work_folder(spark: SparkSession) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` or else ``setCheckpointDir`` names."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/fieldweave-{uuid.uuid4()}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that is no longer read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class FileTree:
    """Small files and folder names under one folder, of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self.folder = folder.rstrip("/")
        self._files = self._paths(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._paths(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; none if there is no such folder."""
        path = self._path(name)
        return sorted(f.getPath().getName() for f in self._files.listStatus(path)) if self._files.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> None:
        """A file that appears whole under its name; one that is there already is an error."""
        path, draft = self._path(name), self._path(f"{name}.{uuid.uuid4()}.draft")
        stream = self._files.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._files.exists(path) or not self._files.rename(draft, path):
            self._files.delete(draft, False)
            raise FileExistsError(f"{self.folder}/{name}")

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)


def stored(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read back, so that later steps see fixed rows of a known size."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_csv(df: DataFrame, folder: str, by: str = "property_oid", ordered: bool = False) -> None:
    """CSV files in one folder ``<by>=<key>`` per key: header, every field quoted, quotes doubled, NULL empty.

    Small keys share a task and a large key gets several tasks, and so several files. ``ordered`` says that ``df`` is
    sorted with ``by`` first; then the rows stay in that order, over the files of a key in order of their names.
    """
    rows = df if ordered else df.hint("rebalance", F.col(by))
    rows.write.mode("overwrite").partitionBy(by).options(**CSV_WRITE).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What ``write_csv`` wrote. The key is a column again; NULL comes back as the empty text."""
    return spark.read.schema(schema).options(**CSV_READ).csv(folder)


def write_code_lists(lists: DataFrame, folder: str) -> None:
    """``code, description`` of each list as CSV files in one folder ``list_name=<list_name>`` per list."""
    write_csv(lists.select("list_name", "code", "description"), folder, by="list_name")


def read_code_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``list_name, code, description`` of what ``write_code_lists`` wrote, or of plain files ``<list_name>.csv``."""
    rows = spark.read.schema("code string, description string").options(**CSV_READ, recursiveFileLookup=True, pathGlobFilter="*.csv")
    name = F.regexp_extract(F.input_file_name(), r"(?:/list_name=([^/]+)/[^/]*|/([^/]+)\.csv)$", 0)
    name = F.regexp_replace(F.regexp_replace(name, r"^/(?:list_name=)?", ""), r"(?:/[^/]*|\.csv)$", "")
    return rows.csv(folder).select(F.url_decode(name).alias("list_name"), "code", "description")


def replace_domains(domains: DataFrame, folder: str, name: str = "domain_name") -> None:
    """Replace the lists that have rows in ``domains``; all others stay."""
    rows = domains.hint("rebalance", F.col(name)).write.mode("overwrite").partitionBy(name)
    rows.option("partitionOverwriteMode", "dynamic").parquet(folder)


def list_digests(domains: DataFrame, name: str = "domain_name") -> DataFrame:
    """``<name>, rows, first, second``: the size of each list and two sums over hashes of its rows, whatever their order."""
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "code", "description").cast("decimal(38,0)"))

    return domains.groupBy(name).agg(F.count("*").alias("rows"), total(1).alias("first"), total(2).alias("second"))


def publish_changed(domains: DataFrame, folder: str, state: str, name: str = "domain_name") -> DataFrame:
    """Replace the lists in ``folder`` whose rows are not the published ones; returns ``<name>, rows`` of those.

    ``<state>/digests`` holds the digests of the published lists, a new version for each run; the last one that is complete
    counts. It is written after the lists, so a run that stops before it writes the same lists again.
    """
    spark, files = domains.sparkSession, FileTree(domains.sparkSession, state)
    versions = [v for v in files.names("digests") if "_SUCCESS" in files.names(f"digests/{v}")]
    domains = stored(domains, f"{state}/computed")
    digests = list_digests(domains, name)
    before = spark.read.schema(digests.schema).parquet(f"{state}/digests/{versions[-1]}") if versions else digests.limit(0)
    changed = stored(digests.join(before, digests.columns, "left_anti"), f"{state}/changed")
    if changed.isEmpty() and versions:
        return changed.select(name, "rows")
    replace_domains(domains.join(changed.select(name), name, "left_semi"), folder, name)
    kept = before.join(changed.select(name), name, "left_anti").unionByName(changed)
    kept.write.mode("overwrite").parquet(f"{state}/digests/{int(versions[-1]) + 1 if versions else 0:012}")
    for version in versions:
        files.remove(f"digests/{version}")
    return changed.select(name, "rows")


def copy_dataset(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def truncate(spark: SparkSession, folder: str) -> None:
    """Remove all rows of a stored table; its schema stays."""
    schema = spark.read.parquet(folder).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)
