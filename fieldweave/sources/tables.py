"""Input tables by name."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.sources.bindings import BINDINGS, RAW_SCHEMAS

# The datasets every sync run requires, and those without a GlobalID, each
# with its key, if it has one.
REQUIRED = ["activity_mobile", "chem_mobile", "activity", "chem_app", "stand", "property"]
WITHOUT_GLOBAL_ID = {
    "stand": "ObjectID", "chem_master": "ObjectID", "activity_mobile": "OBJECTID", "chem_mobile": "OBJECTID", "chem_app": None,
    "hv_optprod": None, "special_point": None, "special_line": None, "special_poly": None,
}

# Columns the staging tables lack compared with the tables they feed.
NOT_STAGED = {"activity": ["office_only"], "chem_app": ["Cost"]}

COLLATION = "UTF8_LCASE_RTRIM"

RAW_NAME = re.compile(rf"\b({'|'.join(RAW_SCHEMAS)})\b")


class BoundTables(Mapping):
    """The data model bound to a folder of raw parquet tables. Each table is built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._bound: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._folder}/{name}.parquet")
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._bound:
            binding = BINDINGS[name]
            source = binding.joined or binding.source
            text = binding.select(RAW_NAME.sub(r"{\1}", source))
            used = {raw: self.raw(raw) for raw in set(RAW_NAME.findall(source))}
            self._bound[name] = self._spark.sql(text, **used)
        return self._bound[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)


class CatalogTables(Mapping):
    """The data model as tables of the session's catalog, for deployments. ``names`` maps a dataset to its table."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str]):
        self._spark = spark
        self._names = dict(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.table(self._names[name])

    def __contains__(self, name: object) -> bool:
        return name in self._names and self._spark.catalog.tableExists(self._names[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def collated(df: DataFrame, collation: str = COLLATION) -> DataFrame:
    """``df`` with text compared under ``collation`` instead of byte by byte.

    Every later distinct, join and filter on these columns follows it, e.g. ignoring case and trailing blanks.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.collate(name, collation) for name in text})


def staging_schema(target: DataFrame, name: str) -> T.StructType:
    """Schema of the staging table in front of ``target``. The staging tables themselves never hold rows here."""
    absent = {column.lower() for column in NOT_STAGED[name]}
    return T.StructType([f for f in target.schema.fields if f.name.lower() not in absent])


def scan(table: DataFrame, columns: list[str], predicate=None) -> DataFrame:
    """Named columns of a table, optionally filtered; both reach the file scan."""
    return (table if predicate is None else table.filter(predicate)).select(*columns)


def scan_keys(table: DataFrame, columns: list[str], key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``key`` is among ``keys[key]``: one semi-join in place of a scan per key."""
    return table.join(keys.select(key), key, "left_semi").select(*columns)


def dataset_counts(tables: Mapping[str, DataFrame], names: list[str] = REQUIRED) -> DataFrame:
    """``dataset, rows`` of the named datasets; a missing dataset is an error."""
    missing = [name for name in names if name not in tables]
    if missing:
        raise LookupError(f"datasets not found: {', '.join(missing)}")
    counts = [tables[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows") for name in names]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total
