"""Tables in buckets, changed by runs that either count as a whole or not at all.

Every run writes to folders of its own, ``<table>/run=<run>/bucket=<n>``. One small file for each commit says which folders
hold the rows of each bucket. Until a run's file is there nothing of the run counts, so a run that stops anywhere before
is repeated under the same name and writes its folders anew. Folders that no commit names any more are removed by
``vacuum``, once nobody reads an older state. One run at a time may write.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.sources.sinks import FileTree

BUCKET = "bucket"
RUN = "run"

# With no more buckets than these a task writes a file of its own for each, without a shuffle before.
DIRECT_BUCKETS = 16


@dataclass(frozen=True)
class Table:
    """A table's layout, the column it is bucketed by, and the runs that hold the rows of each bucket."""

    schema: str
    key: str
    parts: dict[str, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class State:
    """What counts after a commit. ``facts`` are a few values of the runs' own, such as the highest ObjectID."""

    number: int
    buckets: int
    runs: list[str]
    facts: dict
    tables: dict[str, Table]

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> State:
        found = json.loads(text)
        return State(**{**found, "tables": {name: Table(**table) for name, table in found["tables"].items()}})


class Store:
    """Tables under ``folder``. ``state`` is read anew each time, so a store object never grows old."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.files = FileTree(spark, self.folder)

    def state(self) -> State:
        commits = sorted(name for name in self.files.names("commits") if name.endswith(".json"))
        return State.of(self.files.read(f"commits/{commits[-1]}")) if commits else State(0, 1, [], {}, {})

    def create(self, layouts: Mapping[str, tuple[T.StructType, str]], buckets: int, facts: dict | None = None) -> None:
        """Empty tables with their bucket columns. ``buckets`` stays as it is; choose it so that one is a few files."""
        if self.state().number:
            raise FileExistsError(f"there is a store in {self.folder}")
        tables = {name: Table(schema.json(), key) for name, (schema, key) in layouts.items()}
        self._commit(State(1, buckets, [], facts or {}, tables))

    def _commit(self, state: State) -> None:
        """The commit point: the file appears whole under its name, or not at all."""
        self.files.write_once(f"commits/{state.number:012}.json", state.text())

    def bucket(self, key: str, columns: list[str], state: State | None = None) -> Column:
        """The bucket of a row; rows without a key are dealt by all their values, so they share no bucket."""
        own = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))).otherwise(F.xxhash64(*columns))
        return F.pmod(own, F.lit((state or self.state()).buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets of the keys in ``rows``; no more of them than the store has."""
        keys = rows.select(key).filter(F.col(key).isNotNull())
        return sorted(r[0] for r in keys.select(self.bucket(key, [key])).distinct().collect())

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.state().tables[name].schema))

    def rows(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a table with their bucket, of the given buckets only, if any are given. Other files are not listed."""
        table, schema = self.state().tables[name], self.schema(name)
        wanted = table.parts if buckets is None else {str(b): table.parts.get(str(b), []) for b in buckets}
        paths = [f"{self.folder}/{name}/{RUN}={run}/{BUCKET}={b}" for b, runs in wanted.items() for run in runs]
        layout = T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], layout).drop(RUN)
        return self.spark.read.schema(layout).option("basePath", f"{self.folder}/{name}").parquet(*paths).drop(RUN)

    def table(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.rows(name, buckets).drop(BUCKET)

    def scan_keys(self, name: str, columns: list[str], keys: DataFrame) -> DataFrame:
        """Rows whose key is in the first column of ``keys``.

        Buckets take part in the join, so while Spark can send the keys to the rows it reads the keys' buckets only.
        """
        key = self.state().tables[name].key
        wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
        wanted = wanted.withColumn(BUCKET, self.bucket(key, [key])).filter(F.col(BUCKET) >= 0)
        return self.rows(name).join(wanted, [BUCKET, key], "left_semi").select(*columns)

    def begin(self, run: str) -> Run:
        return Run(self, run)

    def vacuum(self) -> int:
        """Remove the folders that the last commit does not name; returns how many."""
        state, removed = self.state(), 0
        for name, table in state.tables.items():
            named = {(run, b) for b, runs in table.parts.items() for run in runs}
            for run in self.files.names(name):
                held = self.files.names(f"{name}/{run}")
                gone = [b for b in held if b.startswith(f"{BUCKET}=") and (run.partition("=")[2], b.partition("=")[2]) not in named]
                for b in gone:
                    self.files.remove(f"{name}/{run}/{b}")
                if len(gone) == sum(b.startswith(f"{BUCKET}=") for b in held):
                    self.files.remove(f"{name}/{run}")
                removed += len(gone)
        return removed


class Run:
    """Changes that count together, from ``commit`` on."""

    def __init__(self, store: Store, name: str) -> None:
        self.store, self.name = store, name
        self.state = store.state()
        if name in self.state.runs:
            raise FileExistsError(f"run {name} is committed")
        self.tables = dict(self.state.tables)

    def write(self, name: str, rows: DataFrame, replaced: Iterable[int] = ()) -> None:
        """Add ``rows`` to a table. In the ``replaced`` buckets they take the place of what was there.

        With many buckets rows are shuffled to them first, so that not every task writes a small file for each.
        """
        table, schema = self.tables[name], self.store.schema(name)
        rows = rows.select(*schema.names).withColumn(BUCKET, self.store.bucket(table.key, schema.names, self.state))
        folder = f"{name}/{RUN}={self.name}"
        self.store.files.remove(folder)
        if self.state.buckets > DIRECT_BUCKETS:
            rows = rows.hint("rebalance", F.col(BUCKET))
        rows.write.partitionBy(BUCKET).parquet(f"{self.store.folder}/{folder}")
        parts = {b: runs for b, runs in table.parts.items() if b not in set(map(str, replaced))}
        for found in self.store.files.names(folder):
            if found.startswith(f"{BUCKET}="):
                b = found.partition("=")[2]
                parts[b] = [*parts.get(b, []), self.name]
        self.tables[name] = replace(table, parts=parts)

    def commit(self, **facts) -> State:
        state = State(self.state.number + 1, self.state.buckets, [*self.state.runs, self.name], {**self.state.facts, **facts}, self.tables)
        self.store._commit(state)
        return state

