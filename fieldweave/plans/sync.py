"""Merging the day's new activities and chemicals into the office tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.operators import activities as A
from fieldweave.operators import chemicals as C
from fieldweave.operators.joins import Sieve, sieve, split_join
from fieldweave.operators.lists import Tables
from fieldweave.sources.sinks import stored
from fieldweave.sources.tables import dataset_counts, staging_schema


def staged_property(tables: Tables, staging: T.StructType) -> DataFrame:
    rows = A.stage(A.route(tables["activity_mobile"]).property, staging)
    return A.enrich_property(rows, tables["property"])


def staged_stand(tables: Tables, staging: T.StructType) -> DataFrame:
    rows = A.stage(A.route(tables["activity_mobile"]).stand, staging)
    return A.enrich_stand(rows, tables["stand"])


class Merged(NamedTuple):
    """Keys of the mobile rows that earlier runs have merged."""

    activities: DataFrame | None = None
    chemicals: DataFrame | None = None


def merged_by(spark: SparkSession, folders: list[str]) -> Merged:
    """What the runs that ``publish`` wrote to ``folders`` have merged."""
    if not folders:
        return Merged()
    read = spark.read.schema("OBJECTID long").parquet
    return Merged(read(*[f"{f}/merged_activities" for f in folders]), read(*[f"{f}/merged_chemicals" for f in folders]))


def routed(tables: Tables) -> DataFrame:
    return tables["activity_mobile"].filter(F.col("prop_or_stand").isin(A.PROPERTY_ROUTE, A.STAND_ROUTE))


def new_activities(tables: Tables, merged: Merged = Merged(), highest: int | None = None) -> DataFrame:
    """Rows to add to the activity table, complete with ObjectIDs and GlobalIDs; mobile rows merged before are left out."""
    target = tables["activity"]
    staged = A.stage(A.unmerged(routed(tables), merged.activities), staging_schema(target, "activity"))
    return A.append_new(target, staged, tables["property"], tables["stand"], "activity", highest)


def chemical_input(tables: Tables, merged: Merged = Merged()) -> DataFrame:
    """New chemicals; none of them counts in a run without new activities."""
    return A.unmerged(tables["chem_mobile"].where(tables["activity_mobile"].exists()), merged.chemicals)


def new_chemicals(tables: Tables, merged: Merged = Merged()) -> DataFrame:
    """Planned and actual records to add to the chemical table, without activity keys yet."""
    target = tables["chem_app"]
    return C.planned_and_actual(chemical_input(tables, merged), target.schema, staging_schema(target, "chem_app"))


def stored_day(tables: Tables, folder: str) -> dict[str, DataFrame]:
    """``tables`` with the mobile rows of the day written under ``folder``, so that no step computes them anew."""
    mobile = {name: stored(tables[name], f"{folder}/{name}") for name in ("activity_mobile", "chem_mobile")}
    return {**tables, **mobile}


def stored_sieve(keys: DataFrame, key: str, folder: str) -> Sieve | None:
    """The sieve of stored keys, written to ``folder``; None if they are few."""
    found = sieve(keys, key)
    return found and found._replace(rows=stored(found.rows, folder))


def same_after(tables: Tables, folder: str) -> DataFrame:
    """The chemicals of ``tables`` that the run in ``folder`` leaves as they are."""
    guids = tables["chem_app"].sparkSession.read.schema("Child_GUID string").parquet(f"{folder}/guids")
    return split_join(tables["chem_app"], guids, ["Child_GUID"], "left_anti", stored_sieve(guids, "Child_GUID", f"{folder}/guid_sieve_after"))


@dataclass
class SyncResult:
    new_activities: DataFrame
    activities: DataFrame
    new_chemicals: DataFrame
    changed_chemicals: DataFrame
    same_chemicals: DataFrame
    chemicals: DataFrame  # the whole chemical table after the run
    rejects: DataFrame
    overlay: DataFrame
    counts: DataFrame


def sync(tables: Tables, merged: Merged = Merged(), folder: str | None = None, highest: int | None = None) -> SyncResult:
    """All results of a run. ``highest`` is the highest ObjectID of the activities, if it is known.

    Only the chemicals with a GUID of the day are looked up and updated; all others are the rows that stay the same.
    With a ``folder`` the new rows and their keys are computed once, written there and read back. They are as few as the
    day's work, so Spark knows their size and may leave the office tables where they are. Where they are too many for
    that, sieves of their keys keep all other office rows in place. Without a folder every frame is lazy and computes
    what it needs anew.
    """
    def keep(df: DataFrame, name: str) -> DataFrame:
        return stored(df, f"{folder}/{name}") if folder else df

    def keep_sieve(keys: DataFrame, key: str, name: str) -> Sieve | None:
        return stored_sieve(keys, key, f"{folder}/{name}") if folder else None

    mobile = tables["activity_mobile"]
    routes = A.route(mobile)
    new = keep(new_activities(tables, merged, highest), "new_activities")
    activities = tables["activity"].unionByName(new)
    records = keep(new_chemicals(tables, merged), "chemical_records")
    guids = keep(C.guids_of(records), "guids")
    of_day = keep_sieve(guids, "Child_GUID", "guid_sieve")
    stand_items = keep(routes.stand.select("Parent_GUID"), "stand_items")
    of_stands = keep_sieve(stand_items, "Parent_GUID", "stand_sieve")
    keys = keep(C.activity_keys(guids, activities, of_day), "activity_keys")
    office = tables["chem_app"]
    new_chemicals_keyed = C.set_activity_keys(records, keys)
    return SyncResult(
        new_activities=new,
        activities=activities,
        new_chemicals=new_chemicals_keyed,
        changed_chemicals=C.set_activity_keys(split_join(office, guids, ["Child_GUID"], "left_semi", of_day), keys),
        same_chemicals=split_join(office, guids, ["Child_GUID"], "left_anti", of_day),
        chemicals=C.set_activity_keys(office, keys, of_day).unionByName(new_chemicals_keyed),
        rejects=routes.reject,
        overlay=A.overlay_worklist(activities, stand_items, of_stands),
        counts=A.route_counts(mobile, tables["chem_mobile"]),
    )


def sync_rows(tables: Tables, folder: str | None = None) -> DataFrame:
    """Activities, chemicals, rejects, overlay work list and counts of a run in one frame, told apart by ``output``."""
    result = sync(tables, folder=folder)
    parts = {
        "activity": result.activities,
        "chemical": result.chemicals,
        "reject": result.rejects.select("OBJECTID", F.col("Parent_GUID").alias("PARENT_GUID"), "PropertyOID", "Cost"),
        "overlay": result.overlay,
        "count": result.counts,
    }
    rows = [part.select(F.lit(name).alias("output"), *part.columns) for name, part in parts.items()]
    total = rows[0]
    for part in rows[1:]:
        total = total.unionByName(part, allowMissingColumns=True)
    return total


def publish(tables: Tables, folder: str, earlier: list[str] = []) -> DataFrame | None:
    """Run a sync and write its results under ``folder``; None if there is nothing new.

    Writes ``new_activities`` and ``new_chemicals`` to append to the office tables, ``changed_chemicals`` to put in place of
    the chemicals with the same GUIDs, then the rest. Each step reads what the step before has written, so the keys in
    the chemicals are those that were stored. The input tables are not touched: a run that stops half way is simply
    repeated. Mobile rows stay until somebody clears them; ``earlier`` names the folders of the runs since, whose rows
    are not merged again, whatever their GUID.
    """
    dataset_counts(tables)  # names what is missing
    if tables["activity_mobile"].isEmpty():
        return None
    merged = merged_by(tables["activity"].sparkSession, earlier)
    tables = stored_day(tables, folder)
    result = sync(tables, merged, folder)
    stored(result.new_chemicals, f"{folder}/new_chemicals")
    stored(result.changed_chemicals, f"{folder}/changed_chemicals")
    stored(result.rejects, f"{folder}/rejects")
    stored(result.overlay, f"{folder}/overlay")
    stored(A.unmerged(routed(tables), merged.activities).select("OBJECTID"), f"{folder}/merged_activities")
    stored(chemical_input(tables, merged).select("OBJECTID"), f"{folder}/merged_chemicals")
    return stored(result.counts, f"{folder}/counts")
