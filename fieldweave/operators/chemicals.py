"""New chemical applications: a planned and an actual record each, tied to their activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.functions import scalars as X
from fieldweave.operators.joins import Sieve, sifted, split_join
from fieldweave.operators.mapping import align, aligned_columns, map_fields

# Fixed value: context of a record of work done.
ACTUAL_CONTEXT = 1440


def planned(chemicals: DataFrame, target: T.StructType) -> DataFrame:
    """Records as entered: mapped straight to the target."""
    return align(chemicals.select(*map_fields(target, chemicals.schema)), target)


def actual(chemicals: DataFrame, staging: T.StructType, context: int = ACTUAL_CONTEXT) -> DataFrame:
    """Records of work done, in the staging layout, all with the same context."""
    mapped = map_fields(staging, chemicals.schema)
    return align(chemicals.select(*mapped), staging, Activity_ContextID=F.lit(context))


def planned_and_actual(
    chemicals: DataFrame, target: T.StructType, staging: T.StructType, context: int = ACTUAL_CONTEXT
) -> DataFrame:
    """Both records of every chemical out of one scan, in the target layout.

    The planned one has every mapped column; the actual one only those that staging has as well. If the target has
    GlobalIDs, theirs come from the key of the chemical, so a repeated task gives the same ones.
    """
    keyed = "globalid" in map(str.lower, target.names) and "objectid" in map(str.lower, chemicals.columns)
    ids = {kind: {"GlobalID": X.global_id(f"chem_app:{kind}", "OBJECTID")} if keyed else {} for kind in ("planned", "actual")}
    straight = map_fields(target, chemicals.schema)
    staged = map_fields(target, T.StructType([chemicals.schema[name] for name in map_fields(staging, chemicals.schema)]))
    copies = F.array(
        F.struct(*aligned_columns(straight, target, **ids["planned"])),
        F.struct(*aligned_columns(staged, target, Activity_ContextID=F.lit(context), **ids["actual"])),
    )
    return chemicals.select(F.inline(copies))


def guids_of(chemicals: DataFrame) -> DataFrame:
    return chemicals.select("Child_GUID").distinct()


def activity_keys(guids: DataFrame, activities: DataFrame, by: Sieve | None = None) -> DataFrame:
    """``Child_GUID, _oid, _gid`` of the activity with each of the GUIDs; the highest ObjectID wins.

    While the GUIDs are few, Catalyst filters the activities by them first. Otherwise activities that share a GUID
    collapse before they are shuffled, and with a sieve of the GUIDs only those that pass it are.
    """
    keys = (sifted(activities, by, "Parent_GUID") if by else activities).groupBy(F.col("Parent_GUID").alias("Child_GUID")).agg(
        F.max("OBJECTID").alias("_oid"), F.max_by("GlobalID", "OBJECTID").alias("_gid")
    )
    return keys.join(guids, "Child_GUID", "left_semi")


def set_activity_keys(chemicals: DataFrame, keys: DataFrame, by: Sieve | None = None) -> DataFrame:
    """``chemicals`` with the activity keys of their GUID; rows with another GUID stay as they are.

    With a sieve of the GUIDs only the chemicals that pass it are moved.
    """
    if by:
        near = set_activity_keys(sifted(chemicals, by, "Child_GUID"), keys)
        return near.unionByName(sifted(chemicals, by, "Child_GUID", passed=False))
    hit = F.col("_oid").isNotNull()
    columns = {name: F.col(name) for name in chemicals.columns}
    for name, value in {"ActivityOID": "_oid", "TFM_OP_ACTIVITY_GlobalID": "_gid"}.items():
        columns[name] = F.when(hit, F.col(value)).otherwise(F.col(name)).alias(name)
    return split_join(chemicals, keys, ["Child_GUID"], "left").select(*columns.values())


def backfill(chemicals: DataFrame, new: DataFrame, activities: DataFrame) -> DataFrame:
    """``chemicals`` with activity keys wherever a GUID is among the new ones, older rows included."""
    return set_activity_keys(chemicals, activity_keys(guids_of(new), activities))
