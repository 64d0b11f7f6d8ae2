"""New activities: routing, keys and geometry from reference tables, and their place in the target table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.functions import scalars as X
from fieldweave.operators.identity import next_object_ids
from fieldweave.operators.joins import Sieve, split_join
from fieldweave.operators.mapping import align, aligned_columns, map_fields

# The two routes, and the categories whose activities cover the whole property.
PROPERTY_ROUTE = "prop"
STAND_ROUTE = "stand"
PROPERTY_CATEGORIES = ["Property", "PropertyE", "PropertyH", "PropertyM"]

# Helper columns that travel with a staged row: its place in the order of reading, its stand and its route.
READ_ORDER = "_read_order"
STAND_KEY = "_stand_oid"
IS_STAND = "_is_stand"


class Routes(NamedTuple):
    property: DataFrame
    stand: DataFrame
    reject: DataFrame


def route(mobile: DataFrame) -> Routes:
    """New activities split into property, stand and rejected ones. Every row is in exactly one part."""
    to = F.col("prop_or_stand")
    known = F.coalesce(to.isin(PROPERTY_ROUTE, STAND_ROUTE), F.lit(False))
    return Routes(mobile.filter(to == PROPERTY_ROUTE), mobile.filter(to == STAND_ROUTE), mobile.filter(~known))


def stage(rows: DataFrame, staging: T.StructType) -> DataFrame:
    """``rows`` in the staging layout, plus their route, reading order and stand."""
    mapped = map_fields(staging, rows.schema)
    is_stand = F.col("prop_or_stand") == STAND_ROUTE
    return rows.select(
        *aligned_columns(mapped, staging), is_stand.alias(IS_STAND), F.col("OBJECTID").alias(READ_ORDER),
        F.col("standOID").alias(STAND_KEY),
    )


def _with(rows: DataFrame, joined: DataFrame, values: dict[str, tuple[Column, str]]) -> DataFrame:
    """The columns of ``rows`` out of ``joined``, those in ``values`` replaced where their condition holds."""
    changed = {
        name: F.when(hit, F.col(value)).otherwise(F.col(name)).alias(name) for name, (hit, value) in values.items()
    }
    return joined.select(*[changed.get(name, name) for name in rows.columns])


def enrich_property(
    rows: DataFrame,
    properties: DataFrame,
    geometry: bool = True,
    global_id: bool = True,
    where: Column | None = None,
) -> DataFrame:
    """Property GlobalID for every category and boundary for the property categories, out of one left join.

    Rows without a match stay as they are, and so do those where ``where`` does not hold, if given.
    """
    parents = properties.select(
        F.col("ObjectID").alias("PropertyOID"), F.col("GlobalID").alias("_gid"), F.col("SHAPE").alias("_shape"),
        F.lit(True).alias("_hit"),
    )
    hit = F.col("_hit").isNotNull() & (F.lit(True) if where is None else where)
    values = {}
    if global_id:
        values["TFM_CMN_PROPERTY_GlobalID"] = (hit, "_gid")
    if geometry:
        values["SHAPE"] = (hit & F.col("Category").isin(PROPERTY_CATEGORIES), "_shape")
    return _with(rows, rows.join(parents, "PropertyOID", "left"), values)


def stand_keys(
    rows: DataFrame, stands: DataFrame, where: Column | None = None, staged: DataFrame | None = None
) -> DataFrame:
    """``rows`` with ``_found``, the stand that each of them gets; only those where ``where`` holds, if given.

    Rows are read by ascending ``OBJECTID``, and each found stand is written to the rows with its GUID read so far. So
    of the rows that share a GUID, those up to the last one with a known stand get that stand, later ones none. Only keys
    are looked at. ``staged`` is a frame with the same keys as ``rows`` that is cheaper to compute, if there is one.
    """
    where = F.lit(True) if where is None else where
    items = (rows if staged is None else staged).filter(where).select("Parent_GUID", STAND_KEY, READ_ORDER)
    known = stands.select(F.col("ObjectID").alias(STAND_KEY))
    last = (
        items.join(known, STAND_KEY, "left_semi").groupBy("Parent_GUID")
        .agg(F.max_by(STAND_KEY, READ_ORDER).alias("_found"), F.max(READ_ORDER).alias("_upto"))
    )
    reached = where & (F.col(READ_ORDER) <= F.col("_upto"))
    given = split_join(rows, last, ["Parent_GUID"], "left").withColumn("_found", F.when(reached, F.col("_found")))
    return given.select(*rows.columns, "_found")


def stand_shapes(rows: DataFrame, stands: DataFrame) -> DataFrame:
    """``rows`` of ``stand_keys`` with key and geometry of their stand.

    Of the stands only those that some row names are moved, while these are few. Rows without a stand, as all
    property rows are, meet nothing: they are dealt out by the order of reading, so they never share one empty key.
    """
    named = rows.select(F.col("_found").alias("ObjectID")).filter("ObjectID is not null").distinct()
    shapes = stands.select("ObjectID", "SHAPE").join(named, "ObjectID", "left_semi").select(
        F.col("ObjectID").alias("_place"), F.lit(True).alias("_placed"), F.col("SHAPE").alias("_shape"))
    placed = F.col("_found").isNotNull()
    dealt = rows.withColumns({"_place": F.coalesce("_found", READ_ORDER), "_placed": placed})
    joined = split_join(dealt, shapes, ["_place", "_placed"], "left")
    columns = rows.drop("_found")
    return _with(columns, joined, {"Parent_OID": (placed, "_found"), "SHAPE": (placed, "_shape")})


def enrich_stand(
    rows: DataFrame, stands: DataFrame, where: Column | None = None, staged: DataFrame | None = None
) -> DataFrame:
    """Stand key and geometry for staged rows; only those where ``where`` holds, if given."""
    return stand_shapes(stand_keys(rows, stands, where, staged), stands)


def unmerged(rows: DataFrame, merged: DataFrame | None, key: str = "OBJECTID") -> DataFrame:
    """``rows`` of the mobile tables that no earlier run has merged, by their own key; ``merged`` has the keys it took."""
    return rows if merged is None else split_join(rows, merged.select(key).distinct(), [key], "left_anti")


def append_new(
    target: DataFrame, staged: DataFrame, properties: DataFrame, stands: DataFrame, dataset: str, highest: int | None = None
) -> DataFrame:
    """New rows of ``target`` out of staged ones, enriched by their route, with ObjectIDs and GlobalIDs.

    ObjectIDs go to property rows first, then to stand rows, each in reading order. Numbers and keys are settled first;
    shapes join in the last two steps.
    """
    rows = next_object_ids(target, staged, IS_STAND, READ_ORDER, highest=highest)
    rows = stand_keys(rows, stands, where=F.col(IS_STAND), staged=staged)
    rows = enrich_property(rows, properties, where=~F.col(IS_STAND))
    rows = stand_shapes(rows, stands)
    return align(rows.withColumn("GlobalID", X.global_id(dataset, "OBJECTID")), target.schema)


def overlay_worklist(activities: DataFrame, stand_items: DataFrame, by: Sieve | None = None) -> DataFrame:
    """``OBJECTID, times`` of the activities that share a GUID with a stand item; one time per such item.

    Items are counted per GUID before the join, so many items with one GUID never meet as pairs. ``by`` is a sieve of
    their GUIDs, if there is one.
    """
    items = stand_items.groupBy("Parent_GUID").agg(F.count("*").alias("times"))
    found = split_join(activities.select("OBJECTID", "Parent_GUID"), items, ["Parent_GUID"], "inner", by)
    return found.select("OBJECTID", "times")


def route_counts(mobile: DataFrame, chemicals: DataFrame) -> DataFrame:
    """``item, rows`` of new property, stand and rejected activities and of new chemicals."""
    to = F.col("prop_or_stand")
    item = F.when(to.isin(PROPERTY_ROUTE, STAND_ROUTE), to).otherwise("reject")
    activities = mobile.groupBy(item.alias("item")).agg(F.count("*").alias("rows"))
    return activities.unionByName(chemicals.agg(F.count("*").alias("rows")).select(F.lit("chemical").alias("item"), "rows"))
