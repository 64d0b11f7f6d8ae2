"""Copying rows between tables of different layout. Decisions use schemas only and never start a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns the store fills in by itself, compared with their case.
IGNORED = [
    "OBJECTID", "Shape", "SHAPE", "GlobalID", "Shape.STArea()", "Shape.STLength()", "STArea()", "STLength()",
]


def map_fields(target: T.StructType, source: T.StructType, ignore: list[str] = IGNORED) -> list[str]:
    """Source columns, in source order, that the target has under any case."""
    known = {name.lower() for name in target.names if name not in ignore}
    return [name for name in source.names if name not in ignore and name.lower() in known]


def aligned_columns(available: list[str], schema: T.StructType, **values: Column) -> list[Column]:
    """The columns of ``schema`` out of the ``available`` ones by name; NULL where there is none.

    ``values`` overrides columns of the target by name.
    """
    by_name = {name.lower(): F.col(f"`{name}`") for name in available}
    by_name |= {name.lower(): value for name, value in values.items()}
    return [by_name.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]


def align(rows: DataFrame, schema: T.StructType, **values: Column) -> DataFrame:
    """``rows`` in the layout of ``schema``: missing columns NULL, others dropped, types and order of the target."""
    return rows.select(*aligned_columns(rows.columns, schema, **values))


def append_no_test(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` with ``rows`` added by column name, whatever their layout."""
    return target.unionByName(align(rows, target.schema))


def append_mapped(target: DataFrame, rows: DataFrame, ignore: list[str] = IGNORED) -> DataFrame:
    """``target`` with the mapped columns of ``rows`` added."""
    return append_no_test(target, rows.select(*map_fields(target.schema, rows.schema, ignore)))
