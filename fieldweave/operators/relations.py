"""One-to-many relations between tables: navigation, integrity checks and the change to GlobalID keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.operators.lists import Tables, union


class Relation(NamedTuple):
    name: str
    parent: str
    parent_key: str
    child: str
    child_key: str
    rekeyed: str | None = None  # column for the parent's GlobalID; None keeps the key as it is


# The four relations of the data model.
RELATIONS = [
    Relation("Property_PropAct", "property", "ObjectID", "activity", "PropertyOID", "TFM_CMN_PROPERTY_GlobalID"),
    Relation("Activity_Chemical_Existing", "activity", "OBJECTID", "chem_app", "ActivityOID", "TFM_OP_ACTIVITY_GlobalID"),
    Relation("Activity_Chemical_New", "activity_mobile", "Parent_GUID", "chem_mobile", "Child_GUID"),
    Relation("HVunit_OPTproduct", "hv_unit", "ObjectID", "hv_optprod", "HUOID", "HVUnit_GlobalID"),
]


def relation(name: str) -> Relation:
    return next(r for r in RELATIONS if r.name == name)


def _prefixed(table: DataFrame, prefix: str, columns: list[str] | None) -> DataFrame:
    return table.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns or table.columns])


def relate(
    tables: Tables,
    rel: Relation,
    how: str = "inner",
    parent_columns: list[str] | None = None,
    child_columns: list[str] | None = None,
) -> DataFrame:
    """Related rows as ``parent_*`` and ``child_*`` columns.

    ``inner`` and ``left`` go from parents to children, ``left`` with a row for a parent without children as well;
    ``backward`` goes from every child to its parent if it has one. Name the columns wanted: only those are read.

    The children, of which one parent may have very many, are never the side of an outer join that must stay in one
    piece: ``left`` adds the childless parents to the inner join.
    """
    parent_keys = [rel.parent_key, *[c for c in parent_columns or tables[rel.parent].columns if c != rel.parent_key]]
    child_keys = [rel.child_key, *[c for c in child_columns or tables[rel.child].columns if c != rel.child_key]]
    parents = _prefixed(tables[rel.parent], "parent", parent_keys)
    children = _prefixed(tables[rel.child], "child", child_keys)
    match = F.col(f"parent_{rel.parent_key}") == F.col(f"child_{rel.child_key}")
    joined = children.join(parents, match, "left" if how == "backward" else "inner")
    joined = joined.select(*parents.columns, *children.columns)
    if how != "left":
        return joined
    used = children.select(f"child_{rel.child_key}").distinct()
    return joined.unionByName(parents.join(used, match, "left_anti"), allowMissingColumns=True)


def _key(rel: Relation, column: str) -> Column:
    return F.col(column).cast("string")


def orphans(tables: Tables, rel: Relation) -> DataFrame:
    """``relation, child_key, rows`` of the child keys that no parent has. A missing key is no orphan.

    Children are counted per key before they meet the parents, so a hot key is one row by then.
    """
    keys = tables[rel.child].filter(F.col(rel.child_key).isNotNull()).groupBy(F.col(rel.child_key).alias("key"))
    lost = keys.agg(F.count("*").alias("rows")).join(
        tables[rel.parent].select(F.col(rel.parent_key).alias("key")), "key", "left_anti"
    )
    return lost.select(F.lit(rel.name).alias("relation"), _key(rel, "key").alias("child_key"), "rows")


def childless(tables: Tables, rel: Relation) -> DataFrame:
    """``relation, parent_key`` of the parents without children."""
    used = tables[rel.child].select(F.col(rel.child_key).alias("key")).distinct()
    parents = tables[rel.parent].select(F.col(rel.parent_key).alias("key")).join(used, "key", "left_anti")
    return parents.select(F.lit(rel.name).alias("relation"), _key(rel, "key").alias("parent_key"))


def repeated_parents(tables: Tables, rel: Relation) -> DataFrame:
    """``relation, parent_key, rows`` of the keys that several parents share, which a one-to-many relation forbids."""
    counts = tables[rel.parent].groupBy(F.col(rel.parent_key).alias("key")).agg(F.count("*").alias("rows"))
    return counts.filter("rows > 1").select(F.lit(rel.name).alias("relation"), _key(rel, "key").alias("parent_key"), "rows")


def check_relation(tables: Tables, rel: Relation) -> DataFrame:
    """``check_name, dataset, violations`` of the three checks: orphaned children, parents without children, shared keys.

    Counting the children and parents of each key settles all three with one scan of each table and one shuffle, of
    which every task first adds up its own rows.
    """
    children = tables[rel.child].filter(F.col(rel.child_key).isNotNull())
    both = children.selectExpr(f"{rel.child_key} AS key", "1 AS child", "0 AS parent").union(
        tables[rel.parent].selectExpr(f"{rel.parent_key} AS key", "0 AS child", "1 AS parent")
    )
    per_key = both.groupBy("key").agg(F.sum("child").alias("children"), F.sum("parent").alias("parents"))
    totals = per_key.selectExpr(
        "coalesce(sum(children) FILTER (WHERE parents = 0), 0) AS orphans",
        "coalesce(sum(parents) FILTER (WHERE children = 0), 0) AS childless",
        "count_if(parents > 1) AS repeated_parents",
    )
    checks = ", ".join(f"'{check}', {check}" for check in totals.columns)
    return totals.selectExpr(f"stack({len(totals.columns)}, {checks}) AS (check_name, violations)").select(
        "check_name", F.lit(rel.name).alias("dataset"), "violations"
    )


def rekey(tables: Tables, rel: Relation) -> DataFrame:
    """Children with the parent's GlobalID in the relation's own column; NULL where there is no parent."""
    children = tables[rel.child]
    if rel.rekeyed is None:
        return children
    parents = tables[rel.parent].select(F.col(rel.parent_key).alias(rel.child_key), F.col("GlobalID").alias("_gid"))
    kept = [name for name in children.columns if name.lower() != rel.rekeyed.lower()]
    return children.select(*kept).join(parents, rel.child_key, "left").select(*kept, F.col("_gid").alias(rel.rekeyed))
