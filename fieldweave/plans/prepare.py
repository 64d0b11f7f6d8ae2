"""Readiness of the data model: identifiers, relations, coded fields and property names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.operators import coded, relations
from fieldweave.operators.identity import add_content_ids, add_global_ids, add_guid_column
from fieldweave.operators.lists import Tables, union
from fieldweave.sources.sinks import copy_dataset
from fieldweave.sources.tables import WITHOUT_GLOBAL_ID

# GUID columns the model needs, and tables split by property.
GUID_COLUMNS = {"activity": "Parent_GUID", "chem_app": "Child_GUID"}
BY_PROPERTY = ["activity", "chem_app"]


def _count(rows: DataFrame, check: str, dataset: str) -> DataFrame:
    total = rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
    return total.select(F.lit(check).alias("check_name"), F.lit(dataset).alias("dataset"), "violations")


def _outside_lists(tables: Tables, lists: DataFrame, bindings: list[coded.FieldList]) -> DataFrame:
    """One check per bound field, with zero for a field without violations."""
    found = coded.domain_violations(tables, lists, bindings)
    name = F.concat_ws(".", "dataset", "field")
    counted = found.groupBy(name.alias("dataset")).agg(F.sum("rows").alias("violations"))
    fields = lists.sparkSession.createDataFrame([(f"{b.dataset}.{b.field}",) for b in bindings], "dataset string")
    return fields.join(counted, "dataset", "left").select(
        F.lit("outside_list").alias("check_name"), "dataset", F.coalesce("violations", F.lit(0)).alias("violations")
    )


def prepare(
    tables: Tables,
    lists: DataFrame,
    rels: list[relations.Relation] = relations.RELATIONS,
    bindings: list[coded.FieldList] = coded.BINDINGS,
) -> DataFrame:
    """``check_name, dataset, violations`` of all checks. ``lists`` is as ``coded.code_lists`` returns it."""
    checks = [relations.check_relation(tables, rel) for rel in rels]
    checks.append(_outside_lists(tables, lists, bindings))
    for dataset in BY_PROPERTY:
        checks.append(_count(coded.unknown_subtypes(tables[dataset], tables["property_flags"]), "unknown_property", dataset))
    return union(checks)


def with_global_ids(tables: Tables) -> dict[str, DataFrame]:
    """The tables that lack GlobalIDs, with them: from the key of a row, or from its values where there is no key."""
    return {
        dataset: add_global_ids(tables[dataset], dataset, key) if key else add_content_ids(tables[dataset], dataset)
        for dataset, key in WITHOUT_GLOBAL_ID.items()
    }


def migrate(tables: Tables, folder: str, rels: list[relations.Relation] = relations.RELATIONS) -> None:
    """Write the tables that preparation changes: GlobalIDs and GUID columns added, children keyed by GlobalID."""
    identified = with_global_ids(tables)
    children_of = {rel.child for rel in rels}
    for dataset in identified:
        if dataset not in children_of:
            copy_dataset(identified[dataset], f"{folder}/{dataset}")
    for rel in rels:
        children = relations.rekey({**tables, **identified}, rel)
        if rel.child in GUID_COLUMNS:
            children = add_guid_column(children, GUID_COLUMNS[rel.child])
        copy_dataset(children, f"{folder}/{rel.child}")
