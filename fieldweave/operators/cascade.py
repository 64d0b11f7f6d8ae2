"""Cascading-choice table and default costs of the field forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from fieldweave.operators.joins import split_join
from fieldweave.operators.lists import (
    Tables, active, approved, chemical_codes, dealt_evenly, distinct_rows, exact_copies_out, of_properties, union,
)
from fieldweave.sources.tables import collated

# Columns of the choice table and its ten lists.
LAYOUT = [
    "list_name", "name", "label", "p_category", "p_type", "s_category", "s_type", "prop_or_stand", "s_subtype", "inv_loc",
    "REG_Species",
]
BRANCHES = [
    "p_category", "p_type", "p_subtype", "s_category", "s_type", "s_subtype", "inv_loc", "chem_masterOID", "REG_Species",
    "REG_Variety",
]

# Locations, and subtypes, of a property that meet in one cell of its grid.
PAIR_SIDE = 256


def _entry(list_name: str, name: str, label: str, **others: str) -> str:
    """One row of the choice table as a SQL struct; columns not given are NULL."""
    values = {"list_name": f"'{list_name}'", "name": name, "label": label, **others}
    fields = ", ".join(f"'{column}', cast({values.get(column, 'NULL')} AS string)" for column in LAYOUT)
    return f"named_struct({fields})"


def _property_rows(tables: Tables) -> DataFrame:
    categories = active(tables["property_category"]).withColumnRenamed("category", "Category")
    return exact_copies_out(active(tables["property_type"])).join(categories, ["property_oid", "Category"], "left_semi")


def _stand_rows(tables: Tables) -> DataFrame:
    return active(tables["stand_type"])


def _species_rows(tables: Tables) -> DataFrame:
    return active(tables["species"])


# The lists that come straight from one source each; all lists of a source come out of a single scan.
SOURCES = [
    (_property_rows, {
        "p_category": _entry("p_category", "Category", "Category_desc", prop_or_stand="'prop'"),
        "p_type": _entry("p_type", "type_name", "type_desc", p_category="Category"),
        "p_subtype": _entry("p_subtype", "subtype", "subtype_desc", p_type="type_name"),
    }),
    (_stand_rows, {
        "s_category": _entry("s_category", "Category", "Category_desc", prop_or_stand="'stand'"),
        "s_type": _entry("s_type", "type_name", "type_desc", s_category="Category"),
        "s_subtype": _entry("s_subtype", "subtype", "subtype_desc", s_type="type_name"),
    }),
    (_species_rows, {
        "REG_Species": _entry("REG_Species", "SPECIES_CODE", "SPECIES_DESC", prop_or_stand="'stand'"),
        "REG_Variety": _entry("REG_Variety", "Variety_Code", "Variety_DESC", REG_Species="SPECIES_CODE"),
    }),
]


def _plain_lists(tables: Tables, branches: list[str]) -> list[DataFrame]:
    found = []
    for rows, entries in SOURCES:
        if wanted := [entry for name, entry in entries.items() if name in branches]:
            found.append(rows(tables).selectExpr("property_oid", f"inline(array({', '.join(wanted)}))"))
    return found


def _dealt(rows: DataFrame, grids: DataFrame, value: str, own: str, other: str) -> DataFrame:
    """``rows`` in their place on one axis of their property's grid, ``own``, once for each place on the ``other`` one."""
    placed = split_join(rows, grids, ["property_oid"], "inner")
    place = F.pmod(F.xxhash64(F.collate(value, "UTF8_BINARY")), F.col(f"{own}s")).cast("int")
    return placed.select(*rows.columns, place.alias(own), F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other))


def _locations(tables: Tables, props: DataFrame, side: int) -> DataFrame:
    """Every inventory location of a property with every chemical subtype there, if the property has an approved chemical.

    The result holds all pairs of a property by definition. Both sides are distinct first, so no pair is made twice. By
    their measured numbers the pairs of a property are dealt to a grid of cells with about ``side`` locations and ``side``
    subtypes each. A property with no more of either is one cell, without copies of its rows; a large one has as many
    cells as it takes, and each is made by whatever task it falls to.
    """
    subtypes = active(tables["act_type"]).filter(F.col("IS_CHEMICAL_IND") == 1).select("property_oid", "subtype")
    chemicals = approved(tables).select(F.col("PropertyOID").cast("int").alias("property_oid"))
    subtypes = of_properties(split_join(distinct_rows(subtypes), chemicals.distinct(), ["property_oid"], "left_semi"), props)
    places = exact_copies_out(active(tables["chem_view"]).select("property_oid", "Inventory_Location"))
    # Few by now, as rows under a collation are sorted whole; without the exchange Catalyst drops the first DISTINCT.
    places = of_properties(distinct_rows(dealt_evenly(places, "property_oid", "Inventory_Location")), props)

    def cells(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("property_oid").agg(F.ceil(F.count("*") / side).cast("int").alias(name))

    grids = cells(places, "rows").join(cells(subtypes, "columns"), "property_oid")
    dealt = _dealt(places, grids, "Inventory_Location", "row", "column")
    pairs = dealt.join(_dealt(subtypes, grids, "subtype", "column", "row"), ["property_oid", "row", "column"])
    entry = _entry("inv_loc", "Inventory_Location", "Inventory_Location", s_subtype="subtype")
    return pairs.selectExpr("property_oid", f"inline(array({entry}))")


def _chemicals(tables: Tables) -> DataFrame:
    entry = _entry("chem_masterOID", "code", "description", inv_loc="Inventory_Location")
    return chemical_codes(tables, "Inventory_Location").selectExpr("property_oid", f"inline(array({entry}))")


def choice_order() -> list[Column | str]:
    """Property, then list name regardless of case, then every other column, so equal lists come out in equal order."""
    return ["property_oid", F.lower("list_name"), *LAYOUT]


def itemsets(
    tables: Tables,
    props: DataFrame,
    branches: list[str] = BRANCHES,
    ordered: bool = True,
    side: int = PAIR_SIDE,
    collation: str | None = None,
) -> DataFrame:
    """Choice table of the requested properties: ``property_oid`` and the eleven columns of ``LAYOUT``.

    Lists never share a row, as each has its own name, so one DISTINCT serves the lists that need it. Chemicals and
    location pairs are distinct by construction and are not shuffled again for it. Under a ``collation`` rows that are
    equal for it count as one, the one that comes first byte by byte; give the tables the same one.
    """
    frames = []
    if plain := _plain_lists(tables, branches):
        rows = union(plain)
        if collation:
            texts = [F.col(name).cast("string").alias(name) for name in LAYOUT]
            rows = distinct_rows(collated(rows, collation)).select("property_oid", *texts)
        else:
            rows = rows.distinct()
        frames.append(of_properties(rows, props))
    if "chem_masterOID" in branches:
        frames.append(of_properties(_chemicals(tables), props))
    if "inv_loc" in branches:
        frames.append(_locations(tables, props, side))
    rows = union(frames)
    return rows.orderBy(*choice_order()) if ordered else rows


def chem_defaults(tables: Tables, props: DataFrame) -> DataFrame:
    """``property_oid, cost, rate, chem_masterOID`` of approved chemicals, one row per active location.

    The property is that of the chemical's master row, and rows repeat as often as the chemical is listed.
    """
    listed = tables["chem_view"].filter(F.col("activeflag") == 1).select(F.col("CODE").alias("ObjectID"))
    masters = approved(tables).withColumn("property_oid", F.col("PropertyOID").cast("int"))
    rows = listed.join(of_properties(masters, props), "ObjectID")
    return rows.select(
        "property_oid",
        F.col("Default_Cost_per_unit").alias("cost"),
        F.col("DefaultRate").alias("rate"),
        X.lookup_key("ObjectID").alias("chem_masterOID"),
    )
