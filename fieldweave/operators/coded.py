"""Coded values: descriptions of codes, values outside their list, property names."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from fieldweave.operators.joins import split_join
from fieldweave.operators.lists import KINDS, UNIVERSAL, Tables, property_lists, union, universal_domains


class FieldList(NamedTuple):
    dataset: str
    field: str
    list_name: str
    per_property: bool


# Which list each field takes its codes from.
BINDINGS = [
    FieldList("activity", "Supervisor", "supervisor", True),
    FieldList("activity", "Contractor_OID", "contractor", True),
    FieldList("activity", "COMPARTMENTOID", "compartment", True),
    FieldList("activity", "REG_Species", "species", True),
    FieldList("chem_app", "MasterChemOID", "chemical", True),
    FieldList("activity", "Status", "act_status", False),
    FieldList("activity", "REG_Pattern", "plant_pattern", False),
    FieldList("activity", "REG_Stock_Type", "plant_stock", False),
    FieldList("hv_unit", "Status", "harv_status", False),
    FieldList("special_point", "sp_type", "special_point", False),
    FieldList("special_line", "sp_type", "special_line", False),
    FieldList("special_poly", "sp_type", "special_poly", False),
]


def bindings_of(dataset: str, per_property: bool | None = None) -> list[FieldList]:
    return [b for b in BINDINGS if b.dataset == dataset and per_property in (None, b.per_property)]


def code_lists(tables: Tables, props: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """``list_name, property_oid, code, description`` of the properties' lists and the universal ones.

    Of the lists only those with the given names, if any are given; the others' sources are not read.
    """
    names = [*KINDS, *UNIVERSAL] if names is None else list(names)
    parts = []
    if kinds := [kind for kind in KINDS if kind in names]:
        parts.append(property_lists(tables, props, kinds).withColumnRenamed("kind", "list_name"))
    if universal := [name for name in UNIVERSAL if name in names]:
        parts.append(universal_domains(tables, universal).withColumn("property_oid", F.lit(None).cast("int")))
    return union(parts)


def published_code_lists(domains: DataFrame, universal: DataFrame) -> DataFrame:
    """The same out of the tables that the lists were published to.

    Decode and check with stored lists, these or a stored ``code_lists``: the size of a stored list is known beforehand,
    so while it is small it goes to the rows and the rows stay where they are.
    """
    kind = F.substring_index("domain_name", "_", -1).alias("list_name")
    own = domains.select(kind, "property_oid", "code", "description")
    return own.unionByName(universal.withColumn("property_oid", F.lit(None).cast("int")))


def _value(number: int, b: FieldList, code: str, place: str) -> str:
    """A bound field as a SQL struct of its number, its list, the property that the list belongs to, if any, and the code."""
    place = place if b.per_property else "NULL"
    return (f"named_struct('number', {number}, 'list_name', '{b.list_name}', 'place', cast({place} AS int), "
            f"'code', cast({code} AS string))")


def dictionary(lists: DataFrame, names: Iterable[str]) -> DataFrame:
    """``list_name, place, code, description``, each code once: one with several descriptions gets the alphabetically first."""
    own = lists.filter(F.col("list_name").isin(*names)).withColumnRenamed("property_oid", "place")
    return own.groupBy("list_name", "place", "code").agg(F.min("description").alias("description"))


def decode(rows: DataFrame, bindings: list[FieldList], lists: DataFrame, property_field: str = "PropertyOID") -> DataFrame:
    """``rows`` with ``<field>_description`` for each bound field; NULL where the list lacks the code.

    All fields meet the lists in one join, whatever their number. Rows with the same codes collapse first; each
    combination gives one narrow row per field, finds its descriptions, is put together again and goes back to the rows.
    So the rows themselves are shuffled twice at most: their codes once, and they once. A code listed with several
    descriptions gets the alphabetically first, so no row is ever repeated.
    """
    place = [F.col(property_field).cast("int").alias("place")] if any(b.per_property for b in bindings) else []
    codes = [F.col(f"`{b.field}`").cast("string").alias(f"code_{n}") for n, b in enumerate(bindings)]
    combined = rows.withColumn("_codes", F.struct(*place, *codes))
    each = ", ".join(_value(n, b, f"_codes.code_{n}", "_codes.place") for n, b in enumerate(bindings))
    single = combined.select("_codes").distinct().selectExpr("_codes", f"inline(array({each}))").filter("code IS NOT NULL")
    # A property or the lack of one is a key like any other.
    keyed = lambda df: df.withColumns({"_all": F.col("place").isNull(), "place": F.coalesce("place", F.lit(0))})
    known = keyed(dictionary(lists, dict.fromkeys(b.list_name for b in bindings)))
    found = split_join(keyed(single), known, ["list_name", "_all", "place", "code"], "inner")
    texts = [F.max(F.when(F.col("number") == n, F.col("description"))).alias(f"_text_{n}") for n in range(len(bindings))]
    decoded = split_join(combined, found.groupBy("_codes").agg(*texts), ["_codes"], "left")
    return decoded.select(*rows.columns, *[F.col(f"_text_{n}").alias(f"{b.field}_description") for n, b in enumerate(bindings)])


def coded_values(tables: Tables, bindings: list[FieldList], property_field: str = "PropertyOID") -> DataFrame:
    """``dataset, field, list_name, property_oid, code, rows`` of the values in bound fields; one scan per dataset.

    Values are counted under the number of their binding, over all datasets at once; its names join the counts after.
    """
    def label(names: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(name) for name in names]), F.col("number"))

    found = []
    for dataset in dict.fromkeys(b.dataset for b in bindings):
        fields = [_value(number, b, b.field, property_field) for number, b in enumerate(bindings, 1) if b.dataset == dataset]
        found.append(tables[dataset].selectExpr(f"inline(array({', '.join(fields)}))").filter("code IS NOT NULL"))
    values = union(found).select("number", F.col("place").alias("property_oid"), "code")
    counted = values.groupBy("number", "property_oid", "code").agg(F.count("*").alias("rows"))
    return counted.select(
        label([b.dataset for b in bindings]).alias("dataset"), label([b.field for b in bindings]).alias("field"),
        label([b.list_name for b in bindings]).alias("list_name"), "property_oid", "code", "rows",
    )


def violations(values: DataFrame, lists: DataFrame) -> DataFrame:
    """The values, as ``coded_values`` counts them, that their list lacks. NULL is no violation.

    Equal values are counted before they meet the lists, so neither a common value nor a large property travels row by
    row.
    """
    v, k = values.alias("v"), lists.select("list_name", "property_oid", "code").distinct().alias("k")
    match = (
        (F.col("v.list_name") == F.col("k.list_name")) & (F.col("v.code") == F.col("k.code"))
        & F.col("v.property_oid").eqNullSafe(F.col("k.property_oid"))
    )
    return v.join(k, match, "left_anti").select(*values.columns)


def domain_violations(tables: Tables, lists: DataFrame, bindings: list[FieldList] = BINDINGS) -> DataFrame:
    """Violations of all bound fields."""
    return violations(coded_values(tables, bindings), lists)


def subtypes(flags: DataFrame) -> DataFrame:
    """``property_oid, property_name`` out of the property keys."""
    return flags.select(X.flag_oid("prop_key").alias("property_oid"), X.flag_name("prop_key").alias("property_name"))


def decode_subtype(rows: DataFrame, flags: DataFrame, property_field: str = "PropertyOID") -> DataFrame:
    """``rows`` with their ``property_name``; NULL where the property is unknown."""
    names = subtypes(flags).withColumnRenamed("property_oid", property_field)
    return rows.join(names, property_field, "left").select(*rows.columns, "property_name")


def unknown_subtypes(rows: DataFrame, flags: DataFrame, property_field: str = "PropertyOID") -> DataFrame:
    """``property_oid, rows`` of the properties in ``rows`` that have no name; NULL counts as one of them."""
    counted = rows.groupBy(F.col(property_field).cast("int").alias("property_oid")).agg(F.count("*").alias("rows"))
    return counted.join(subtypes(flags), "property_oid", "left_anti")
