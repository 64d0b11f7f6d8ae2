"""The list procedures by name, as SQL table functions of a property, for one or for any set of them by ``LATERAL``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldweave.operators import cascade, lists
from fieldweave.operators.lists import Tables

# The names that callers use, by the list that each returns.
BY_KIND = {
    "chemical": "MOBILE_GET_ChemicalOIDs_propertyOID",
    "compartment": "MOBILE_GET_CompartmentOIDs_propertyOID",
    "contractor": "MOBILE_GET_ContractorOIDs_propertyOID",
    "species": "MOBILE_GET_PlantingSpecies_propertyOID",
    "supervisor": "MOBILE_GET_SupervisorOIDs_propertyOID",
}
HARDCODED = "MOBILE_GET_HardcodedLists_propertyOID"
UNIVERSAL = "MOBILE_GET_UniversalDomains"
CHEM_DEFAULTS = "MOBILE_Update_chemdefaults_propertyOID"
ITEMSETS = "MOBILE_Update_itemsets_propertyOID"


def _view(rows: DataFrame, function: str) -> str:
    name = f"rows_of_{function}"
    rows.createOrReplaceTempView(name)
    return name


def _function(spark: SparkSession, name: str, rows: DataFrame, by_property: bool = True, placeholder: bool = False) -> None:
    """A table function over the rows of all properties: a call is a filter, a call for each property a join."""
    view = _view(rows, name)
    columns = [f for f in rows.schema.fields if not (by_property and f.name == "property_oid")]
    returned = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    body = f"SELECT {', '.join(f.name for f in columns)} FROM {view}"
    if placeholder:
        # An empty list is one row, whether or not the property is known.
        empty = {"code": lists.PLACEHOLDER_CODE, "description": lists.PLACEHOLDER_DESCRIPTION}
        values = ", ".join(f"if(item.property_oid IS NULL, '{text}', item.{name}) AS {name}" for name, text in empty.items())
        body = f"SELECT {values} FROM (SELECT 1) LEFT JOIN {view} item ON item.property_oid = propertyOID"
    elif by_property:
        body += " WHERE property_oid = propertyOID"
    parameter = "propertyOID INT" if by_property else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter}) RETURNS TABLE ({returned}) RETURN {body}")


def register(spark: SparkSession, tables: Tables) -> list[str]:
    """Make the nine procedures callable in the session; returns their names.

    Their plans hold the rows of all properties once, however many properties a call is for.
    """
    props = lists.all_properties(tables)
    for kind, name in BY_KIND.items():
        _function(spark, name, lists.list_rows(tables, kind), placeholder=True)
    _function(spark, HARDCODED, lists.hardcoded_lists(tables, props))
    _function(spark, UNIVERSAL, lists.universal_domains(tables), by_property=False)
    _function(spark, CHEM_DEFAULTS, cascade.chem_defaults(tables, props))
    _function(spark, ITEMSETS, cascade.itemsets(tables, props, ordered=False))
    return [*BY_KIND.values(), HARDCODED, UNIVERSAL, CHEM_DEFAULTS, ITEMSETS]
