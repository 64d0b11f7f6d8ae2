"""Refreshing the lists of the properties that were marked as changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.operators import control
from fieldweave.operators.cascade import LAYOUT, chem_defaults, choice_order, itemsets
from fieldweave.operators.lists import Tables, domain_all, universal_domains
from fieldweave.sources.named_files import write_named
from fieldweave.sources.sinks import publish_changed, stored, write_code_lists, write_csv


def refresh(tables: Tables, flags: DataFrame, forms: DataFrame) -> DataFrame:
    """``property_oid, list_name, rows, forms_found`` of all lists of the changed properties.

    The code lists cover every changed property, the choice table and default costs only those with a form.
    """
    props = control.changed_properties(flags).select("property_oid")
    found = control.match_forms(props, forms).groupBy("property_oid").agg(F.count("*").alias("forms_found"))

    def sizes(rows: DataFrame, name: Column, needs_form: bool) -> DataFrame:
        counted = rows.groupBy("property_oid", name.alias("list_name")).agg(F.count("*").alias("rows"))
        return counted.withColumn("needs_form", F.lit(needs_form))

    key = F.col("property_oid").cast("string")
    lists = sizes(domain_all(tables, props), F.col("domain_name"), False)
    choices = sizes(itemsets(tables, props, ordered=False), F.concat(key, F.lit("itemsets")), True)
    costs = sizes(chem_defaults(tables, props), F.concat(key, F.lit("chemdefaults")), True)
    total = lists.unionByName(choices).unionByName(costs).join(found, "property_oid", "left")
    total = total.filter(~F.col("needs_form") | F.col("forms_found").isNotNull())
    return total.select("property_oid", "list_name", "rows", F.coalesce("forms_found", F.lit(0)).alias("forms_found"))


def write_form_files(choices: DataFrame, costs: DataFrame, folder: str) -> None:
    """``<oid>itemsets.csv`` in the order of the choice table and ``<oid>chemdefaults.csv`` by chemical, for each property."""
    key = F.col("property_oid").cast("string")
    own = ["property_oid"]
    write_named(choices.select(*own, *LAYOUT), folder, F.concat(key, F.lit("itemsets.csv")), choice_order()[1:], hidden=own)
    write_named(costs, folder, F.concat(key, F.lit("chemdefaults.csv")), ["chem_masterOID", "cost", "rate"], hidden=own)


def publish(
    tables: Tables, flags: DataFrame, forms: DataFrame, folder: str, ignore: list[str] | None = None
) -> DataFrame:
    """Write the lists of the changed properties, all universal lists and the reset flags; returns the properties without a form.

    Of the properties' lists only those are written whose rows have changed since they were published last. The choice
    table and default costs of a property with a form are in ``media`` as files of their own as well, ``<oid>itemsets.csv``
    and ``<oid>chemdefaults.csv``. The flags come last, so a run that stops half way is repeated with the same properties.
    """
    props = stored(control.changed_properties(flags).select("property_oid"), f"{folder}/changed")
    matches = stored(control.match_forms(props, forms), f"{folder}/forms")
    with_form = matches.select("property_oid").distinct()
    publish_changed(domain_all(tables, props), f"{folder}/domains", f"{folder}/state")
    write_code_lists(universal_domains(tables), f"{folder}/universal")
    choices = stored(itemsets(tables, with_form, ordered=False), f"{folder}/state/itemsets")
    costs = stored(chem_defaults(tables, with_form), f"{folder}/state/chemdefaults")
    write_csv(choices.orderBy(*choice_order()), f"{folder}/itemsets", ordered=True)
    write_csv(costs, f"{folder}/chemdefaults")
    write_form_files(choices, costs, f"{folder}/media")
    missing = stored(control.missing_forms(props, matches), f"{folder}/missing")
    stored(control.reset_flags(flags, ignore), f"{folder}/flags")
    return missing
