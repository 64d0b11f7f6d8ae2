"""Code lists: ``code, description`` of every requested property at once.

Each list keeps the rows of all properties and carries ``property_oid``. DISTINCT stands before the semi-joins: copies
of a row collapse inside the tasks that read them, so a hot property or chemical moves only its distinct rows. Where
the keys are small Catalyst pushes the semi-join below the DISTINCT by itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.functions import scalars as X

# List kinds, the row that stands for an empty list, and the names of the universal lists.
KINDS = ["compartment", "supervisor", "contractor", "species", "chemical"]
PLACEHOLDER_CODE = "1"
PLACEHOLDER_DESCRIPTION = "NA"
UNIVERSAL = ["act_status", "harv_status", "plant_pattern", "plant_stock", "special_point", "special_line", "special_poly"]

Tables = Mapping[str, DataFrame]

CODE_COLUMNS = ["code", "description"]


def property_keys(props: DataFrame) -> DataFrame:
    """The first column of ``props``, as ``property_oid``."""
    return props.select(F.col(props.columns[0]).cast("int").alias("property_oid"))


def requested(props: DataFrame) -> DataFrame:
    """The distinct property keys in the first column of ``props``."""
    return property_keys(props).distinct()


def all_properties(tables: Tables) -> DataFrame:
    return tables["property"].select(F.col("ObjectID").cast("int").alias("property_oid"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _collated_columns(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType) and not f.dataType.isUTF8BinaryCollation()]


def _bytewise(rows: DataFrame) -> list[Column]:
    """The columns of ``rows`` with text compared byte by byte."""
    collated = _collated_columns(rows)
    return [F.collate(name, "UTF8_BINARY").alias(name) if name in collated else F.col(name) for name in rows.columns]


def plain_text(rows: DataFrame) -> DataFrame:
    """``rows`` as they are published: their text has no collation any more."""
    return rows.select(*_bytewise(rows)) if _collated_columns(rows) else rows


def _as_before(rows: DataFrame, before: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.collate(name, before.schema[name].dataType.collation) for name in _collated_columns(before)})


def exact_copies_out(rows: DataFrame) -> DataFrame:
    """``rows`` without copies that are equal byte by byte, whatever their collation."""
    if not _collated_columns(rows):
        return rows.distinct()
    return _as_before(rows.select(*_bytewise(rows)).distinct(), rows)


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``rows`` without repeats.

    Of rows that are equal under the collation of their text the one whose values come first byte by byte stays, column
    by column, so a repeated task or another split into tasks publishes the same rows.
    """
    if not _collated_columns(rows):
        return rows.distinct()
    keys = [F.col(name).alias(f"_key_{n}") for n, name in enumerate(rows.columns)]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*_bytewise(rows))).alias("_first")).select("_first.*")
    return _as_before(first, rows)


def dealt_evenly(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with collated text dealt by a hash of ``keys`` to tasks of the size that Spark aims at; others as they are.

    Rows under a collation are sorted before they are compared, whole and in memory. What a join or DISTINCT of narrow rows has
    made wide is many times the size that their tasks were cut to, so they are cut anew. Spark splits a hot key here, and
    each task still collapses its copies before they move to the rest of their key.
    """
    if not _collated_columns(rows):
        return rows
    return rows.withColumn("_dealt", F.xxhash64(*keys)).hint("rebalance", F.col("_dealt")).select(*rows.columns)


def active(table: DataFrame) -> DataFrame:
    """Active rows, with the property key named ``property_oid``."""
    key = F.col("PropertyOID").cast("int").alias("property_oid")
    kept = [c for c in table.columns if c.lower() not in ("propertyoid", "activeflag")]
    return table.filter(F.col("activeflag") == 1).select(key, *kept)


def of_properties(rows: DataFrame, props: DataFrame) -> DataFrame:
    return rows.join(property_keys(props), "property_oid", "left_semi")


def active_rows(table: DataFrame, props: DataFrame) -> DataFrame:
    """Active rows of the requested properties."""
    return of_properties(active(table), props)


def approved(tables: Tables) -> DataFrame:
    return tables["chem_master"].filter(F.col("GTFF_Approved_IND") == "Y")


def chemical_codes(tables: Tables, *extra: str) -> DataFrame:
    """Distinct active and approved chemicals, named without their location.

    The master row only has to exist, so a semi-join does; its property plays no part here.
    """
    listed = active(tables["chem_view"]).select(
        "property_oid", "CODE", X.strip_location("description").alias("description"), *extra
    )
    keys = approved(tables).select(F.col("ObjectID").alias("CODE"))
    return (
        distinct_rows(dealt_evenly(listed, "property_oid", "CODE")).join(keys, "CODE", "left_semi")
        .select("property_oid", X.text_code("CODE").alias("code"), "description", *extra)
    )


def _codes(table: DataFrame, code: str, description: str) -> DataFrame:
    is_text = isinstance(table.select(code).schema[0].dataType, T.StringType)
    value = F.col(code) if is_text else X.text_code(code)  # a cast would lose the collation of a text
    return active(table).select("property_oid", value.alias("code"), F.col(description).alias("description"))


def list_rows(tables: Tables, kind: str) -> DataFrame:
    """``property_oid, code, description`` of one kind of list. Compartments alone keep repeated rows."""
    return plain_text(_listed(tables, kind))


def _listed(tables: Tables, kind: str) -> DataFrame:
    match kind:
        case "compartment":
            return _codes(tables["compartment"], "CompartmentOID", "description")
        case "supervisor":
            return distinct_rows(_codes(tables["supervisor"], "CODE", "DESCRIPTION"))
        case "contractor":
            return distinct_rows(_codes(tables["contractor"], "Contractor_OID", "DESCRIPTION"))
        case "species":
            return distinct_rows(_codes(tables["species"], "SPECIES_CODE", "SPECIES_DESC"))
        case "chemical":
            return chemical_codes(tables)
    raise ValueError(f"unknown list kind: {kind}")


def _placeholder() -> list[Column]:
    return [F.lit(PLACEHOLDER_CODE).alias("code"), F.lit(PLACEHOLDER_DESCRIPTION).alias("description")]


def domain(tables: Tables, kind: str, props: DataFrame, placeholder: bool = True) -> DataFrame:
    """One kind of list for the requested properties; an empty list becomes the placeholder row."""
    every = list_rows(tables, kind)
    rows = of_properties(every, props)
    if not placeholder:
        return rows
    filled = every.select("property_oid").distinct()
    empty = requested(props).join(filled, "property_oid", "left_anti")
    return rows.unionByName(empty.select("property_oid", *_placeholder()))


def property_lists(tables: Tables, props: DataFrame, kinds: list[str] = KINDS) -> DataFrame:
    """``kind, property_oid, code, description`` of all lists of the requested properties, placeholders included.

    A filter on ``kind`` leaves only that list's source to read.
    """
    rows = union([list_rows(tables, kind).select(F.lit(kind).alias("kind"), "*") for kind in kinds])
    filled = rows.select("kind", "property_oid").distinct()
    wanted = requested(props).withColumn("kind", F.explode(F.array(*[F.lit(kind) for kind in kinds])))
    empty = wanted.join(filled, ["property_oid", "kind"], "left_anti").select("kind", "property_oid", *_placeholder())
    return of_properties(rows, props).select("kind", "property_oid", *CODE_COLUMNS).unionByName(empty)


def domain_all(tables: Tables, props: DataFrame, kinds: list[str] = KINDS) -> DataFrame:
    """``domain_name, property_oid, code, description`` of all lists of the requested properties."""
    name = X.list_name("property_oid", "kind").alias("domain_name")
    return property_lists(tables, props, kinds).select(name, "property_oid", *CODE_COLUMNS)


def hardcoded_lists(tables: Tables, props: DataFrame) -> DataFrame:
    """``property_oid, list_name, code, description`` of three lists, without placeholder."""
    kinds = ["compartment", "supervisor", "contractor"]
    rows = union([list_rows(tables, kind).withColumn("list_name", F.lit(kind)) for kind in kinds])
    return of_properties(rows, props).select("property_oid", "list_name", *CODE_COLUMNS)


def universal_domains(tables: Tables, names: list[str] = UNIVERSAL) -> DataFrame:
    """``list_name, code, description`` of the lists that hold for every property.

    Rows collapse in the tasks that read them, so what is shuffled is the size of the lists.
    """
    plain = {
        "act_status": "status_code",
        "harv_status": "harvest_status",
        "plant_pattern": "plant_pattern",
        "plant_stock": "plant_stock",
    }
    rows = [
        tables[source].select(F.lit(name).alias("list_name"), F.col("CODE").alias("code"), F.col("DESCRIPTION").alias("description"))
        for name, source in plain.items() if name in names
    ]
    for name in [name for name in UNIVERSAL[len(plain):] if name in names]:
        rows.append(
            tables[name].select(
                F.lit(name).alias("list_name"),
                X.pair_label("sp_type", "sp_subtype").alias("code"),
                X.pair_label("sp_type_desc", "sp_subtype_desc").alias("description"),
            )
        )
    if any(_collated_columns(part) for part in rows):
        return union([plain_text(distinct_rows(part)) for part in rows])
    return union(rows).distinct()


def domain_sizes(domains: DataFrame, name: str = "domain_name") -> DataFrame:
    """Rows per list. Only lists with rows appear, and only those are published."""
    return domains.groupBy(name).agg(F.count("*").alias("rows"))
