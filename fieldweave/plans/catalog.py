"""Every query by name, as a function of the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from fieldweave.operators import activities as A
from fieldweave.operators import cascade, chemicals, coded, control, identity, lists, mapping
from fieldweave.operators import relations as R
from fieldweave.plans import office, prepare, procedures, refresh, sync
from fieldweave.sources import named_files, sinks, tables as S
from fieldweave.sources.store import Store
from fieldweave.streaming import inbox

Query = Callable[[S.BoundTables], DataFrame]

# Fields read from a new activity, and key prefixes that a reset leaves alone in the examples.
MOBILE_FIELDS = ["OBJECTID", "Parent_GUID", "prop_or_stand", "PropertyOID", "standOID"]
KEPT_PREFIXES = ["000", "006", "012"]

# Tables whose text the collated queries compare without regard to case.
COLLATED = ["supervisor", "contractor", "species", "compartment", "chem_view", "property_type", "property_category", "stand_type", "act_type"]

# Buckets of the small stores that queries make.
QUERY_BUCKETS = 8


def _session(t: S.BoundTables) -> SparkSession:
    return t["property"].sparkSession


def _work_folder(t) -> str:
    return sinks.work_folder(_session(t))


def _domain(kind: str) -> Query:
    return lambda t: lists.domain(t, kind, lists.all_properties(t))


def _branch(name: str) -> Query:
    return lambda t: cascade.itemsets(t, lists.all_properties(t), [name], ordered=False)


def _all_lists(t) -> DataFrame:
    return lists.domain_all(t, lists.all_properties(t))


def _code_lists(t, names: list[str] | None = None) -> DataFrame:
    """The named lists or all, stored as they are once published: Spark knows their size, and small ones go to the rows."""
    return sinks.stored(coded.code_lists(t, lists.all_properties(t), names), _work_folder(t))


def _changed(t) -> DataFrame:
    return control.changed_properties(t["property_flags"])


def _activity_staging(t):
    return S.staging_schema(t["activity"], "activity")


def _staged(t, rows: DataFrame) -> DataFrame:
    """Staged rows in the layout of the activity table, with the key they were read by."""
    numbered = rows.withColumn("OBJECTID", F.col(A.READ_ORDER))
    return mapping.align(numbered, t["activity"].schema).drop("GlobalID")


def _active_rows(t) -> DataFrame:
    names = ["compartment", "contractor", "supervisor", "species", "stand_type", "act_type", "chem_view"]
    return lists.union([
        lists.active_rows(t[name], _changed(t)).groupBy("property_oid").agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("dataset"), "property_oid", "rows")
        for name in names
    ])


def _typed_codes(t) -> DataFrame:
    props = lists.all_properties(t)
    return lists.union([
        lists.domain(t, kind, props).select(F.lit(kind).alias("kind"), "code", X.integer_code("code").alias("integer_code"))
        for kind in lists.KINDS
    ])


def _read_code_lists(t) -> DataFrame:
    folder = _work_folder(t)
    sinks.write_code_lists(lists.universal_domains(t), folder)
    return sinks.read_code_lists(_session(t), folder)


def _csv_roundtrip(t) -> DataFrame:
    folder = _work_folder(t)
    sinks.write_csv(cascade.itemsets(t, lists.all_properties(t)), folder, ordered=True)
    schema = ", ".join(f"{name} string" for name in cascade.LAYOUT) + ", property_oid int"
    return sinks.read_csv(_session(t), folder, schema)


def _domain_replace(t) -> DataFrame:
    folder = _work_folder(t)
    sinks.replace_domains(_all_lists(t).withColumn("description", F.lit("old")), folder)
    sinks.replace_domains(lists.domain_all(t, _changed(t)), folder)
    schema = "property_oid int, code string, description string, domain_name string"
    return _session(t).read.schema(schema).parquet(folder)


def _truncate(t) -> DataFrame:
    folder = _work_folder(t)
    sinks.copy_dataset(t["activity"], folder)
    sinks.truncate(_session(t), folder)
    return _session(t).read.parquet(folder)


def _copy(t) -> DataFrame:
    folder = _work_folder(t)
    sinks.copy_dataset(t["activity_mobile"], folder)
    return _session(t).read.parquet(folder)


def _chemical_staging(t):
    return S.staging_schema(t["chem_app"], "chem_app")


def _actual(t) -> DataFrame:
    return chemicals.actual(t["chem_mobile"], _chemical_staging(t))


def _routes(t) -> DataFrame:
    parts = A.route(t["activity_mobile"])
    return lists.union([
        rows.select("OBJECTID", "Parent_GUID", F.lit(name).alias("route"))
        for name, rows in zip(["prop", "stand", "reject"], parts)
    ])


def _staged_property_rows(t) -> DataFrame:
    return A.stage(A.route(t["activity_mobile"]).property, _activity_staging(t))


def _property_global_id(t) -> DataFrame:
    rows = A.enrich_property(_staged_property_rows(t), t["property"], geometry=False)
    return _staged(t, rows).select("OBJECTID", "PropertyOID", "TFM_CMN_PROPERTY_GlobalID")


def _property_geometry(t) -> DataFrame:
    rows = A.enrich_property(_staged_property_rows(t), t["property"], global_id=False)
    return _staged(t, rows).select("OBJECTID", "PropertyOID", "CATEGORY", "SHAPE")


def _stand(t) -> DataFrame:
    return _staged(t, sync.staged_stand(t, _activity_staging(t)))


def _global_ids(t) -> DataFrame:
    """Key, if there is one, and identifier of the rows of all tables that lack identifiers."""
    key = lambda name: F.col(S.WITHOUT_GLOBAL_ID[name] or "_none").alias("ObjectID")
    return lists.union([
        rows.withColumn("_none", F.lit(None).cast("long")).select(F.lit(name).alias("dataset"), key(name), "GlobalID")
        for name, rows in prepare.with_global_ids(t).items()
    ])


def _forms(t) -> DataFrame:
    return control.match_forms(_changed(t), t["forms"])


def _related(name: str, parent_columns: list[str], child_columns: list[str], how: str = "inner") -> Query:
    return lambda t: R.relate(t, R.relation(name), how, parent_columns, child_columns)


def _each_relation(check: Callable, extra: tuple = ()) -> Query:
    return lambda t: lists.union([check(t, rel) for rel in [*R.RELATIONS, *extra]])


# A listing holds a chemical once per location, so its key repeats.
LISTING = R.Relation("Chemical_Listing", "chem_view", "CODE", "chem_app", "MasterChemOID")


def _rekeyed(t) -> DataFrame:
    """Children per key and new GlobalID key, for the relations that change their key."""
    parts = []
    for rel in R.RELATIONS:
        if rel.rekeyed:
            keys = R.rekey(t, rel).groupBy(
                F.col(rel.child_key).cast("string").alias("child_key"), F.col(rel.rekeyed).alias("parent_GlobalID")
            )
            parts.append(keys.agg(F.count("*").alias("rows")).withColumn("relation", F.lit(rel.name)))
    return lists.union(parts)


def _decoded(per_property: bool, keys: list[str], dataset: str = "activity") -> Query:
    def query(t) -> DataFrame:
        bindings = coded.bindings_of(dataset, per_property)
        rows = t[dataset].select(*keys, *[b.field for b in bindings])
        return coded.decode(rows, bindings, _code_lists(t, [b.list_name for b in bindings]))
    return query


SPECIAL = ["special_point", "special_line", "special_poly"]


def _decoded_special(t) -> DataFrame:
    """The types of all three tables, each by its own list."""
    known = _code_lists(t, SPECIAL)
    return lists.union([
        coded.decode(t[name].select("sp_type", "sp_subtype"), coded.bindings_of(name), known).select(F.lit(name).alias("dataset"), "*")
        for name in SPECIAL
    ])


def _subtype_names(t) -> DataFrame:
    return coded.decode_subtype(t["activity_mobile"].select("OBJECTID", "PropertyOID"), t["property_flags"])


def _sync_chemicals(t) -> DataFrame:
    """Chemicals that the run adds or updates."""
    result = sync.sync(t, folder=_work_folder(t))
    return result.changed_chemicals.unionByName(result.new_chemicals)


def _sync_rerun(t) -> DataFrame:
    """Chemicals after a run, and a second one over the same mobile rows and one more chemical for each known GUID."""
    spark, first, second = _session(t), _work_folder(t), _work_folder(t)
    t = sync.stored_day(t, f"{first}/arrived")
    sync.publish(t, first)
    read = spark.read.parquet
    whole = sync.same_after(t, first).unionByName(read(f"{first}/changed_chemicals")).unionByName(read(f"{first}/new_chemicals"))
    after = {
        **t, "activity": t["activity"].unionByName(read(f"{first}/new_activities")), "chem_app": sinks.stored(whole, f"{second}/office"),
        "chem_mobile": t["chem_mobile"].unionByName(_more_chemicals(t)),
    }
    sync.publish(after, second, earlier=[first])
    return sync.same_after(after, second).unionByName(
        read(f"{second}/changed_chemicals")).unionByName(read(f"{second}/new_chemicals"))


# The mobile rows of two days: a GUID's rows share all but the last digit of their order's number.
DAY = {"activity_mobile": "OBJECTID div 10 % 2", "chem_mobile": "OBJECTID div 10000 % 2"}


def _more_chemicals(t) -> DataFrame:
    """One more chemical for each GUID that has some."""
    return t["chem_mobile"].filter("OBJECTID % 1000 = 1").withColumns(
        {"OBJECTID": F.col("OBJECTID") + 500, "MasterChemOID": F.col("MasterChemOID") + 1})


def _office_rows(store: Store) -> DataFrame:
    """Both office tables of a store in one frame, told apart by ``output``."""
    parts = {"activity": store.table("activity"), "chemical": store.table("chem_app"), "reject": store.table("rejects").select("OBJECTID", "Cost")}
    rows = [part.select(F.lit(name).alias("output"), *part.columns) for name, part in parts.items()]
    return rows[0].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[2], allowMissingColumns=True)


def _sync_applied(t) -> DataFrame:
    """The office tables after two days, the mobile rows of the first still there on the second."""
    store = Store(_session(t), _work_folder(t))
    t = sync.stored_day(t, _work_folder(t))
    office.create(store, t, QUERY_BUCKETS)
    office.apply(store, {**t, **{name: t[name].filter(f"{day} = 0") for name, day in DAY.items()}}, "first")
    office.apply(store, {**t, "chem_mobile": t["chem_mobile"].unionByName(_more_chemicals(t))}, "second")
    store.vacuum()
    return _office_rows(store)


def _sync_taken_up(t) -> DataFrame:
    """The same, where the rows of each day arrive as files."""
    spark, folder = _session(t), _work_folder(t)
    store = Store(spark, f"{folder}/office")
    t = sync.stored_day(t, f"{folder}/mobile")
    office.create(store, t, QUERY_BUCKETS)
    for day in (0, 1):
        arrived = {name: t[name].filter(f"{rule} = {day}") for name, rule in DAY.items()}
        if day:
            arrived["chem_mobile"] = arrived["chem_mobile"].unionByName(_more_chemicals(t))
        for name, rows in arrived.items():
            rows.write.mode("append").parquet(f"{folder}/drop/{name}")
            inbox.take_up(spark, f"{folder}/drop", f"{folder}/inbox", name, t[name].schema, files=2)
        office.apply_inbox(store, t, f"{folder}/inbox", f"day-{day}")
    return _office_rows(store)


def _store_keys(t) -> DataFrame:
    """Activities with a GUID of the special rows, out of their buckets."""
    store = Store(_session(t), _work_folder(t))
    office.create(store, t, QUERY_BUCKETS)
    keys = t["chem_app"].filter("MasterChemOID % 50 = 7").select("Child_GUID")
    return store.scan_keys("activity", ["OBJECTID", "GlobalID", "PARENT_GUID"], keys)


def _lists_changed(t) -> DataFrame:
    """What a second publication writes: lists that had other descriptions, or were not there."""
    folder, current = _work_folder(t), _all_lists(t)
    kind = F.substring_index("domain_name", "_", -1)
    other = (kind == "supervisor") & (F.col("property_oid") % 5 == 0)
    before = current.withColumn("description", F.when(other, F.lit("other")).otherwise(F.col("description")))
    sinks.publish_changed(before.filter((kind != "contractor") | (F.col("property_oid") != 1)), f"{folder}/lists", f"{folder}/state")
    return sinks.publish_changed(current, f"{folder}/lists", f"{folder}/state")


def _named_files(t) -> DataFrame:
    """The lines of the files that forms take, with the file's name and the line's place."""
    folder = _work_folder(t)
    props = _changed(t).select("property_oid")
    refresh.write_form_files(cascade.itemsets(t, props, ordered=False), cascade.chem_defaults(t, props), folder)
    return named_files.read_lines(_session(t), folder).withColumn("place", F.col("place").cast("long"))


def _called(text: str) -> Query:
    """A SQL text that calls the procedures, with the properties as ``props`` and the changed ones as ``changed``."""
    def query(t) -> DataFrame:
        spark = _session(t)
        procedures.register(spark, t)
        return spark.sql(text, props=t["property"], changed=_changed(t))
    return query


CALL_DOMAINS = " UNION ALL ".join(
    f"SELECT concat(p.ObjectID, '_{kind}') AS domain_name, p.ObjectID AS property_oid, l.* FROM {{props}} p, LATERAL {name}(p.ObjectID) l"
    for kind, name in procedures.BY_KIND.items())
CALL_ITEMSETS = f"SELECT c.property_oid, l.* FROM {{changed}} c, LATERAL {procedures.ITEMSETS}(c.property_oid) l"


def _published_lists(t) -> DataFrame:
    folder = _work_folder(t)
    refresh.publish(t, t["property_flags"], t["forms"], folder)
    return sinks.read_code_lists(_session(t), f"{folder}/universal")


def _migrated(t) -> DataFrame:
    """Keys and GlobalIDs in the tables that preparation writes."""
    folder = _work_folder(t)
    prepare.migrate(t, folder)
    columns = {
        "stand": ("ObjectID", "GlobalID"), "chem_master": ("ObjectID", "GlobalID"), "activity": ("OBJECTID", "TFM_CMN_PROPERTY_GlobalID"),
        "chem_app": ("ActivityOID", "TFM_OP_ACTIVITY_GlobalID"), "hv_optprod": ("HUOID", "HVUnit_GlobalID"),
    }
    own = [
        _session(t).read.parquet(f"{folder}/{name}").select(
            F.lit(f"{name}.own").alias("dataset"), F.lit(None).cast("string").alias("key"), "GlobalID", F.lit(1).cast("long").alias("rows"))
        for name, key in S.WITHOUT_GLOBAL_ID.items() if not key
    ]
    return lists.union([
        _session(t).read.parquet(f"{folder}/{name}").groupBy(F.col(key).cast("string").alias("key"), F.col(gid).alias("GlobalID"))
        .agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "key", "GlobalID", "rows")
        for name, (key, gid) in columns.items()
    ] + own)


def _variants(t) -> dict[str, DataFrame]:
    """The tables, each row of those with text a second time in capitals with a blank behind, compared without regard to both."""
    found = {}
    for name in COLLATED:
        rows = t[name]
        texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
        again = rows.withColumns({c: F.concat(F.upper(c), F.lit(" ")) for c in texts})
        found[name] = S.collated(rows.unionByName(again))
    return {**t, **found}


def _domain_collated(t) -> DataFrame:
    rows = lists.domain_all(_variants(t), lists.all_properties(t))
    return rows.select("domain_name", "property_oid", F.col("code").cast("string"), F.col("description").cast("string"))


def _itemsets_collated(t) -> DataFrame:
    return cascade.itemsets(_variants(t), lists.all_properties(t), ordered=False, collation=S.COLLATION)


QUERIES: dict[str, Query] = {
    # lists
    "dom_chemical": _domain("chemical"),
    "dom_compartment": _domain("compartment"),
    "dom_contractor": _domain("contractor"),
    "dom_species": _domain("species"),
    "dom_supervisor": _domain("supervisor"),
    "hardcoded_lists": lambda t: lists.hardcoded_lists(t, lists.all_properties(t)),
    "universal_domains": lists.universal_domains,
    "domain_all": _all_lists,
    "domain_sizes": lambda t: lists.domain_sizes(_all_lists(t)),
    "chem_defaults": lambda t: cascade.chem_defaults(t, lists.all_properties(t)),
    "itemsets": lambda t: cascade.itemsets(t, lists.all_properties(t)),
    "items_p_category": _branch("p_category"),
    "items_p_type": _branch("p_type"),
    "items_p_subtype": _branch("p_subtype"),
    "items_s_category": _branch("s_category"),
    "items_s_type": _branch("s_type"),
    "items_s_subtype": _branch("s_subtype"),
    "items_inv_loc": _branch("inv_loc"),
    "items_chem_master": _branch("chem_masterOID"),
    "items_species": _branch("REG_Species"),
    "items_variety": _branch("REG_Variety"),
    "domain_collated": _domain_collated,
    "itemsets_collated": _itemsets_collated,
    # scans, sources, sinks
    "scan_activity_fields": lambda t: S.scan(t["activity_mobile"], MOBILE_FIELDS),
    "scan_activity_by_keys": lambda t: S.scan_keys(
        t["activity"], ["OBJECTID", "GlobalID", "PARENT_GUID"], "PropertyOID",
        _changed(t).withColumnRenamed("property_oid", "PropertyOID"),
    ),
    "read_code_lists": _read_code_lists,
    "csv_roundtrip": _csv_roundtrip,
    "domain_replace": _domain_replace,
    "truncate_keeps_schema": _truncate,
    "copy_dataset": _copy,
    "dataset_counts": S.dataset_counts,
    # projections, filters, functions
    "active_rows": _active_rows,
    "fn_strip_location": lambda t: t["chem_view"].select(
        "CODE", "Inventory_Location", X.strip_location("description").alias("stripped")
    ),
    "fn_pair_label": lambda t: t["special_type"].select(
        "sp_type", "sp_subtype", X.pair_label("sp_type", "sp_subtype").alias("label")
    ),
    "fn_typed_code": _typed_codes,
    "changed_properties": _changed,
    "reset_flags": lambda t: control.reset_flags(t["property_flags"], KEPT_PREFIXES),
    "add_guid_column": lambda t: identity.add_guid_column(t["hv_optprod"], "Child_GUID"),
    "add_global_ids": _global_ids,
    # new activities and chemicals
    "append_no_test": lambda t: mapping.append_no_test(t["chem_app"], _actual(t)),
    "append_mapped": lambda t: mapping.append_mapped(t["chem_app"], t["chem_mobile"]),
    "append_with_oids": sync.new_activities,
    "route_activities": _routes,
    "act_property_globalid": _property_global_id,
    "act_property_geometry": _property_geometry,
    "act_stand_enrich": lambda t: _stand(t).select("OBJECTID", "PARENT_GUID", "Parent_OID", "SHAPE"),
    "overlay_worklist": lambda t: sync.sync(t).overlay,
    "sync_counts": lambda t: A.route_counts(t["activity_mobile"], t["chem_mobile"]),
    "chem_actual": _actual,
    "chem_planned_actual": sync.new_chemicals,
    "chem_backfill": lambda t: sync.sync(t, folder=_work_folder(t)).chemicals,
    "sync_property_activities": lambda t: _staged(t, sync.staged_property(t, _activity_staging(t))),
    "sync_stand_activities": _stand,
    "sync_chemicals": _sync_chemicals,
    "sync_rerun": _sync_rerun,
    "sync_all": lambda t: sync.sync_rows(t, _work_folder(t)),
    "sync_applied": _sync_applied,
    "sync_taken_up": _sync_taken_up,
    "scan_store_by_keys": _store_keys,
    # relations and coded values
    "rel_property_activity": _related("Property_PropAct", ["Name"], ["OBJECTID", "Status", "Cost"]),
    "rel_activity_chemical": _related("Activity_Chemical_Existing", ["GlobalID"], ["MasterChemOID", "Rate", "Cost"]),
    "rel_mobile_guid": _related("Activity_Chemical_New", ["OBJECTID"], ["MasterChemOID", "Rate"]),
    "rel_unit_product": _related("HVunit_OPTproduct", ["GlobalID"], ["Quantity"]),
    "rel_backward": _related("HVunit_OPTproduct", ["GlobalID"], ["Quantity"], "backward"),
    "rel_backward_property": _related("Property_PropAct", ["Name"], ["OBJECTID", "Status", "Cost"], "backward"),
    "rel_backward_activity": _related("Activity_Chemical_Existing", ["GlobalID"], ["MasterChemOID", "Rate", "Cost"], "backward"),
    "rel_backward_mobile": _related("Activity_Chemical_New", ["OBJECTID"], ["MasterChemOID", "Rate"], "backward"),
    "rel_orphans": _each_relation(R.orphans),
    "rel_childless": _each_relation(R.childless),
    "rel_cardinality": _each_relation(R.repeated_parents, (LISTING,)),
    "rel_migrate_globalid": _rekeyed,
    "decode_property_domain": _decoded(True, ["OBJECTID", "PropertyOID"]),
    "decode_universal_domain": _decoded(False, ["OBJECTID"]),
    "decode_chemical_domain": _decoded(True, ["Child_GUID", "PropertyOID"], "chem_app"),
    "decode_unit_domain": _decoded(False, ["ObjectID"], "hv_unit"),
    "decode_special_domain": _decoded_special,
    "domain_violations": lambda t: coded.domain_violations(t, _code_lists(t)),
    "subtype_decode": _subtype_names,
    "subtype_unknown": lambda t: coded.unknown_subtypes(t["activity_mobile"], t["property_flags"]),
    "prepare_model": lambda t: prepare.prepare(t, _code_lists(t)),
    "migrated_tables": _migrated,
    # control
    "published_universal_lists": _published_lists,
    "lists_changed": _lists_changed,
    "named_files": _named_files,
    "call_domains": _called(CALL_DOMAINS),
    "call_itemsets": _called(CALL_ITEMSETS),
    "call_universal": _called(f"SELECT * FROM {procedures.UNIVERSAL}()"),
    "call_hardcoded": _called(f"SELECT p.ObjectID AS property_oid, l.* FROM {{props}} p, LATERAL {procedures.HARDCODED}(p.ObjectID) l"),
    "call_chem_defaults": _called(f"SELECT p.ObjectID AS property_oid, l.* FROM {{props}} p, LATERAL {procedures.CHEM_DEFAULTS}(p.ObjectID) l"),
    "form_match": _forms,
    "form_missing": lambda t: control.missing_forms(_changed(t), _forms(t)),
    "refresh_properties": lambda t: refresh.refresh(t, t["property_flags"], t["forms"]),
}
