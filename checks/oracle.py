"""DuckDB SQL for each registered query, over the raw parquet tables.

The SQL states the work as the procedures and scripts define it: a DISTINCT per branch and a UNION, many-to-many joins,
IN subqueries. The queries take other ways to the same rows.
"""

from __future__ import annotations

import re

from fieldweave.sources.bindings import BINDINGS

ACTIVITY_COLUMNS = [name for name, _, _ in BINDINGS["activity"].columns]
CHEMICAL_COLUMNS = [name for name, _, _ in BINDINGS["chem_app"].columns]
LAYOUT = "list_name, name, label, p_category, p_type, s_category, s_type, prop_or_stand, s_subtype, inv_loc, REG_Species"
KEYLESS = ["chem_app", "hv_optprod", "special_point", "special_line", "special_poly"]
KINDS = ["compartment", "supervisor", "contractor", "species", "chemical"]


def guid(dataset: str, oid: str) -> str:
    digest = f"md5('{dataset}:' || cast({oid} as varchar))"
    return (
        f"concat(substr({digest}, 1, 8), '-', substr({digest}, 9, 4), '-', substr({digest}, 13, 4), '-', "
        f"substr({digest}, 17, 4), '-', substr({digest}, 21, 12))"
    )


def content(name: str) -> str:
    """The values of a row as one text: each with its length in front."""
    texts = [f"cast({column} AS varchar)" for column, _, _ in BINDINGS[name].columns]
    return " || ".join(f"coalesce(cast(length({t}) AS varchar) || ':' || {t}, 'N')" for t in texts)


def keyless_ids(name: str) -> str:
    """Identifiers of a table without a key: its values, and the number among equal rows."""
    numbered = f"SELECT {content(name)} AS c, row_number() OVER (PARTITION BY {content(name)}) AS n FROM {name}"
    return guid(name, "c || '#' || n"), f"({numbered}) q"


def bound(text: str, extra: dict[str, str] | None = None) -> str:
    """``text`` behind the common table expressions that it names, directly or through each other."""
    parts = {name: binding.select() for name, binding in BINDINGS.items()} | DERIVED | (extra or {})
    needed: dict[str, str] = {}

    def add(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", sql)):
            if name in parts and name not in needed:
                if name in BINDINGS:
                    needed[name] = parts[name]
                else:
                    add(parts[name])
                    needed[name] = parts[name]

    add(text)
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in needed.items()) + "\n" + text


def variants(name: str) -> str:
    """A table whose rows come a second time in capitals with a blank behind."""
    again = ", ".join(f"upper({e}) || ' ' AS {c}" if kind == "string" else f"{e} AS {c}" for c, kind, e in BINDINGS[name].columns)
    return f"{BINDINGS[name].select()} UNION ALL SELECT {again} {BINDINGS[name].source}"


VARIANTS = {name: variants(name) for name in (
    "supervisor", "contractor", "species", "compartment", "chem_view", "property_type", "property_category", "stand_type", "act_type")}


def listed(kind: str) -> str:
    """Rows of one kind of list, as its procedure selects them."""
    return {
        "compartment": """
            SELECT PropertyOID AS property_oid, cast(CompartmentOID AS varchar) AS code, description
            FROM compartment WHERE activeflag = 1""",
        "supervisor": """
            SELECT DISTINCT PROPERTYOID AS property_oid, CODE AS code, DESCRIPTION AS description
            FROM supervisor WHERE ACTIVEFLAG = 1""",
        "contractor": """
            SELECT DISTINCT PROPERTYOID AS property_oid, cast(Contractor_OID AS varchar) AS code, DESCRIPTION AS description
            FROM contractor WHERE activeflag = 1""",
        "species": """
            SELECT DISTINCT cast(PropertyOID AS integer) AS property_oid, SPECIES_CODE AS code, SPECIES_DESC AS description
            FROM species WHERE activeflag = 1""",
        "chemical": """
            SELECT DISTINCT vm.PropertyOID AS property_oid, cast(CODE AS varchar) AS code,
              CASE WHEN instr(description, '--') > 0 THEN left(description, instr(description, '--') - 1)
                   ELSE description END AS description
            FROM chem_view vm JOIN chem_master m ON vm.CODE = m.ObjectID
            WHERE vm.activeflag = 1 AND m.GTFF_Approved_IND = 'Y'""",
    }[kind]


def with_placeholder(kind: str) -> str:
    return f"""
        SELECT property_oid, code, description FROM rows_{kind}
        WHERE property_oid IN (SELECT ObjectID FROM property)
        UNION ALL
        SELECT ObjectID, '1', 'NA' FROM property p
        WHERE (SELECT count(*) FROM rows_{kind} r WHERE r.property_oid = p.ObjectID) = 0"""


def branch(list_name: str, name: str, label: str, source: str, **others: str) -> str:
    """One INSERT of the cascading-choice procedure. ``source`` starts at FROM and names the property ``pid``."""
    columns = [c.strip() for c in LAYOUT.split(",")][3:]
    values = ", ".join(f"cast({others.get(c, 'NULL')} AS varchar) AS {c}" for c in columns)
    return (
        f"SELECT DISTINCT cast(pid AS integer) AS property_oid, '{list_name}' AS list_name, "
        f"cast({name} AS varchar) AS name, cast({label} AS varchar) AS label, {values} {source}"
    )


IN_PROPERTIES = "pid IN (SELECT ObjectID FROM property)"
PROPERTY_SOURCE = f"""
    FROM (SELECT *, PROPERTYOID AS pid FROM property_type) pt
    WHERE activeflag = 1 AND {IN_PROPERTIES} AND Category IN
      (SELECT DISTINCT category FROM property_category pc WHERE pc.PROPERTYOID = pt.pid AND pc.activeflag = 1)"""
STAND_SOURCE = f"FROM (SELECT *, PROPERTYOID AS pid FROM stand_type) st WHERE activeflag = 1 AND {IN_PROPERTIES}"
SPECIES_SOURCE = f"FROM (SELECT *, PropertyOID AS pid FROM species) sp WHERE activeflag = 1 AND {IN_PROPERTIES}"
LOCATION_SOURCE = f"""
    FROM (SELECT *, PROPERTYOID AS pid FROM act_type) s
    JOIN chem_view vm ON vm.PropertyOID = s.pid
    JOIN chem_master m ON s.pid = m.PropertyOID
    WHERE vm.activeflag = 1 AND s.ACTIVEFLAG = 1 AND IS_CHEMICAL_IND = 1 AND m.GTFF_Approved_IND = 'Y' AND {IN_PROPERTIES}"""
CHEMICAL_SOURCE = f"""
    FROM (SELECT *, PropertyOID AS pid FROM chem_view) vm JOIN chem_master m ON vm.CODE = m.ObjectID
    WHERE vm.activeflag = 1 AND m.GTFF_Approved_IND = 'Y' AND {IN_PROPERTIES}"""
CUT = "CASE WHEN instr(description, '--') > 0 THEN left(description, instr(description, '--') - 1) ELSE description END"

BRANCHES = {
    "p_category": branch("p_category", "Category", "Category_desc", PROPERTY_SOURCE, prop_or_stand="'prop'"),
    "p_type": branch("p_type", "type_name", "type_desc", PROPERTY_SOURCE, p_category="Category"),
    "p_subtype": branch("p_subtype", "subtype", "subtype_desc", PROPERTY_SOURCE, p_type="type_name"),
    "s_category": branch("s_category", "Category", "Category_desc", STAND_SOURCE, prop_or_stand="'stand'"),
    "s_type": branch("s_type", "type_name", "type_desc", STAND_SOURCE, s_category="Category"),
    "s_subtype": branch("s_subtype", "subtype", "subtype_desc", STAND_SOURCE, s_type="type_name"),
    "inv_loc": branch("inv_loc", "vm.Inventory_Location", "vm.Inventory_Location", LOCATION_SOURCE, s_subtype="s.subtype"),
    "chem_masterOID": branch("chem_masterOID", "CODE", CUT, CHEMICAL_SOURCE, inv_loc="vm.Inventory_Location"),
    "REG_Species": branch("REG_Species", "SPECIES_CODE", "SPECIES_DESC", SPECIES_SOURCE, prop_or_stand="'stand'"),
    "REG_Variety": branch("REG_Variety", "Variety_Code", "Variety_DESC", SPECIES_SOURCE, REG_Species="SPECIES_CODE"),
}

UNIVERSAL = " UNION ALL ".join(
    [
        f"SELECT DISTINCT '{name}' AS list_name, CODE AS code, DESCRIPTION AS description FROM {source}"
        for name, source in {
            "act_status": "status_code", "harv_status": "harvest_status", "plant_pattern": "plant_pattern",
            "plant_stock": "plant_stock",
        }.items()
    ] + [
        f"SELECT DISTINCT '{name}', concat(sp_type, ' - ' || sp_subtype), concat(sp_type_desc, ' - ' || sp_subtype_desc) "
        f"FROM {name}"
        for name in ("special_point", "special_line", "special_poly")
    ]
)

DEFAULTS = """
    SELECT cast(m.PropertyOID AS integer) AS property_oid, Default_Cost_per_unit AS cost, DefaultRate AS rate,
      cast(ObjectID / 1.0 AS decimal(16,1)) AS chem_masterOID
    FROM chem_master m JOIN chem_view vm ON m.ObjectID = vm.CODE
    WHERE vm.activeflag = 1 AND m.GTFF_Approved_IND = 'Y' AND m.PropertyOID IN (SELECT ObjectID FROM property)"""

CHANGED = """
    SELECT cast(split_part(prop_key, ' - ', 1) AS integer) AS property_oid, split_part(prop_key, ' - ', 2) AS property_name
    FROM property_flags WHERE selected"""

# Staged rows in the layout of the activity table, before they get identifiers.
STAGED = """
    SELECT OBJECTID, Parent_GUID AS PARENT_GUID, {parent_oid} AS Parent_OID, PropertyOID,
      {property_gid} AS TFM_CMN_PROPERTY_GlobalID, Category AS CATEGORY, status AS Status, Supervisor, Contractor_OID,
      cast(NULL AS bigint) AS COMPARTMENTOID, cast(NULL AS varchar) AS REG_Species, cast(NULL AS varchar) AS REG_Pattern,
      cast(NULL AS varchar) AS REG_Stock_Type, Cost, {shape} AS SHAPE, cast(NULL AS varchar) AS office_only"""

CHEMICALS = ", ".join(CHEMICAL_COLUMNS)

DERIVED = {
    "rows_" + kind: listed(kind) for kind in KINDS
} | {
    "list_" + kind: with_placeholder(kind) for kind in KINDS
} | {
    "all_lists": " UNION ALL ".join(
        f"SELECT concat(property_oid, '_{kind}') AS domain_name, property_oid, code, description, '{kind}' AS kind "
        f"FROM list_{kind}" for kind in KINDS
    ),
    "universal_lists": UNIVERSAL,
    "known_codes": """
        SELECT kind AS list_name, property_oid, code, description FROM all_lists
        UNION ALL SELECT list_name, NULL, code, description FROM universal_lists""",
    "choices": " UNION ".join(BRANCHES.values()),
    "defaults": DEFAULTS,
    "changed": CHANGED,
    "found_forms": "SELECT property_oid, form_id FROM changed JOIN forms ON contains(title, cast(property_oid AS varchar))",
    "form_count": "SELECT property_oid, count(*) AS forms_found FROM found_forms GROUP BY property_oid",
    "staged_property": STAGED.format(
        parent_oid="cast(NULL AS bigint)",
        property_gid="(SELECT GlobalID FROM property p WHERE p.ObjectID = a.PropertyOID)",
        shape="""CASE WHEN Category IN ('Property', 'PropertyE', 'PropertyH', 'PropertyM')
                 THEN (SELECT SHAPE FROM property p WHERE p.ObjectID = a.PropertyOID) END""",
    ) + " FROM activity_mobile a WHERE prop_or_stand = 'prop'",
    # The last found stand among the items of the same GUID that are read at or after the row.
    "last_stand": """
        SELECT a.OBJECTID AS item, arg_max(s.ObjectID, b.OBJECTID) AS stand_oid, arg_max(s.SHAPE, b.OBJECTID) AS stand_shape
        FROM activity_mobile a
        JOIN activity_mobile b ON a.Parent_GUID = b.Parent_GUID AND b.OBJECTID >= a.OBJECTID AND b.prop_or_stand = 'stand'
        JOIN stand s ON s.ObjectID = b.standOID
        WHERE a.prop_or_stand = 'stand' GROUP BY a.OBJECTID""",
    "staged_stand": STAGED.format(
        parent_oid="stand_oid", property_gid="cast(NULL AS varchar)", shape="stand_shape",
    ) + " FROM activity_mobile a LEFT JOIN last_stand ON item = OBJECTID WHERE prop_or_stand = 'stand'",
    "numbered": """
        SELECT (SELECT max(OBJECTID) FROM activity) + row_number() OVER (ORDER BY part, x.OBJECTID) AS new_oid, x.*
        FROM (SELECT 0 AS part, * FROM staged_property UNION ALL SELECT 1, * FROM staged_stand) x""",
    "added": "SELECT " + ", ".join(
        {"OBJECTID": "new_oid AS OBJECTID", "GlobalID": guid("activity", "new_oid") + " AS GlobalID"}.get(c, c)
        for c in ACTIVITY_COLUMNS
    ) + " FROM numbered",
    "activities_after": f"SELECT {', '.join(ACTIVITY_COLUMNS)} FROM activity UNION ALL "
                        f"SELECT {', '.join(ACTIVITY_COLUMNS)} FROM added",
    "planned": """
        SELECT Child_GUID, cast(NULL AS bigint) AS ActivityOID, cast(NULL AS varchar) AS TFM_OP_ACTIVITY_GlobalID,
          PropertyOID, MasterChemOID, Activity_ContextID, Rate, Cost FROM chem_mobile""",
    "actual": """
        SELECT Child_GUID, cast(NULL AS bigint) AS ActivityOID, cast(NULL AS varchar) AS TFM_OP_ACTIVITY_GlobalID,
          PropertyOID, MasterChemOID, 1440 AS Activity_ContextID, Rate, cast(NULL AS double) AS Cost FROM chem_mobile""",
    "chemicals_before": f"""
        SELECT {CHEMICALS} FROM chem_app UNION ALL SELECT {CHEMICALS} FROM planned
        UNION ALL SELECT {CHEMICALS} FROM actual""",
    "activity_key": """
        SELECT PARENT_GUID AS guid, max(OBJECTID) AS oid, arg_max(GlobalID, OBJECTID) AS gid FROM activities_after
        WHERE PARENT_GUID IN (SELECT Child_GUID FROM chem_mobile) GROUP BY PARENT_GUID""",
    "chemicals_after": """
        SELECT c.Child_GUID, coalesce(k.oid, c.ActivityOID) AS ActivityOID,
          CASE WHEN k.oid IS NULL THEN c.TFM_OP_ACTIVITY_GlobalID ELSE k.gid END AS TFM_OP_ACTIVITY_GlobalID,
          c.PropertyOID, c.MasterChemOID, c.Activity_ContextID, c.Rate, c.Cost
        FROM chemicals_before c LEFT JOIN activity_key k ON k.guid = c.Child_GUID""",
    # The same rows merged on two days: numbers go by the day first.
    "numbered_by_day": """
        SELECT (SELECT max(OBJECTID) FROM activity) + row_number() OVER (ORDER BY x.OBJECTID // 10 % 2, part, x.OBJECTID) AS new_oid, x.*
        FROM (SELECT 0 AS part, * FROM staged_property UNION ALL SELECT 1, * FROM staged_stand) x""",
    "added_by_day": "SELECT " + ", ".join(
        {"OBJECTID": "new_oid AS OBJECTID", "GlobalID": guid("activity", "new_oid") + " AS GlobalID"}.get(c, c)
        for c in ACTIVITY_COLUMNS
    ) + " FROM numbered_by_day",
    "activities_by_day": f"SELECT {', '.join(ACTIVITY_COLUMNS)} FROM activity UNION ALL "
                         f"SELECT {', '.join(ACTIVITY_COLUMNS)} FROM added_by_day",
    "key_by_day": """
        SELECT PARENT_GUID AS guid, max(OBJECTID) AS oid, arg_max(GlobalID, OBJECTID) AS gid FROM activities_by_day
        WHERE PARENT_GUID IN (SELECT Child_GUID FROM chem_mobile) GROUP BY PARENT_GUID""",
    "chemicals_by_day": f"""
        SELECT c.Child_GUID, coalesce(k.oid, c.ActivityOID) AS ActivityOID,
          CASE WHEN k.oid IS NULL THEN c.TFM_OP_ACTIVITY_GlobalID ELSE k.gid END AS TFM_OP_ACTIVITY_GlobalID,
          c.PropertyOID, c.MasterChemOID, c.Activity_ContextID, c.Rate, c.Cost
        FROM (SELECT * FROM chemicals_before UNION ALL
              SELECT m.Child_GUID, NULL, NULL, m.PropertyOID, m.MasterChemOID + 1, context, m.Rate, CASE context WHEN 0 THEN m.Cost END
              FROM chem_mobile m CROSS JOIN (VALUES (0), (1440)) x(context) WHERE m.OBJECTID % 1000 = 1) c
        LEFT JOIN key_by_day k ON k.guid = c.Child_GUID""",
    "office_by_day": """
        SELECT 'activity' AS output, * FROM activities_by_day UNION ALL BY NAME SELECT 'chemical' AS output, * FROM chemicals_by_day
        UNION ALL BY NAME SELECT 'reject' AS output, OBJECTID, Cost FROM activity_mobile
        WHERE prop_or_stand IS NULL OR prop_or_stand NOT IN ('prop', 'stand')""",
    "overlay": """
        SELECT t.OBJECTID, count(*) AS times FROM activities_after t JOIN activity_mobile m ON t.PARENT_GUID = m.Parent_GUID
        WHERE m.prop_or_stand = 'stand' GROUP BY t.OBJECTID""",
    "sync_count": """
        SELECT CASE WHEN prop_or_stand IN ('prop', 'stand') THEN prop_or_stand ELSE 'reject' END AS item, count(*) AS rows
        FROM activity_mobile GROUP BY 1 UNION ALL SELECT 'chemical', count(*) FROM chem_mobile""",
    "dataset_size": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS rows FROM {name}"
        for name in ("activity_mobile", "chem_mobile", "activity", "chem_app", "stand", "property")
    ),
}

# Relations as (name, parent, parent key, child, child key).
RELATIONS = [
    ("Property_PropAct", "property", "ObjectID", "activity", "PropertyOID"),
    ("Activity_Chemical_Existing", "activity", "OBJECTID", "chem_app", "ActivityOID"),
    ("Activity_Chemical_New", "activity_mobile", "Parent_GUID", "chem_mobile", "Child_GUID"),
    ("HVunit_OPTproduct", "hv_unit", "ObjectID", "hv_optprod", "HUOID"),
]

# Fields as (table, field, list, whether the list belongs to the row's property).
FIELDS = [
    ("activity", "Supervisor", "supervisor", True),
    ("activity", "Contractor_OID", "contractor", True),
    ("activity", "COMPARTMENTOID", "compartment", True),
    ("activity", "REG_Species", "species", True),
    ("chem_app", "MasterChemOID", "chemical", True),
    ("activity", "Status", "act_status", False),
    ("activity", "REG_Pattern", "plant_pattern", False),
    ("activity", "REG_Stock_Type", "plant_stock", False),
    ("hv_unit", "Status", "harv_status", False),
    ("special_point", "sp_type", "special_point", False),
    ("special_line", "sp_type", "special_line", False),
    ("special_poly", "sp_type", "special_poly", False),
]


def orphan_keys(name, parent, parent_key, child, child_key) -> str:
    return f"""
        SELECT '{name}' AS relation, cast(c.{child_key} AS varchar) AS child_key, count(*) AS rows FROM {child} c
        WHERE c.{child_key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{child_key})
        GROUP BY c.{child_key}"""


def childless_keys(name, parent, parent_key, child, child_key) -> str:
    return f"""
        SELECT '{name}' AS relation, cast(p.{parent_key} AS varchar) AS parent_key FROM {parent} p
        WHERE NOT EXISTS (SELECT 1 FROM {child} c WHERE p.{parent_key} = c.{child_key})"""


def repeated_keys(name, parent, parent_key, child, child_key) -> str:
    return f"""
        SELECT '{name}' AS relation, cast({parent_key} AS varchar) AS parent_key, count(*) AS rows FROM {parent}
        GROUP BY {parent_key} HAVING count(*) > 1"""


def outside_list(table, field, list_name, per_property) -> str:
    place = "PropertyOID" if per_property else "cast(NULL AS integer)"
    same = "k.property_oid = v.PropertyOID AND" if per_property else ""
    return f"""
        SELECT '{table}' AS dataset, '{field}' AS field, '{list_name}' AS list_name, {place} AS property_oid,
          cast({field} AS varchar) AS code, count(*) AS rows
        FROM {table} v WHERE {field} IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM known_codes k WHERE k.list_name = '{list_name}' AND {same} k.code = cast(v.{field} AS varchar))
        GROUP BY ALL"""


def described(table: str, keys: list[str], fields: list[tuple]) -> str:
    texts, joins = [], []
    for number, (_, field, list_name, per_property) in enumerate(fields):
        group = "property_oid, code" if per_property else "code"
        same = f"AND d{number}.property_oid = t.PropertyOID" if per_property else ""
        joins.append(
            f"LEFT JOIN (SELECT {group}, min(description) AS text FROM known_codes WHERE list_name = '{list_name}' "
            f"GROUP BY {group}) d{number} ON d{number}.code = cast(t.{field} AS varchar) {same}"
        )
        texts.append(f"t.{field}, d{number}.text AS {field}_description")
    return f"SELECT {', '.join(keys + texts)} FROM {table} t {' '.join(joins)}"


def csv_lines(ending: str, source: str, columns: list[str], order: list[str]) -> str:
    """The lines of one file for each changed property: quoted fields, quotes doubled, the header at place 0."""
    quote = lambda c: f"""'"' || coalesce(replace(cast({c} AS varchar), '"', '""'), '') || '"'"""
    line = " || ',' || ".join(map(quote, columns))
    header = ",".join(f'"{c}"' for c in columns)
    rows = f"SELECT * FROM {source} WHERE property_oid IN (SELECT property_oid FROM changed)"
    place = f"row_number() OVER (PARTITION BY property_oid ORDER BY {', '.join(f'{c} NULLS FIRST' for c in order)})"
    return f"""
        SELECT concat(property_oid, '{ending}') AS file, {place} AS place, {line} AS line FROM ({rows}) q
        UNION ALL SELECT DISTINCT concat(property_oid, '{ending}'), 0, '{header}' FROM ({rows}) q"""


def related(name, parent_columns: list[str], child_columns: list[str], how: str = "JOIN") -> str:
    _, parent, parent_key, child, child_key = next(r for r in RELATIONS if r[0] == name)
    columns = [f"p.{c} AS parent_{c}" for c in [parent_key, *parent_columns]]
    columns += [f"c.{c} AS child_{c}" for c in [child_key, *child_columns]]
    return f"SELECT {', '.join(columns)} FROM {parent} p {how} {child} c ON p.{parent_key} = c.{child_key}"


def each(build, items) -> str:
    return " UNION ALL ".join(build(*item) for item in items)


def oracle() -> dict[str, str]:
    activity = ", ".join(ACTIVITY_COLUMNS)
    out = {f"dom_{kind}": f"SELECT * FROM list_{kind}" for kind in KINDS}
    out |= {f"items_{key}": sql for key, sql in {
        "p_category": BRANCHES["p_category"], "p_type": BRANCHES["p_type"], "p_subtype": BRANCHES["p_subtype"],
        "s_category": BRANCHES["s_category"], "s_type": BRANCHES["s_type"], "s_subtype": BRANCHES["s_subtype"],
        "inv_loc": BRANCHES["inv_loc"], "chem_master": BRANCHES["chem_masterOID"], "species": BRANCHES["REG_Species"],
        "variety": BRANCHES["REG_Variety"],
    }.items()}
    columns = [c.strip() for c in LAYOUT.split(",")]
    out["hardcoded_lists"] = " UNION ALL ".join(
        f"SELECT property_oid, '{kind}' AS list_name, code, description FROM rows_{kind} "
        "WHERE property_oid IN (SELECT ObjectID FROM property)" for kind in ("compartment", "supervisor", "contractor"))
    out |= {
        "itemsets": "SELECT * FROM choices",
        "domain_all": "SELECT domain_name, property_oid, code, description FROM all_lists",
        "domain_sizes": "SELECT domain_name, count(*) AS rows FROM all_lists GROUP BY domain_name",
        "universal_domains": "SELECT * FROM universal_lists",
        "chem_defaults": "SELECT * FROM defaults",
        "active_rows": " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, cast(PropertyOID AS integer) AS property_oid, count(*) AS rows FROM {name} "
            "WHERE activeflag = 1 AND PropertyOID IN (SELECT property_oid FROM changed) GROUP BY PropertyOID"
            for name in ("compartment", "contractor", "supervisor", "species", "stand_type", "act_type", "chem_view")
        ),
        "fn_strip_location": f"SELECT CODE, Inventory_Location, {CUT} AS stripped FROM chem_view",
        "fn_pair_label": """
            SELECT sp_type, sp_subtype, concat(sp_type, ' - ' || sp_subtype) AS label FROM special_type""",
        "fn_typed_code": " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, code, try_cast(code AS integer) AS integer_code FROM list_{kind}" for kind in KINDS
        ),
        "scan_activity_fields": "SELECT OBJECTID, Parent_GUID, prop_or_stand, PropertyOID, standOID FROM activity_mobile",
        "scan_activity_by_keys": """
            SELECT OBJECTID, GlobalID, PARENT_GUID FROM activity
            WHERE PropertyOID IN (SELECT property_oid FROM changed)""",
        "dataset_counts": "SELECT * FROM dataset_size",
        "read_code_lists": "SELECT * FROM universal_lists",
        "csv_roundtrip": f"""
            SELECT property_oid, {', '.join(f"coalesce({c.strip()}, '') AS {c.strip()}" for c in LAYOUT.split(','))}
            FROM choices""",
        "domain_replace": """
            SELECT domain_name, property_oid, code, CASE WHEN property_oid IN (SELECT property_oid FROM changed)
              THEN description ELSE 'old' END AS description FROM all_lists""",
        "truncate_keeps_schema": f"SELECT {activity} FROM activity WHERE false",
        "copy_dataset": "SELECT * FROM activity_mobile",
        "append_no_test": f"SELECT {CHEMICALS} FROM chem_app UNION ALL SELECT {CHEMICALS} FROM actual",
        "append_mapped": f"SELECT {CHEMICALS} FROM chem_app UNION ALL SELECT {CHEMICALS} FROM planned",
        "append_with_oids": "SELECT * FROM added",
        "chem_actual": "SELECT Child_GUID, ActivityOID, TFM_OP_ACTIVITY_GlobalID, PropertyOID, MasterChemOID, "
                       "Activity_ContextID, Rate FROM actual",
        "chem_planned_actual": f"SELECT {CHEMICALS} FROM planned UNION ALL SELECT {CHEMICALS} FROM actual",
        "chem_backfill": "SELECT * FROM chemicals_after",
        "add_guid_column": "SELECT *, cast(NULL AS varchar) AS Child_GUID FROM hv_optprod",
        "add_global_ids": " UNION ALL ".join(
            [f"SELECT '{name}' AS dataset, {key} AS ObjectID, {guid(name, key)} AS GlobalID FROM {name}"
             for name, key in (("stand", "ObjectID"), ("chem_master", "ObjectID"), ("activity_mobile", "OBJECTID"), ("chem_mobile", "OBJECTID"))]
            + [f"SELECT '{name}', NULL, {keyless_ids(name)[0]} FROM {keyless_ids(name)[1]}" for name in KEYLESS]),
        "route_activities": """
            SELECT OBJECTID, Parent_GUID, CASE WHEN prop_or_stand = 'prop' THEN 'prop' WHEN prop_or_stand = 'stand'
              THEN 'stand' ELSE 'reject' END AS route FROM activity_mobile""",
        "changed_properties": "SELECT * FROM changed",
        "reset_flags": """
            SELECT prop_key, CASE WHEN substr(prop_key, 1, 3) IN ('000', '006', '012') THEN selected ELSE false END
              AS selected FROM property_flags""",
        "act_property_globalid": """
            SELECT OBJECTID, PropertyOID, TFM_CMN_PROPERTY_GlobalID FROM staged_property""",
        "act_property_geometry": "SELECT OBJECTID, PropertyOID, CATEGORY, SHAPE FROM staged_property",
        "act_stand_enrich": "SELECT OBJECTID, PARENT_GUID, Parent_OID, SHAPE FROM staged_stand",
        "overlay_worklist": "SELECT * FROM overlay",
        "sync_counts": "SELECT * FROM sync_count",
        "form_match": "SELECT * FROM found_forms",
        "form_missing": "SELECT property_oid FROM changed WHERE property_oid NOT IN (SELECT property_oid FROM found_forms)",
        "rel_property_activity": related("Property_PropAct", ["Name"], ["OBJECTID", "Status", "Cost"]),
        "rel_activity_chemical": related("Activity_Chemical_Existing", ["GlobalID"], ["MasterChemOID", "Rate", "Cost"]),
        "rel_mobile_guid": related("Activity_Chemical_New", ["OBJECTID"], ["MasterChemOID", "Rate"]),
        "rel_unit_product": related("HVunit_OPTproduct", ["GlobalID"], ["Quantity"]),
        "rel_backward": related("HVunit_OPTproduct", ["GlobalID"], ["Quantity"], "RIGHT JOIN"),
        "rel_backward_property": related("Property_PropAct", ["Name"], ["OBJECTID", "Status", "Cost"], "RIGHT JOIN"),
        "rel_backward_activity": related("Activity_Chemical_Existing", ["GlobalID"], ["MasterChemOID", "Rate", "Cost"], "RIGHT JOIN"),
        "rel_backward_mobile": related("Activity_Chemical_New", ["OBJECTID"], ["MasterChemOID", "Rate"], "RIGHT JOIN"),
        "rel_orphans": each(orphan_keys, RELATIONS),
        "rel_childless": each(childless_keys, RELATIONS),
        "rel_cardinality": each(repeated_keys, RELATIONS + [
            ("Chemical_Listing", "chem_view", "CODE", "chem_app", "MasterChemOID"),
        ]),
        "rel_migrate_globalid": """
            SELECT 'Property_PropAct' AS relation, cast(c.PropertyOID AS varchar) AS child_key, p.GlobalID AS parent_GlobalID,
              count(*) AS rows FROM activity c LEFT JOIN property p ON p.ObjectID = c.PropertyOID GROUP BY ALL UNION ALL
            SELECT 'Activity_Chemical_Existing', cast(c.ActivityOID AS varchar), p.GlobalID, count(*)
              FROM chem_app c LEFT JOIN activity p ON p.OBJECTID = c.ActivityOID GROUP BY ALL UNION ALL
            SELECT 'HVunit_OPTproduct', cast(c.HUOID AS varchar), p.GlobalID, count(*)
              FROM hv_optprod c LEFT JOIN hv_unit p ON p.ObjectID = c.HUOID GROUP BY ALL""",
        "decode_property_domain": described(
            "activity", ["OBJECTID", "PropertyOID"], [f for f in FIELDS if f[0] == "activity" and f[3]]
        ),
        "decode_universal_domain": described("activity", ["OBJECTID"], [f for f in FIELDS if f[0] == "activity" and not f[3]]),
        "decode_chemical_domain": described("chem_app", ["Child_GUID", "PropertyOID"], [f for f in FIELDS if f[0] == "chem_app"]),
        "decode_unit_domain": described("hv_unit", ["ObjectID"], [f for f in FIELDS if f[0] == "hv_unit"]),
        "decode_special_domain": " UNION ALL ".join(
            described(name, [f"'{name}' AS dataset", "sp_subtype"], [f for f in FIELDS if f[0] == name])
            for name in ("special_point", "special_line", "special_poly")),
        "domain_violations": each(outside_list, FIELDS),
        "subtype_decode": """
            SELECT OBJECTID, PropertyOID, (SELECT split_part(prop_key, ' - ', 2) FROM property_flags
              WHERE cast(split_part(prop_key, ' - ', 1) AS integer) = m.PropertyOID) AS property_name
            FROM activity_mobile m""",
        "subtype_unknown": """
            SELECT PropertyOID AS property_oid, count(*) AS rows FROM activity_mobile
            WHERE PropertyOID IS NULL OR PropertyOID NOT IN (SELECT cast(split_part(prop_key, ' - ', 1) AS integer) FROM property_flags)
            GROUP BY PropertyOID""",
        "sync_property_activities": "SELECT * FROM staged_property",
        "sync_stand_activities": "SELECT * FROM staged_stand",
        "sync_chemicals": "SELECT * FROM chemicals_after WHERE Child_GUID IN (SELECT Child_GUID FROM chem_mobile) OR Child_GUID IS NULL",
        "sync_rerun": f"""
            SELECT {CHEMICALS} FROM chemicals_after UNION ALL
            SELECT m.Child_GUID, k.oid, k.gid, m.PropertyOID, m.MasterChemOID + 1, context, m.Rate, CASE context WHEN 0 THEN m.Cost END
            FROM chem_mobile m LEFT JOIN activity_key k ON k.guid = m.Child_GUID CROSS JOIN (VALUES (0), (1440)) c(context)
            WHERE m.OBJECTID % 1000 = 1""",
        "sync_applied": "SELECT * FROM office_by_day",
        "sync_taken_up": "SELECT * FROM office_by_day",
        "scan_store_by_keys": """
            SELECT OBJECTID, GlobalID, PARENT_GUID FROM activity
            WHERE PARENT_GUID IN (SELECT Child_GUID FROM chem_app WHERE MasterChemOID % 50 = 7)""",
        "published_universal_lists": "SELECT * FROM universal_lists",
        "lists_changed": """
            SELECT domain_name, count(*) AS rows FROM all_lists
            WHERE kind = 'supervisor' AND property_oid % 5 = 0 OR kind = 'contractor' AND property_oid = 1 GROUP BY domain_name""",
        "named_files": " UNION ALL ".join([
            csv_lines("itemsets.csv", "choices", columns, ["lower(list_name)", *columns]),
            csv_lines("chemdefaults.csv", "defaults", ["cost", "rate", "chem_masterOID"], ["chem_masterOID", "cost", "rate"])]),
        "call_domains": "SELECT domain_name, property_oid, code, description FROM all_lists",
        "call_itemsets": "SELECT * FROM choices WHERE property_oid IN (SELECT property_oid FROM changed)",
        "call_universal": "SELECT * FROM universal_lists",
        "call_hardcoded": out["hardcoded_lists"],
        "call_chem_defaults": "SELECT * FROM defaults",
        "migrated_tables": f"""
            SELECT 'stand' AS dataset, cast(ObjectID AS varchar) AS key, {guid('stand', 'ObjectID')} AS GlobalID, 1 AS rows FROM stand UNION ALL
            SELECT 'chem_master', cast(ObjectID AS varchar), {guid('chem_master', 'ObjectID')}, 1 FROM chem_master UNION ALL
            SELECT 'activity', cast(c.OBJECTID AS varchar), p.GlobalID, 1 FROM activity c LEFT JOIN property p ON p.ObjectID = c.PropertyOID UNION ALL
            SELECT 'chem_app', cast(c.ActivityOID AS varchar), p.GlobalID, count(*) FROM chem_app c
              LEFT JOIN activity p ON p.OBJECTID = c.ActivityOID GROUP BY ALL UNION ALL
            SELECT 'hv_optprod', cast(c.HUOID AS varchar), p.GlobalID, count(*) FROM hv_optprod c
              LEFT JOIN hv_unit p ON p.ObjectID = c.HUOID GROUP BY ALL UNION ALL """ + " UNION ALL ".join(
                f"SELECT '{name}.own', NULL, {keyless_ids(name)[0]}, 1 FROM {keyless_ids(name)[1]}" for name in KEYLESS),
        "sync_all": f"""
            SELECT 'activity' AS output, {activity} FROM activities_after
            UNION ALL BY NAME SELECT 'chemical' AS output, * FROM chemicals_after
            UNION ALL BY NAME SELECT 'reject' AS output, OBJECTID, Parent_GUID AS PARENT_GUID, PropertyOID, Cost
              FROM activity_mobile WHERE prop_or_stand IS NULL OR prop_or_stand NOT IN ('prop', 'stand')
            UNION ALL BY NAME SELECT 'overlay' AS output, * FROM overlay
            UNION ALL BY NAME SELECT 'count' AS output, * FROM sync_count""",
        "prepare_model": " UNION ALL ".join(
            [f"SELECT 'orphans' AS check_name, '{r[0]}' AS dataset, cast(coalesce(sum(rows), 0) AS bigint) AS violations "
             f"FROM ({orphan_keys(*r)}) q" for r in RELATIONS]
            + [f"SELECT 'childless', '{r[0]}', count(*) FROM ({childless_keys(*r)}) q" for r in RELATIONS]
            + [f"SELECT 'repeated_parents', '{r[0]}', count(*) FROM ({repeated_keys(*r)}) q" for r in RELATIONS]
            + [f"SELECT 'outside_list', '{f[0]}.{f[1]}', cast(coalesce(sum(rows), 0) AS bigint) FROM ({outside_list(*f)}) q"
               for f in FIELDS]
            + [f"""SELECT 'unknown_property', '{t}', count(*) FROM {t} WHERE PropertyOID IS NULL OR PropertyOID NOT IN
                (SELECT cast(split_part(prop_key, ' - ', 1) AS integer) FROM property_flags)"""
               for t in ("activity", "chem_app")]
        ),
        "refresh_properties": """
            SELECT c.property_oid, l.list_name, l.rows, coalesce(f.forms_found, 0) AS forms_found
            FROM changed c JOIN (
              SELECT property_oid, domain_name AS list_name, count(*) AS rows, false AS needs_form FROM all_lists GROUP BY ALL
              UNION ALL SELECT property_oid, concat(property_oid, 'itemsets'), count(*), true FROM choices GROUP BY property_oid
              UNION ALL SELECT property_oid, concat(property_oid, 'chemdefaults'), count(*), true FROM defaults
                GROUP BY property_oid
            ) l ON l.property_oid = c.property_oid LEFT JOIN form_count f ON f.property_oid = c.property_oid
            WHERE f.forms_found IS NOT NULL OR NOT l.needs_form""",
    }
    found = {name: bound(sql.strip()) for name, sql in out.items()}
    plain = lambda c: f"lower(rtrim({c}, ' '))"
    first = lambda keys, order: f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    lists = " UNION ALL ".join(
        f"SELECT concat(property_oid, '_{kind}') AS domain_name, * FROM ({rows}) q"
        for kind, rows in {
            kind: f"SELECT * FROM list_{kind}" if kind == "compartment" else
            f"SELECT * FROM list_{kind} QUALIFY {first(f'property_oid, {plain("code")}, {plain("description")}', 'code NULLS FIRST, description NULLS FIRST')}"
            for kind in KINDS
        }.items())
    choices = "SELECT * FROM choices QUALIFY " + first(
        ", ".join(["property_oid", *map(plain, columns)]), ", ".join(f"{c} NULLS FIRST" for c in columns))
    return found | {"domain_collated": bound(lists, VARIANTS), "itemsets_collated": bound(choices, VARIANTS)}
