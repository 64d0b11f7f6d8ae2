"""Representative input tables: each column of the data model as an expression over the raw parquet tables.

The expressions hold in Spark SQL and in DuckDB alike, so one definition feeds the queries and the SQL they are checked
against. ``FIXTURES.md`` describes the same tables in prose. Deployments pass their own tables instead.
"""

from __future__ import annotations

from typing import NamedTuple


# Layout of the raw tables. Stating it spares a job that reads file footers.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


class Binding(NamedTuple):
    source: str
    columns: list[tuple[str, str, str]]
    joined: str | None = None  # the same source with its joins in the order that moves the fewest rows

    def select(self, source: str | None = None) -> str:
        columns = ", ".join(f"{expression} AS {name}" for name, _, expression in self.columns)
        return f"SELECT {columns} {source or self.source}"


BINDINGS: dict[str, Binding] = {
    "property": Binding(
        'FROM nation',
        [
            ("ObjectID", "int", 'n_nationkey'),
            ("Name", "string", 'n_name'),
            ("GlobalID", "string", "md5(concat('property:', cast(n_nationkey as string)))"),
            ("SHAPE", "string", "concat('POINT (', cast(n_nationkey as string), ' ', cast(n_regionkey as string), ')')"),
        ],
    ),
    "property_flags": Binding(
        'FROM nation',
        [
            ("prop_key", "string", "concat(lpad(cast(n_nationkey as string), 3, '0'), ' - ', n_name)"),
            ("selected", "boolean", 'n_nationkey % 3 = 0'),
        ],
    ),
    "stand": Binding(
        'FROM customer',
        [
            ("ObjectID", "bigint", 'c_custkey'),
            ("PropertyOID", "int", 'c_nationkey'),
            ("SHAPE", "string", "concat('POINT (', cast(c_custkey as string), ' ', cast(c_nationkey as string), ')')"),
        ],
    ),
    "activity_mobile": Binding(
        "FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= timestamp '2001-01-01 00:00:00'",
        [
            ("OBJECTID", "bigint", 'o_orderkey'),
            ("Parent_GUID", "string", "case when o_orderkey % 50 = 3 then null else md5(concat('activity:', cast(o_orderkey - case when o_orderkey % 10 in (1, 2) then o_orderkey % 10 else 0 end as string))) end"),
            ("prop_or_stand", "string", "case o_orderstatus when 'F' then 'prop' when 'O' then 'stand' else null end"),
            ("PropertyOID", "int", 'case o_orderkey % 40 when 0 then 999 when 20 then 998 when 8 then null else c_nationkey end'),
            ("standOID", "bigint", 'case when o_custkey % 10 = 0 then -1 else o_custkey end'),
            ("Category", "string", "case o_orderpriority when '1-URGENT' then 'Property' when '2-HIGH' then 'PropertyE' when '3-MEDIUM' then 'PropertyH' when '4-NOT SPECIFIED' then 'PropertyM' else 'Other' end"),
            ("status", "string", 'o_orderstatus'),
            ("Supervisor", "string", 'c_mktsegment'),
            ("Contractor_OID", "bigint", 'o_custkey % 1000'),
            ("Cost", "double", 'o_totalprice'),
            ("mobile_only", "string", "'x'"),
        ],
    ),
    "activity": Binding(
        "FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < timestamp '2001-01-01 00:00:00'",
        [
            ("OBJECTID", "bigint", 'o_orderkey'),
            ("GlobalID", "string", "md5(concat('activity_gid:', cast(o_orderkey as string)))"),
            ("PARENT_GUID", "string", "md5(concat('activity:', cast(o_orderkey as string)))"),
            ("Parent_OID", "bigint", 'o_custkey'),
            ("PropertyOID", "int", 'c_nationkey'),
            ("TFM_CMN_PROPERTY_GlobalID", "string", 'cast(null as string)'),
            ("CATEGORY", "string", "'Other'"),
            ("Status", "string", 'o_orderstatus'),
            ("Supervisor", "string", 'c_mktsegment'),
            ("Contractor_OID", "bigint", 'o_custkey % 1000'),
            ("COMPARTMENTOID", "bigint", 'o_custkey % 600'),
            ("REG_Species", "string", "case o_orderkey % 7 when 0 then 'UNKNOWN' when 1 then null else 'ECONOMY' end"),
            ("REG_Pattern", "string", "concat('Brand#', cast(o_orderkey % 30 as string))"),
            ("REG_Stock_Type", "string", "case o_orderkey % 5 when 0 then 'PROMO' when 1 then 'ECONOMY' when 2 then 'LARGE' when 3 then 'UNKNOWN' else null end"),
            ("Cost", "double", 'o_totalprice'),
            ("SHAPE", "string", 'cast(null as string)'),
            ("office_only", "string", "'y'"),
        ],
    ),
    "chem_mobile": Binding(
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= timestamp '2001-01-01 00:00:00'",
        [
            ("OBJECTID", "bigint", "l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"),
            ("Child_GUID", "string", "case when l_orderkey % 50 = 7 then null else md5(concat('activity:', cast(l_orderkey as string))) end"),
            ("PropertyOID", "int", 'c_nationkey'),
            ("MasterChemOID", "bigint", 'l_partkey'),
            ("Activity_ContextID", "int", '0'),
            ("Rate", "double", 'l_quantity'),
            ("Cost", "double", 'l_extendedprice'),
        ],
        "FROM lineitem JOIN (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= timestamp '2001-01-01 00:00:00') o ON l_orderkey = o_orderkey",
    ),
    "chem_app": Binding(
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < timestamp '2001-01-01 00:00:00'",
        [
            ("Child_GUID", "string", "md5(concat('activity:', cast(l_orderkey as string)))"),
            ("ActivityOID", "bigint", 'l_orderkey'),
            ("TFM_OP_ACTIVITY_GlobalID", "string", 'cast(null as string)'),
            ("PropertyOID", "int", 'c_nationkey'),
            ("MasterChemOID", "bigint", 'l_partkey'),
            ("Activity_ContextID", "int", '1440'),
            ("Rate", "double", 'l_quantity'),
            ("Cost", "double", 'l_extendedprice'),
        ],
        "FROM lineitem JOIN (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < timestamp '2001-01-01 00:00:00') o ON l_orderkey = o_orderkey",
    ),
    "chem_master": Binding(
        'FROM part',
        [
            ("ObjectID", "bigint", 'p_partkey'),
            ("PropertyOID", "bigint", 'p_partkey % 25'),
            ("GTFF_Approved_IND", "string", "case when p_size % 2 = 0 then 'Y' else 'N' end"),
            ("Default_Cost_per_unit", "double", 'p_retailprice'),
            ("DefaultRate", "int", 'p_size'),
        ],
    ),
    "chem_view": Binding(
        'FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey',
        [
            ("CODE", "bigint", 'l_partkey'),
            ("description", "string", "concat(p_name, case when l_partkey % 4 = 0 then '' else concat('--', s_name) end)"),
            ("PropertyOID", "int", 's_nationkey'),
            ("activeflag", "int", 'case when (l_partkey + l_suppkey) % 5 = 0 or s_nationkey % 7 = 3 then 0 else 1 end'),
            ("Inventory_Location", "string", 's_name'),
        ],
    ),
    "compartment": Binding(
        'FROM customer',
        [
            ("CompartmentOID", "bigint", 'c_custkey % 500'),
            ("description", "string", 'c_mktsegment'),
            ("PropertyOID", "int", 'c_nationkey'),
            ("activeflag", "int", 'case when c_nationkey % 8 = 5 or c_acctbal < 0 then 0 else 1 end'),
        ],
    ),
    "contractor": Binding(
        'FROM supplier',
        [
            ("Contractor_OID", "bigint", 's_suppkey'),
            ("DESCRIPTION", "string", 's_name'),
            ("PROPERTYOID", "int", 's_nationkey'),
            ("activeflag", "int", 'case when s_nationkey % 7 = 3 then 0 else 1 end'),
        ],
    ),
    "supervisor": Binding(
        'FROM customer',
        [
            ("CODE", "string", 'c_mktsegment'),
            ("DESCRIPTION", "string", 'lower(c_mktsegment)'),
            ("PROPERTYOID", "int", 'c_nationkey'),
            ("ACTIVEFLAG", "int", 'case when c_nationkey % 6 = 5 then 0 else 1 end'),
        ],
    ),
    "species": Binding(
        'FROM part',
        [
            ("SPECIES_CODE", "string", 'p_type'),
            ("SPECIES_DESC", "string", 'lower(p_type)'),
            ("Variety_Code", "string", 'case when p_size = 1 then null else p_brand end'),
            ("Variety_DESC", "string", 'case when p_size = 1 then null else lower(p_brand) end'),
            ("PropertyOID", "bigint", 'p_partkey % 25'),
            ("activeflag", "int", 'case when p_partkey % 25 = 9 then 0 else 1 end'),
        ],
    ),
    "property_type": Binding(
        'FROM orders JOIN customer ON o_custkey = c_custkey',
        [
            ("Category", "string", 'case when o_orderkey % 50 = 0 then null else o_orderpriority end'),
            ("Category_desc", "string", 'lower(o_orderpriority)'),
            ("type_name", "string", 'o_orderstatus'),
            ("type_desc", "string", 'lower(o_orderstatus)'),
            ("subtype", "string", 'c_mktsegment'),
            ("subtype_desc", "string", 'lower(c_mktsegment)'),
            ("PROPERTYOID", "int", 'c_nationkey'),
            ("activeflag", "int", 'case when o_orderkey % 3 = 0 then 0 else 1 end'),
        ],
    ),
    "property_category": Binding(
        'FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey',
        [
            ("category", "string", 'o_orderpriority'),
            ("PROPERTYOID", "int", 'n_nationkey'),
            ("activeflag", "int", '(n_nationkey + cast(length(o_orderpriority) as int)) % 2'),
        ],
    ),
    "stand_type": Binding(
        'FROM part',
        [
            ("Category", "string", 'p_type'),
            ("Category_desc", "string", 'lower(p_type)'),
            ("type_name", "string", 'p_brand'),
            ("type_desc", "string", 'lower(p_brand)'),
            ("subtype", "string", 'p_name'),
            ("subtype_desc", "string", 'upper(p_name)'),
            ("PROPERTYOID", "bigint", 'p_partkey % 25'),
            ("activeflag", "int", 'case when p_size % 3 = 0 then 0 else 1 end'),
        ],
    ),
    "act_type": Binding(
        'FROM part',
        [
            ("PROPERTYOID", "bigint", 'p_partkey % 25'),
            ("subtype", "string", 'p_name'),
            ("ACTIVEFLAG", "int", 'case when p_size % 3 = 0 then 0 else 1 end'),
            ("IS_CHEMICAL_IND", "int", 'case when p_size % 4 = 0 then 1 else 0 end'),
        ],
    ),
    "special_type": Binding(
        'FROM part',
        [
            ("sp_type", "string", 'case when p_size = 1 then null else p_type end'),
            ("sp_subtype", "string", 'case when p_size % 5 = 0 or p_size = 1 and p_partkey % 2 = 0 then null else p_brand end'),
            ("sp_type_desc", "string", 'case when p_size = 1 then null else lower(p_type) end'),
            ("sp_subtype_desc", "string", 'case when p_size % 5 = 0 then null else lower(p_brand) end'),
        ],
    ),
    "status_code": Binding(
        'FROM orders',
        [
            ("CODE", "string", 'o_orderstatus'),
            ("DESCRIPTION", "string", 'lower(o_orderstatus)'),
        ],
    ),
    "harvest_status": Binding(
        'FROM lineitem',
        [
            ("CODE", "string", 'l_linestatus'),
            ("DESCRIPTION", "string", 'lower(l_linestatus)'),
        ],
    ),
    "plant_pattern": Binding(
        'FROM part',
        [
            ("CODE", "string", 'p_brand'),
            ("DESCRIPTION", "string", 'lower(p_brand)'),
        ],
    ),
    "plant_stock": Binding(
        'FROM part',
        [
            ("CODE", "string", 'p_type'),
            ("DESCRIPTION", "string", 'lower(p_type)'),
        ],
    ),
    "hv_unit": Binding(
        'FROM supplier',
        [
            ("ObjectID", "bigint", 's_suppkey'),
            ("GlobalID", "string", "md5(concat('hv_unit:', cast(s_suppkey as string)))"),
            ("Status", "string", "case when s_suppkey % 5 = 0 then 'Z' else 'O' end"),
        ],
    ),
    "hv_optprod": Binding(
        'FROM lineitem',
        [
            ("HUOID", "bigint", 'case when l_suppkey % 9 = 0 then -1 else l_suppkey end'),
            ("Quantity", "double", 'l_quantity'),
        ],
    ),
    "forms": Binding(
        'FROM pages',
        [
            ("form_id", "bigint", 'page_id'),
            ("title", "string", "case when page_id % 50 = 7 then null else replace(replace(replace(url, '9', ''), '8', ''), '5', '') end"),
        ],
    ),
}

# The three special-feature tables share the layout of ``special_type``; together they hold all of its rows.
BINDINGS |= {
    name: Binding(f"{BINDINGS['special_type'].source} WHERE p_partkey % 3 = {part}", BINDINGS["special_type"].columns)
    for part, name in enumerate(["special_point", "special_line", "special_poly"])
}
