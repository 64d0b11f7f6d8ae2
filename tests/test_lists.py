import pytest
from pyspark.sql import functions as F

from fieldweave.operators import cascade, lists
from fieldweave.sources.tables import COLLATION, collated
from tests.conftest import rows


@pytest.fixture()
def props(spark):
    return spark.createDataFrame([(0,), (1,), (2,)], "oid int")


def contractors(spark, data):
    return {"contractor": spark.createDataFrame(
        data, "Contractor_OID long, DESCRIPTION string, PROPERTYOID int, activeflag int"
    )}


def test_placeholder_only_for_empty_lists(spark, props):
    tables = contractors(spark, [(7, "A", 0, 1), (7, "A", 0, 1), (8, "B", 2, 0), (None, "C", 1, 1), (9, "D", 5, 1)])
    got = rows(lists.domain(tables, "contractor", props))
    assert got == [(0, "7", "A"), (1, None, "C"), (2, "1", "NA")]


def test_no_placeholder_on_request(spark, props):
    tables = contractors(spark, [(7, "A", 0, 1)])
    assert rows(lists.domain(tables, "contractor", props, placeholder=False)) == [(0, "7", "A")]


def test_repeated_request_is_one_request(spark):
    twice = spark.createDataFrame([(0,), (0,), (3,)], "oid int")
    tables = contractors(spark, [(7, "A", 0, 1)])
    assert rows(lists.domain(tables, "contractor", twice)) == [(0, "7", "A"), (3, "1", "NA")]


def test_null_flag_is_not_active(spark, props):
    tables = contractors(spark, [(7, "A", 0, None)])
    assert (0, "1", "NA") in rows(lists.domain(tables, "contractor", props))


def test_compartments_keep_repeated_rows(spark, props):
    tables = {"compartment": spark.createDataFrame(
        [(5, "x", 0, 1), (5, "x", 0, 1)], "CompartmentOID long, description string, PropertyOID int, activeflag int"
    )}
    assert rows(lists.domain(tables, "compartment", props)).count((0, "5", "x")) == 2


def chemical_tables(spark, view, master):
    return {
        "chem_view": spark.createDataFrame(
            view, "CODE long, description string, PropertyOID int, activeflag int, Inventory_Location string"
        ),
        "chem_master": spark.createDataFrame(
            master, "ObjectID long, PropertyOID long, GTFF_Approved_IND string, Default_Cost_per_unit double, DefaultRate int"
        ),
    }


def test_chemicals_go_by_listing_and_defaults_by_master(spark):
    tables = chemical_tables(
        spark,
        [(1, "Mix--Shed", 0, 1, "Shed"), (1, "Mix--Barn", 0, 1, "Barn"), (2, "Oil", 0, 1, "Shed"), (1, "Mix--Yard", 9, 0, "Yard")],
        [(1, 7, "Y", 2.5, 3), (2, 0, "N", 1.0, 1)],
    )
    one = spark.createDataFrame([(0,), (7,)], "oid int")
    assert rows(lists.domain(tables, "chemical", one)) == [(0, "1", "Mix"), (7, "1", "NA")]
    defaults = rows(cascade.chem_defaults(tables, one))
    assert [(p, c, r, str(k)) for p, c, r, k in defaults] == [(7, 2.5, 3, "1.0")] * 2


def test_every_property_has_each_list(tables):
    props = lists.all_properties(tables)
    sizes = lists.domain_sizes(lists.domain_all(tables, props))
    assert sizes.count() == props.count() * len(lists.KINDS)
    assert sizes.filter("rows < 1").isEmpty()


def test_subset_equals_filtered_whole(spark, tables):
    some = spark.createDataFrame([(0,), (3,), (11,)], "oid int")
    whole = lists.all_properties(tables)
    wanted = F.col("property_oid").isin(0, 3, 11)
    assert rows(cascade.itemsets(tables, some)) == rows(cascade.itemsets(tables, whole).filter(wanted))
    assert rows(lists.domain_all(tables, some)) == rows(lists.domain_all(tables, whole).filter(wanted))


def test_itemsets_never_repeat_a_row(tables):
    items = cascade.itemsets(tables, lists.all_properties(tables), ordered=False)
    assert items.count() == items.distinct().count()


def test_itemsets_order(tables):
    got = [(r.property_oid, r.list_name.lower()) for r in cascade.itemsets(tables, lists.all_properties(tables)).collect()]
    assert got == sorted(got)


def test_pairs_do_not_depend_on_the_grid(tables):
    props = lists.all_properties(tables)
    results = [rows(cascade.itemsets(tables, props, ["inv_loc"], side=n)) for n in (1, 3, 64)]
    assert results[0] and results[0] == results[1] == results[2]


def test_category_without_code_is_dropped(spark):
    layout = "Category string, Category_desc string, type_name string, type_desc string, subtype string, " \
             "subtype_desc string, PROPERTYOID int, activeflag int"
    tables = {
        "property_type": spark.createDataFrame(
            [(None, "n", "t", "t", "s", "s", 0, 1), ("A", "a", "t", "t", "s", "s", 0, 1), ("A", "a", "t", "t", "s", "s", 1, 1)],
            layout,
        ),
        "property_category": spark.createDataFrame(
            [("A", 0, 1), ("A", 0, 1), (None, 0, 1), ("A", 1, 0)], "category string, PROPERTYOID int, activeflag int"
        ),
    }
    props = spark.createDataFrame([(0,), (1,)], "oid int")
    got = cascade.itemsets(tables, props, ["p_category", "p_type", "p_subtype"])
    assert rows(got, "property_oid", "list_name", "name", "p_category", "p_type", "prop_or_stand") == [
        (0, "p_category", "A", None, None, "prop"), (0, "p_subtype", "s", None, "t", None), (0, "p_type", "t", "A", None, None),
    ]


def test_collation_option(spark):
    data = [("Oak", "oak", 0, 1), ("OAK ", "oak", 0, 1)]
    species = spark.createDataFrame(
        data, "SPECIES_CODE string, SPECIES_DESC string, PropertyOID int, activeflag int"
    )
    assert lists.list_rows({"species": species}, "species").count() == 2
    assert lists.list_rows({"species": collated(species)}, "species").count() == 1


def test_collated_itemsets(spark):
    layout = "SPECIES_CODE string, SPECIES_DESC string, Variety_Code string, Variety_DESC string, PropertyOID int, activeflag int"
    species = spark.createDataFrame([("Oak", "oak", "v", "v", 0, 1), ("OAK", "oak ", "w", "w", 0, 1)], layout)
    props = spark.createDataFrame([(0,)], "oid int")
    branches = ["REG_Species", "REG_Variety"]
    assert cascade.itemsets({"species": species}, props, branches).count() == 4
    merged = cascade.itemsets({"species": collated(species)}, props, branches, collation=COLLATION)
    assert [r[0] for r in rows(merged, "list_name")] == ["REG_Species", "REG_Variety", "REG_Variety"]


def test_the_first_row_stands_for_equal_ones(spark):
    """Whatever the order and the number of tasks: the least row byte by byte, column by column, NULL first."""
    data = [(1, "oak ", "b"), (1, "Oak", "c"), (1, "OAK  ", "B "), (1, "Oak", None), (2, "oak", "b"), (1, None, "x"), (1, None, "X")]
    want = [(1, None, "X"), (1, "OAK  ", "B "), (1, "Oak", "c"), (1, "Oak", None), (2, "oak", "b")]
    for order in (data, data[::-1], data[3:] + data[:3]):
        frame = spark.createDataFrame(order, "property_oid int, code string, description string").repartition(3)
        got = lists.distinct_rows(collated(frame))
        assert rows(lists.plain_text(got)) == sorted(want, key=lambda row: [(v is not None, str(v)) for v in row])
        assert got.schema["code"].dataType.collation == COLLATION
    assert rows(lists.distinct_rows(frame)) == rows(frame)


def grid_tables(spark, sizes):
    """``sizes``: locations and subtypes of each property."""
    places = [(1, f"d{n}", p, 1, f"loc{n}") for p, (a, _) in sizes.items() for n in range(a)]
    kinds = [(p, f"sub{n}", 1, 1) for p, (_, b) in sizes.items() for n in range(b)]
    return {
        "chem_view": spark.createDataFrame(places, "CODE long, description string, PropertyOID int, activeflag int, Inventory_Location string"),
        "act_type": spark.createDataFrame(kinds, "PROPERTYOID long, subtype string, ACTIVEFLAG int, IS_CHEMICAL_IND int"),
        "chem_master": spark.createDataFrame([(p, p, "Y") for p in sizes], "ObjectID long, PropertyOID long, GTFF_Approved_IND string"),
    }


def test_pairs_are_dealt_by_measured_size(spark):
    sizes = {1: (900, 600), 2: (30, 10), 3: (1, 100), 4: (100, 100)}
    tables, props = grid_tables(spark, sizes), spark.createDataFrame([(p,) for p in sizes], "property_oid int")
    got = cascade.itemsets(tables, props, ["inv_loc"], ordered=False, side=100)
    assert got.count() == got.distinct().count() == sum(a * b for a, b in sizes.values())
    # The cells as the operator deals them: the hot property has 9 x 6 of them of like size, the others have one each.
    places = tables["chem_view"].selectExpr("PropertyOID AS property_oid", "Inventory_Location").distinct()
    subtypes = tables["act_type"].selectExpr("cast(PROPERTYOID AS int) AS property_oid", "subtype").distinct()
    grids = spark.createDataFrame([(p, -(-a // 100), -(-b // 100)) for p, (a, b) in sizes.items()], "property_oid int, rows int, columns int")
    left = cascade._dealt(places, grids, "Inventory_Location", "row", "column")
    right = cascade._dealt(subtypes, grids, "subtype", "column", "row")
    cells = [r["count"] for r in left.join(right, ["property_oid", "row", "column"]).filter("property_oid = 1").groupBy("row", "column").count().collect()]
    assert len(cells) == 54 and max(cells) < 2 * sum(cells) / len(cells)
    assert left.filter("property_oid > 1").count() == 131 and right.filter("property_oid > 1").count() == 210


def chemicals_listed(spark, texts):
    listed = spark.createDataFrame(
        [(n % 7, text, 0, 1, f"{text}-place") for n, text in enumerate(texts)],
        "CODE long, description string, PropertyOID int, activeflag int, Inventory_Location string")
    masters = spark.range(7).selectExpr("id AS ObjectID", "0L AS PropertyOID", "'Y' AS GTFF_Approved_IND")
    subtypes = spark.createDataFrame([(0, "cut", 1, 1)], "PROPERTYOID int, subtype string, ACTIVEFLAG int, IS_CHEMICAL_IND int")
    return {"chem_view": collated(listed), "chem_master": masters, "act_type": collated(subtypes)}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_collated_chemicals_are_cut_anew_before_they_are_sorted(spark):
    tables = chemicals_listed(spark, ["Oak", "OAK ", "oak", "Elm"] * 7)
    got = lists.chemical_codes(tables)
    assert plan_of(got).count("RebalancePartitions") == 1
    assert rows(got) == sorted((0, str(n), text) for n in range(7) for text in ("Elm", "OAK "))
    plain = {**tables, "chem_view": lists.plain_text(tables["chem_view"])}
    assert "RebalancePartitions" not in plan_of(lists.chemical_codes(plain))


def test_collated_locations_collapse_before_they_are_sorted(spark):
    tables = chemicals_listed(spark, ["Oak", "OAK", "Oak", "Elm"] * 7)
    props = spark.createDataFrame([(0,)], "oid int")
    got = cascade._locations(tables, props, 256)
    # The DISTINCT of exact copies stands below the exchange, the one by collation above it.
    below = plan_of(got).split("RebalancePartitions", 1)[1].split("Join", 1)[0]
    assert "Aggregate" in below
    assert sorted(r.name for r in got.collect()) == ["Elm-place", "OAK-place"]
