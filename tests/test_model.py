from pyspark.sql import functions as F

from fieldweave.operators import coded, control
from fieldweave.operators import lists as L
from fieldweave.operators import relations as R
from fieldweave.plans import prepare, refresh
from fieldweave.sources import sinks
from fieldweave.sources.bindings import BINDINGS
from fieldweave.sources.tables import CatalogTables, staging_schema
from tests.conftest import rows

UNIT = R.relation("HVunit_OPTproduct")


def test_bindings_have_the_stated_types(tables):
    for name, binding in BINDINGS.items():
        stated = [(column, kind) for column, kind, _ in binding.columns]
        assert [(f.name, f.dataType.simpleString()) for f in tables[name].schema] == stated, name


def test_staging_lacks_office_columns(tables):
    names = staging_schema(tables["activity"], "activity").names
    assert "office_only" not in names and len(names) == len(tables["activity"].columns) - 1


def relation_tables(spark):
    return {
        "hv_unit": spark.createDataFrame([(1, "g1"), (2, "g2"), (2, "g2b")], "ObjectID long, GlobalID string"),
        "hv_optprod": spark.createDataFrame([(1, 1.0), (1, 2.0), (9, 3.0), (None, 4.0)], "HUOID long, Quantity double"),
    }


def test_relation_checks(spark):
    tables = relation_tables(spark)
    assert rows(R.orphans(tables, UNIT), "child_key", "rows") == [("9", 1)]
    assert rows(R.childless(tables, UNIT), "parent_key") == [("2",), ("2",)]
    assert rows(R.repeated_parents(tables, UNIT), "parent_key", "rows") == [("2", 2)]
    assert rows(R.check_relation(tables, UNIT), "check_name", "violations") == [
        ("childless", 2), ("orphans", 1), ("repeated_parents", 1),
    ]


def test_relate(spark):
    tables = relation_tables(spark)
    pick = ["parent_GlobalID", "child_Quantity"]
    assert rows(R.relate(tables, UNIT), *pick) == [("g1", 1.0), ("g1", 2.0)]
    assert rows(R.relate(tables, UNIT, "left"), *pick) == [("g1", 1.0), ("g1", 2.0), ("g2", None), ("g2b", None)]
    assert rows(R.relate(tables, UNIT, "backward"), *pick) == [(None, 3.0), (None, 4.0), ("g1", 1.0), ("g1", 2.0)]


def test_left_is_a_left_join(tables):
    got = R.relate(tables, UNIT, "left", ["GlobalID"], ["Quantity"])
    unit, product = tables["hv_unit"], tables["hv_optprod"]
    plain = unit.join(product, F.col("ObjectID") == F.col("HUOID"), "left").select("ObjectID", "GlobalID", "HUOID", "Quantity")
    assert rows(got) == rows(plain)


def test_rekey_keeps_every_child(spark):
    tables = relation_tables(spark)
    tables["hv_unit"] = tables["hv_unit"].filter("GlobalID != 'g2b'")
    assert rows(R.rekey(tables, UNIT)) == [(None, 4.0, None), (1, 1.0, "g1"), (1, 2.0, "g1"), (9, 3.0, None)]


def code_lists(spark):
    return spark.createDataFrame(
        [("species", 0, "A", "oak"), ("species", 0, "A", "ash"), ("species", 1, "B", "fir"), ("act_status", None, "O", "open")],
        "list_name string, property_oid int, code string, description string",
    )


def test_decode_never_repeats_rows(spark):
    data = spark.createDataFrame([(0, "A", "O"), (1, "A", "X"), (1, "B", None)], "PropertyOID int, REG_Species string, Status string")
    bindings = [b for b in coded.BINDINGS if b.field in ("REG_Species", "Status") and b.dataset == "activity"]
    got = coded.decode(data, bindings, code_lists(spark))
    assert rows(got, "PropertyOID", "REG_Species", "REG_Species_description", "Status_description") == [
        (0, "A", "ash", "open"), (1, "A", None, None), (1, "B", "fir", None),
    ]


def test_violations(spark):
    data = spark.createDataFrame(
        [(0, "A", "O"), (1, "A", "X"), (1, "A", "X"), (None, "A", None), (1, None, "O")],
        "PropertyOID int, REG_Species string, Status string",
    )
    bindings = [b for b in coded.BINDINGS if b.field in ("REG_Species", "Status") and b.dataset == "activity"]
    got = coded.violations(coded.coded_values({"activity": data}, bindings), code_lists(spark))
    assert rows(got, "field", "property_oid", "code", "rows") == [
        ("REG_Species", None, "A", 1), ("REG_Species", 1, "A", 2), ("Status", None, "X", 2),
    ]


def test_published_lists_decode_alike(spark, tables, tmp_path):
    props = L.all_properties(tables)
    sinks.replace_domains(L.domain_all(tables, props), str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    lists = coded.published_code_lists(stored, L.universal_domains(tables))
    assert rows(lists) == rows(coded.code_lists(tables, props))


def test_unknown_subtypes(spark):
    flags = spark.createDataFrame([("001 - A", True)], "prop_key string, selected boolean")
    data = spark.createDataFrame([(1,), (2,), (2,), (None,)], "PropertyOID int")
    assert rows(coded.unknown_subtypes(data, flags)) == [(None, 1), (2, 2)]
    assert rows(coded.decode_subtype(data, flags)) == [(None, None), (1, "A"), (2, None), (2, None)]


def test_reset_flags(spark):
    flags = spark.createDataFrame([("881 - A", True), ("423 - B", True), ("881 - C", False)], "prop_key string, selected boolean")
    assert rows(control.reset_flags(flags, ["881"])) == [("423 - B", False), ("881 - A", True), ("881 - C", False)]
    assert rows(control.reset_flags(flags.filter("selected"))) == [("423 - B", False), ("881 - A", False)]
    assert rows(control.changed_properties(flags)) == [(423, "B"), (881, "A")]


TITLES = [
    "Form 423", "Form 42/3", "0042", "5-7", "a-5", "no number", "", None, "12345678901234567890", "042 42 42", "--3", "x0", "-0",
]


def test_match_forms_is_substring_search(spark):
    oids = [0, 1, 3, 5, 7, 42, 423, -5, -7, 2345, 1234567890]
    forms = spark.createDataFrame(list(enumerate(TITLES)), "form_id long, title string")
    props = spark.createDataFrame([(o,) for o in oids], "oid int")
    expected = sorted((o, i) for o in oids for i, t in enumerate(TITLES) if t is not None and str(o) in t)
    got = control.match_forms(props, forms)
    assert sorted(map(tuple, got.collect())) == expected
    found = {o for o, _ in expected}
    assert sorted(r[0] for r in control.missing_forms(props, got).collect()) == sorted(set(oids) - found)


def test_match_forms_exact(spark):
    forms = spark.createDataFrame([(1, "Form 423"), (2, "Form 42"), (3, "Form 0042")], "form_id long, title string")
    props = spark.createDataFrame([(42,)], "oid int")
    assert rows(control.match_forms(props, forms, exact=True)) == [(42, 2), (42, 3)]


def test_migrate(spark, tables, tmp_path):
    prepare.migrate(tables, str(tmp_path))
    stand = spark.read.parquet(str(tmp_path / "stand"))
    assert stand.select("GlobalID").distinct().count() == tables["stand"].count()
    chem = spark.read.parquet(str(tmp_path / "chem_app"))
    assert chem.count() == tables["chem_app"].count()
    assert chem.filter("TFM_OP_ACTIVITY_GlobalID is null").isEmpty()


def test_refresh_publish(spark, tables, tmp_path):
    folder = str(tmp_path)
    missing = refresh.publish(tables, tables["property_flags"], tables["forms"], folder, ["003"])
    report = refresh.refresh(tables, tables["property_flags"], tables["forms"])
    changed = {r.property_oid for r in control.changed_properties(tables["property_flags"]).collect()}
    without = {r.property_oid for r in missing.collect()}
    assert {r.property_oid for r in report.filter("forms_found = 0").collect()} == without
    items = spark.read.option("header", True).csv(f"{folder}/itemsets")
    assert {r.property_oid for r in items.select("property_oid").distinct().collect()} <= changed - without
    expected = report.filter(F.col("list_name").endswith("itemsets")).agg(F.sum("rows")).collect()[0][0]
    assert items.count() == (expected or 0)
    assert [r.prop_key[:3] for r in spark.read.parquet(f"{folder}/flags").filter("selected").collect()] == ["003"]


def test_catalog_tables(spark):
    spark.createDataFrame([(1,)], "ObjectID int").createOrReplaceTempView("office_property")
    tables = CatalogTables(spark, {"property": "office_property", "stand": "nowhere"})
    assert "property" in tables and "stand" not in tables
    assert tables["property"].count() == 1
