import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.operators import activities as A
from fieldweave.operators import chemicals as C
from fieldweave.operators import identity, mapping
from fieldweave.plans import sync
from tests.conftest import rows


def schema(*names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def test_map_fields():
    target = schema("OBJECTID", "ObjectID", "Status", "SHAPE")
    assert mapping.map_fields(target, schema("objectid", "STATUS", "Shape", "extra")) == ["objectid", "STATUS"]


@pytest.mark.parametrize("change", [str.lower, str.upper, str.title])
def test_map_fields_ignores_case(change):
    target, source = schema("Alpha", "Beta", "Gamma"), ["gamma", "alpha", "delta"]
    got = mapping.map_fields(target, schema(*map(change, source)))
    assert [name.lower() for name in got] == ["gamma", "alpha"]


def test_align(spark):
    df = spark.createDataFrame([("1", "x", "y")], "A string, extra string, b string")
    got = mapping.align(df, T.StructType.fromDDL("B string, a int, c double"))
    assert got.schema.simpleString() == "struct<B:string,a:int,c:double>"
    assert rows(got) == [("y", 1, None)]


def test_route_is_a_partition(spark):
    values = ["prop", "stand", "Prop", None, ""]
    mobile = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "OBJECTID long, prop_or_stand string")
    parts = A.route(mobile)
    assert [part.count() for part in parts] == [1, 1, 3]
    assert sorted(r.OBJECTID for part in parts for r in part.collect()) == [0, 1, 2, 3, 4]


STAGED = "PARENT_GUID string, Parent_OID long, SHAPE string, _read_order long, _stand_oid long"


def replay(items, stands):
    """Rows handled one after another, each found stand written to all rows of its GUID staged so far."""
    staged = []
    for order, guid, stand in sorted(items):
        staged.append([order, guid, None, None])
        if stand in stands and guid is not None:
            for row in staged:
                if row[1] == guid:
                    row[2:] = [stand, stands[stand]]
    return sorted(map(tuple, staged))


def enriched(spark, items, stands):
    rows_ = spark.createDataFrame([(g, None, None, o, s) for o, g, s in items], STAGED)
    table = spark.createDataFrame(list(stands.items()), "ObjectID long, SHAPE string")
    got = A.enrich_stand(rows_, table).select("_read_order", "PARENT_GUID", "Parent_OID", "SHAPE").collect()
    return sorted(map(tuple, got))


@pytest.mark.parametrize("items", [
    [(5, "g", 1), (9, "g", 2)], [(5, "g", 77), (9, "g", 2)], [(5, "g", 1), (9, "g", 77)], [(5, None, 1), (9, "g", None)],
])
def test_stand_of_repeated_guid(spark, items):
    stands = {1: "one", 2: "two"}
    assert enriched(spark, items, stands) == replay(items, stands)


def test_stand_enrichment_equals_replay(spark):
    rng = random.Random(3)
    stands = {n: f"shape {n}" for n in range(6)}
    # One GUID holds a third of the rows, a third of the rows has a stand that does not exist.
    items = [
        (n, "hot" if rng.random() < 0.33 else f"g{rng.randrange(20)}", -1 if rng.random() < 0.33 else rng.randrange(8))
        for n in rng.sample(range(10_000), 300)
    ]
    assert enriched(spark, items, stands) == replay(items, stands)


def test_property_enrichment(spark):
    staged = spark.createDataFrame(
        [(1, "Property", "old", None), (1, "Other", "old", "keep"), (9, "PropertyE", "old", "keep"), (None, "Property", None, None)],
        "PropertyOID int, CATEGORY string, TFM_CMN_PROPERTY_GlobalID string, SHAPE string",
    )
    parents = spark.createDataFrame([(1, "gid", "shape")], "ObjectID int, GlobalID string, SHAPE string")
    assert rows(A.enrich_property(staged, parents)) == [
        (None, "Property", None, None), (1, "Other", "gid", "keep"), (1, "Property", "gid", "shape"),
        (9, "PropertyE", "old", "keep"),
    ]


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_number_rows(spark, bits):
    rng = random.Random(bits)
    keys = rng.sample(range(-500, 5000), 400) + [2**40 + 5, 2**62]
    data = [(k % 2, k) for k in keys]
    df = spark.createDataFrame(data, "part int, key long").repartition(5)
    got = identity.number_rows(df, "part", "key", "n", bits).collect()
    assert {(r.part, r.key): r.n for r in got} == {pair: n for n, pair in enumerate(sorted(data), 1)}


def test_new_object_ids_start_after_the_highest(spark):
    target = spark.createDataFrame([(41,), (7,)], "OBJECTID long")
    df = spark.createDataFrame([(1, 5, 500), (0, 9, 900), (0, 2, 200)], "part int, key long, OBJECTID long")
    assert rows(identity.next_object_ids(target, df, "part", "key"), "OBJECTID", "part", "key") == [
        (42, 0, 2), (43, 0, 9), (44, 1, 5),
    ]
    empty = target.limit(0)
    assert [r[0] for r in rows(identity.next_object_ids(empty, df, "part", "key"), "OBJECTID")] == [1, 2, 3]


def test_added_columns_stay_if_present(spark):
    df = spark.createDataFrame([(1, "g")], "ObjectID long, GLOBALID string")
    assert identity.add_global_ids(df, "x").columns == df.columns
    assert identity.add_guid_column(df, "GlobalID").columns == df.columns
    assert identity.add_guid_column(df, "Parent_GUID").schema["Parent_GUID"].dataType == T.StringType()


CHEM = "Child_GUID string, ActivityOID long, TFM_OP_ACTIVITY_GlobalID string, Activity_ContextID int, Cost double"


def test_each_chemical_is_planned_and_actual(spark):
    target = T.StructType.fromDDL(CHEM)
    staging = T.StructType([f for f in target if f.name != "Cost"])
    mobile = spark.createDataFrame([("g", 0, 1.5), ("g", 1440, 2.0)], "child_guid string, ACTIVITY_CONTEXTID int, cost double")
    got = rows(C.planned_and_actual(mobile, target, staging))
    assert got == sorted(
        [("g", None, None, 0, 1.5), ("g", None, None, 1440, None), ("g", None, None, 1440, 2.0), ("g", None, None, 1440, None)],
        key=lambda row: [(v is not None, str(v)) for v in row],
    )
    apart = C.planned(mobile, target).unionByName(mapping.align(C.actual(mobile, staging), target))
    assert rows(apart) == got


def test_backfill_takes_the_highest_activity_and_reaches_older_rows(spark):
    chemicals = spark.createDataFrame(
        [("g", 1, "old", 1440, 1.0), ("g", None, None, 0, 2.0), ("h", 5, "h5", 0, 3.0), (None, 6, "x", 0, 4.0), ("n", 8, "n8", 0, 5.0)],
        CHEM,
    )
    activities = spark.createDataFrame(
        [(3, "three", "g"), (7, "seven", "g"), (9, "nine", "h"), (10, "ten", None), (11, None, "n")],
        "OBJECTID long, GlobalID string, PARENT_GUID string",
    )
    new = spark.createDataFrame([("g",), (None,), ("n",)], "Child_GUID string")
    assert rows(C.backfill(chemicals, new, activities), "Cost", "ActivityOID", "TFM_OP_ACTIVITY_GlobalID") == [
        (1.0, 7, "seven"), (2.0, 7, "seven"), (3.0, 5, "h5"), (4.0, 6, "x"), (5.0, 11, None),
    ]


def test_overlay_counts_items(spark):
    activities = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h"), (4, "i")], "OBJECTID long, Parent_GUID string")
    items = spark.createDataFrame([("g",), ("g",), ("h",), (None,)], "Parent_GUID string")
    assert rows(A.overlay_worklist(activities, items)) == [(1, 2), (2, 2), (3, 1)]


def test_chemicals_double(tables):
    assert sync.new_chemicals(tables).count() == 2 * tables["chem_mobile"].count()


def test_no_new_activity_means_no_chemicals(tables):
    quiet = {**tables, "activity_mobile": tables["activity_mobile"].limit(0)}
    assert sync.new_chemicals(quiet).isEmpty()
    assert rows(sync.sync(quiet).chemicals) == rows(tables["chem_app"])


def test_publish_then_repeat(spark, tables, tmp_path):
    first = str(tmp_path / "first")
    counts = dict(rows(sync.publish(tables, first)))
    lazy = sync.sync(tables)
    assert counts == dict(rows(lazy.counts))
    read = spark.read.parquet
    assert rows(read(f"{first}/new_activities")) == rows(lazy.new_activities)
    assert rows(read(f"{first}/changed_chemicals")) == rows(lazy.changed_chemicals)
    assert rows(read(f"{first}/new_chemicals")) == rows(lazy.new_chemicals)
    assert rows(read(f"{first}/overlay")) == rows(lazy.overlay)
    after = {
        **tables,
        "activity": tables["activity"].unionByName(read(f"{first}/new_activities")),
        "chem_app": lazy.chemicals,
    }
    second = str(tmp_path / "second")
    sync.publish(after, second, earlier=[first])
    assert read(f"{second}/new_activities").isEmpty() and read(f"{second}/new_chemicals").isEmpty()
    assert read(f"{second}/merged_chemicals").isEmpty()


def test_rerun_goes_by_the_row_itself(spark):
    """A new chemical of a known activity is merged; a merged one without a GUID is not merged again."""
    merged = spark.createDataFrame([(1,), (2,)], "OBJECTID long")
    mobile = spark.createDataFrame([(1, "g1"), (2, None), (3, "g1"), (4, None)], "OBJECTID long, Child_GUID string")
    assert rows(A.unmerged(mobile, merged)) == [(3, "g1"), (4, None)]
    assert A.unmerged(mobile, None) is mobile


def test_publish_without_news(tables, tmp_path):
    quiet = {**tables, "activity_mobile": tables["activity_mobile"].limit(0)}
    assert sync.publish(quiet, str(tmp_path)) is None


def test_publish_needs_every_dataset(tables, tmp_path):
    lacking = {name: tables[name] for name in tables if name != "stand"}
    with pytest.raises(LookupError, match="stand"):
        sync.publish(lacking, str(tmp_path))


def test_new_ids_are_dense_and_unique(tables):
    new = sync.new_activities(tables)
    highest = tables["activity"].agg(F.max("OBJECTID")).collect()[0][0]
    ids = sorted(r.OBJECTID for r in new.collect())
    assert ids == list(range(highest + 1, highest + 1 + len(ids)))


def test_new_chemicals_get_identifiers(spark):
    """From the key of the mobile row, one for each of its records; the same again in a rerun."""
    target = T.StructType.fromDDL(f"{CHEM}, GlobalID string")
    mobile = spark.createDataFrame([(1, "g", 1.5), (2, "g", 1.5)], "OBJECTID long, Child_GUID string, Cost double")
    staging = T.StructType([f for f in target if f.name != "Cost"])
    first, again = (rows(C.planned_and_actual(mobile.repartition(n), target, staging)) for n in (1, 3))
    assert first == again and len({row[-1] for row in first}) == 4
