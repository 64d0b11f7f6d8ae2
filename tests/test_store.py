import pytest
from pyspark.sql import types as T

from fieldweave.sources.store import Store
from tests.conftest import rows

LAYOUT = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture()
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    made.create({"t": (LAYOUT, "k")}, buckets=4)
    return made


def frame(spark, data):
    return spark.createDataFrame(data, LAYOUT)


def committed(store, name, data, replaced=()):
    run = store.begin(name)
    run.write("t", frame(store.spark, data), replaced)
    return run.commit()


FIRST = [(f"k{n}", n) for n in range(20)] + [(None, n) for n in range(100, 120)]


def test_new_store_is_empty(store):
    assert store.table("t").columns == ["k", "v"] and store.table("t").isEmpty()
    with pytest.raises(FileExistsError):
        store.create({}, 4)


def test_rows_are_added_and_replaced(spark, store):
    committed(store, "a", FIRST)
    assert rows(store.table("t")) == rows(frame(spark, FIRST))
    hit = store.buckets_of(frame(spark, [("k3", 0), (None, 0)]), "k")
    assert len(hit) == 1
    kept = [tuple(r) for r in store.table("t", hit).collect() if r.k != "k3"]
    committed(store, "b", [*kept, ("k3", 33), ("new", 1)], hit)
    want = [r for r in FIRST if r[0] != "k3"] + [("k3", 33), ("new", 1)]
    assert rows(store.table("t")) == rows(frame(spark, want))
    assert store.state().runs == ["a", "b"]
    files = set(store.table("t").inputFiles())
    # Buckets that were not replaced keep their files.
    assert {f.split("bucket=")[1][0] for f in files if "run=a" in f} == {str(b) for b in range(4)} - {str(hit[0])}


def test_rows_without_key_share_no_bucket(spark, store):
    committed(store, "a", FIRST)
    assert len({r.bucket for r in store.rows("t").filter("k is null").collect()}) == 4


def test_a_run_counts_from_its_commit(spark, store):
    committed(store, "a", FIRST)
    run = store.begin("b")
    run.write("t", frame(spark, [("lost", 1)]), range(4))
    assert rows(store.table("t")) == rows(frame(spark, FIRST))
    # It stopped here. The same run again, with other rows and fewer buckets:
    committed(store, "b", [("k1", -1)])
    assert rows(store.table("t")) == rows(frame(spark, [*FIRST, ("k1", -1)]))
    with pytest.raises(FileExistsError):
        store.begin("b")


def test_commits_never_overwrite(store):
    one, two = store.begin("one"), store.begin("two")
    one.commit()
    with pytest.raises(FileExistsError):
        two.commit()
    assert store.state().runs == ["one"] and store.files.names("commits") == [f"{n:012}.json" for n in (1, 2)]


def test_an_emptied_bucket(store):
    committed(store, "a", FIRST)
    committed(store, "b", [], range(4))
    assert store.table("t").isEmpty()


def test_vacuum(spark, store):
    committed(store, "a", FIRST)
    store.begin("stopped").write("t", frame(spark, FIRST))
    hit = store.buckets_of(frame(spark, [("k3", 0)]), "k")
    committed(store, "b", [("k3", 1)], hit)
    before = rows(store.table("t"))
    assert store.vacuum() == 4 + 1
    assert rows(store.table("t")) == before and store.files.names("t") == ["run=a", "run=b"]
    assert store.vacuum() == 0


def test_only_the_buckets_of_keys_are_read(spark, store):
    committed(store, "a", FIRST)
    keys = frame(spark, [("k3", 0), ("k3", 1), ("absent", 2), (None, 3)])
    df = store.scan_keys("t", ["v"], keys)
    assert rows(df) == [(3,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert len(store.table("t", store.buckets_of(keys, "k")).inputFiles()) < len(store.table("t").inputFiles())
