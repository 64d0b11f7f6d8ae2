import pytest
from pyspark.sql import functions as F

from fieldweave.plans import office, sync
from fieldweave.plans.catalog import DAY, _more_chemicals
from fieldweave.sources.store import Store
from fieldweave.streaming import inbox
from tests.conftest import rows


@pytest.fixture()
def store(spark, tables, tmp_path):
    made = Store(spark, str(tmp_path / "office"))
    office.create(made, tables, buckets=3)
    return made


def day(tables, number):
    return {**tables, **{name: tables[name].filter(f"{rule} = {number}") for name, rule in DAY.items()}}


def content(store):
    return {name: rows(store.table(name)) for name in store.state().tables}


def test_one_run_equals_the_batch_plan(store, tables):
    office.apply(store, tables, "only")
    lazy = sync.sync(tables)
    assert rows(store.table("activity")) == rows(lazy.activities)
    assert rows(store.table("chem_app")) == rows(lazy.chemicals)
    assert rows(store.table("rejects")) == rows(lazy.rejects)
    assert store.state().facts["highest"] == lazy.activities.agg(F.max("OBJECTID")).first()[0]


def test_a_committed_run_is_not_repeated(store, tables):
    office.apply(store, day(tables, 0), "first")
    before = content(store)
    office.apply(store, tables, "first")
    assert content(store) == before
    # Another run over the same rows finds nothing new.
    office.apply(store, day(tables, 0), "again")
    assert content(store) == before


@pytest.mark.parametrize("step", ["chem_app", "commit"])
def test_a_run_that_stops_is_repeated_without_loss(spark, tables, tmp_path, monkeypatch, step):
    """Stops after a table is written, or between the last table and the commit."""
    more = {**tables, "chem_mobile": tables["chem_mobile"].unionByName(_more_chemicals(tables))}
    stores = []
    for name in ("whole", "stopped"):
        own = Store(spark, str(tmp_path / name))
        office.create(own, tables, buckets=3)
        office.apply(own, day(tables, 0), "first")
        stores.append(own)
    office.apply(stores[0], more, "second")
    before = content(stores[1])

    class Stop(Exception):
        pass

    from fieldweave.sources.store import Run
    write, commit = Run.write, Run.commit

    def stopping_write(self, name, *args):
        write(self, name, *args)
        if name == step:
            raise Stop

    def stopping_commit(self, **facts):
        if step == "commit":
            raise Stop
        return commit(self, **facts)

    with monkeypatch.context() as patch:
        patch.setattr(Run, "write", stopping_write)
        patch.setattr(Run, "commit", stopping_commit)
        with pytest.raises(Stop):
            office.apply(stores[1], more, "second")
    assert content(stores[1]) == before
    office.apply(stores[1], more, "second")
    assert content(stores[1]) == content(stores[0])
    assert rows(stores[1].table("activity")) != rows(tables["activity"])


def test_untouched_buckets_keep_their_files(spark, tables, tmp_path):
    own = Store(spark, str(tmp_path / "office"))
    office.create(own, tables, buckets=16)
    guid = tables["chem_app"].select("Child_GUID").first()[0]
    one = tables["chem_mobile"].limit(1).withColumn("Child_GUID", F.lit(guid))
    office.apply(own, {**tables, "activity_mobile": tables["activity_mobile"].limit(1), "chem_mobile": one}, "small")
    files = own.table("chem_app").inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files if "run=small" in f}) == 1
    assert sum("run=create" in f for f in files) >= 15


def drop(spark, tables, folder, number):
    for name, rule in DAY.items():
        tables[name].filter(f"{rule} = {number}").write.mode("append").parquet(f"{folder}/drop/{name}")


def take_up(spark, tables, folder):
    for name in DAY:
        inbox.take_up(spark, f"{folder}/drop", f"{folder}/inbox", name, tables[name].schema, files=1)


def test_two_drops(spark, store, tables, tmp_path):
    folder = str(tmp_path)
    plain = Store(spark, f"{folder}/plain")
    office.create(plain, tables, buckets=3)
    for number in (0, 1):
        office.apply(plain, day(tables, number), f"day-{number}")
        drop(spark, tables, folder, number)
        take_up(spark, tables, folder)
        office.apply_inbox(store, tables, f"{folder}/inbox", f"day-{number}")
        assert all(inbox.batches(spark, f"{folder}/inbox", name) == [] for name in DAY)
    assert content(store) == content(plain)
    # No new file, no new batch, no run.
    take_up(spark, tables, folder)
    assert office.apply_inbox(store, tables, f"{folder}/inbox", "idle").runs == ["create", "day-0", "day-1"]


def test_a_repeated_batch_and_rows_sent_again(spark, store, tables, tmp_path):
    folder = str(tmp_path)
    drop(spark, tables, folder, 0)
    take_up(spark, tables, folder)
    batch = inbox.batches(spark, f"{folder}/inbox", "chem_mobile")[0]
    again = spark.createDataFrame(spark.read.parquet(f"{folder}/inbox/chem_mobile/{batch}").collect(), tables["chem_mobile"].schema)
    office.apply_inbox(store, tables, f"{folder}/inbox", "first")
    before = content(store)
    # The stream had not noted the batch and writes it once more.
    again.write.parquet(f"{folder}/inbox/chem_mobile/{batch}")
    office.apply_inbox(store, tables, f"{folder}/inbox", "second")
    assert content(store) == before and inbox.batches(spark, f"{folder}/inbox", "chem_mobile") == []
    # The same rows as new files.
    drop(spark, tables, folder, 0)
    take_up(spark, tables, folder)
    office.apply_inbox(store, tables, f"{folder}/inbox", "third")
    assert content(store) == before


def test_a_stop_between_commit_and_clearing(spark, store, tables, tmp_path, monkeypatch):
    folder = str(tmp_path)
    drop(spark, tables, folder, 0)
    take_up(spark, tables, folder)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(inbox, "clear", stop)
        with pytest.raises(RuntimeError):
            office.apply_inbox(store, tables, f"{folder}/inbox", "first")
    before = content(store)
    assert inbox.batches(spark, f"{folder}/inbox", "activity_mobile")
    office.apply_inbox(store, tables, f"{folder}/inbox", "first")
    assert content(store) == before
    assert all(inbox.batches(spark, f"{folder}/inbox", name) == [] for name in DAY)


def test_chemicals_wait_for_an_activity(spark, store, tables, tmp_path):
    folder = str(tmp_path)
    day(tables, 0)["chem_mobile"].write.parquet(f"{folder}/drop/chem_mobile")
    tables["activity_mobile"].limit(0).write.parquet(f"{folder}/drop/activity_mobile")
    take_up(spark, tables, folder)
    before = content(store)
    office.apply_inbox(store, tables, f"{folder}/inbox", "early")
    assert content(store) == before and len(inbox.batches(spark, f"{folder}/inbox", "chem_mobile")) >= 1
    day(tables, 0)["activity_mobile"].write.mode("append").parquet(f"{folder}/drop/activity_mobile")
    take_up(spark, tables, folder)
    office.apply_inbox(store, tables, f"{folder}/inbox", "later")
    assert rows(store.table("chem_app")) == rows(sync.sync(day(tables, 0)).chemicals)
