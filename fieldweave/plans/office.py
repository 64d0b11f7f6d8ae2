"""The office tables in a store: each run puts the day's activities and chemicals where they belong, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.operators import activities as A
from fieldweave.operators import chemicals as C
from fieldweave.operators.joins import split_join
from fieldweave.operators.lists import Tables
from fieldweave.plans import sync
from fieldweave.sources.sinks import stored
from fieldweave.sources.store import State, Store
from fieldweave.sources.tables import dataset_counts
from fieldweave.streaming import inbox

#: Buckets of a new store. A day rewrites only those of its GUIDs, so more of them mean less to rewrite, in more files.
BUCKETS = 64

MOBILE = ["activity_mobile", "chem_mobile"]
_MERGED = T.StructType([T.StructField("OBJECTID", T.LongType())])


def create(store: Store, tables: Tables, buckets: int = BUCKETS) -> State:
    """A store with the office tables of ``tables``, both by GUID, and tables of what runs have taken up so far.

    It can be repeated until it has come to its end.
    """
    dataset_counts(tables)
    if not store.state().number:
        store.create({
            "activity": (tables["activity"].schema, "PARENT_GUID"), "chem_app": (tables["chem_app"].schema, "Child_GUID"),
            "merged_activities": (_MERGED, "OBJECTID"), "merged_chemicals": (_MERGED, "OBJECTID"),
            "rejects": (tables["activity_mobile"].schema, "OBJECTID"),
        }, buckets)
    run = store.begin("create")
    run.write("activity", tables["activity"])
    run.write("chem_app", tables["chem_app"])
    highest = store.spark.read.parquet(f"{store.folder}/activity/run=create").agg(F.max("OBJECTID")).first()[0] \
        if run.tables["activity"].parts else 0
    return run.commit(highest=highest, taken={name: [] for name in MOBILE})


def _merged(store: Store, tables: Tables) -> sync.Merged:
    """Keys that earlier runs have merged, out of the buckets of the mobile rows' keys."""
    def of(name: str, mobile: str) -> DataFrame:
        return store.table(name, store.buckets_of(tables[mobile], "OBJECTID"))

    return sync.Merged(of("merged_activities", "activity_mobile"), of("merged_chemicals", "chem_mobile"))


def _guids(tables: Tables, merged: sync.Merged) -> DataFrame:
    activities = A.unmerged(sync.routed(tables), merged.activities).select(F.col("Parent_GUID").alias("guid"))
    return activities.unionByName(sync.chemical_input(tables, merged).select(F.col("Child_GUID").alias("guid"))).distinct()


def apply(store: Store, tables: Tables, run: str, taken: dict[str, list[str]] | None = None) -> State:
    """Merge the mobile rows of ``tables`` that no run has merged; ``activity`` and ``chem_app`` come from the store.

    Of both only the buckets of the day's GUIDs are read. New activities are added; a bucket with a chemical of the day's
    GUIDs is written anew, new chemicals in all other buckets are added. Rows of neither route go to ``rejects``. All of it
    counts from the commit on; a run that is committed is not done again. ``taken`` names the batches of the inbox that
    the mobile rows are from.
    """
    state = store.state()
    if run in state.runs:
        return state
    steps = f"{store.folder}/steps/{run}"
    work = store.begin(run)
    tables = sync.stored_day(tables, steps)
    merged = _merged(store, tables)
    guids = stored(_guids(tables, merged), f"{steps}/day")
    touched = store.buckets_of(guids, "guid")
    own = {**tables, "activity": store.table("activity", touched), "chem_app": store.table("chem_app", touched)}
    result = sync.sync(own, merged, steps, highest=state.facts["highest"])
    work.write("activity", result.new_activities)

    changed = stored(result.changed_chemicals, f"{steps}/changed_chemicals")
    replaced = store.buckets_of(changed, "Child_GUID")
    altered = stored(C.guids_of(changed), f"{steps}/altered")
    of_altered = sync.stored_sieve(altered, "Child_GUID", f"{steps}/altered_sieve")
    same = split_join(store.table("chem_app", replaced), altered, ["Child_GUID"], "left_anti", of_altered)
    work.write("chem_app", same.unionByName(changed).unionByName(result.new_chemicals), replaced)

    rejects = A.unmerged(result.rejects, merged.activities)
    work.write("rejects", rejects)
    work.write("merged_activities", A.unmerged(tables["activity_mobile"], merged.activities))
    work.write("merged_chemicals", sync.chemical_input(tables, merged))
    highest = result.new_activities.agg(F.max("OBJECTID")).first()[0] or state.facts["highest"]
    known = state.facts["taken"]
    state = work.commit(highest=highest, taken={name: [*known[name], *(taken or {}).get(name, [])] for name in MOBILE})
    store.files.remove(f"steps/{run}")
    return state


def apply_inbox(store: Store, tables: Tables, folder: str, run: str) -> State:
    """Merge what the inbox in ``folder`` holds, then clear the batches that are committed.

    Without a new activity nothing is merged and the batches stay, as chemicals alone do not count. A run that stops
    between its commit and the clearing leaves batches that are committed; the next one clears them unread.
    """
    spark, state = store.spark, store.state()
    batches = {name: [b for b in inbox.batches(spark, folder, name) if b not in state.facts["taken"][name]] for name in MOBILE}
    mobile = {name: inbox.read(spark, folder, name, batches[name], tables[name].schema) for name in MOBILE}
    if run not in state.runs and not mobile["activity_mobile"].isEmpty():
        state = apply(store, {**tables, **mobile}, run, batches)
    for name in MOBILE:
        inbox.clear(spark, folder, name, state.facts["taken"][name])
    return state


def office_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The office tables of the store in ``folder``."""
    store = Store(spark, folder)
    return {name: store.table(name) for name in ("activity", "chem_app")}
