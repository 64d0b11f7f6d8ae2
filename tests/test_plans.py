"""Properties of the physical plans that must hold at any scale."""

import re

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_itemsets_scans(spark, folder):
    text = plan(entry.queries()["itemsets"](spark, folder))
    lists = [scan for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]
    # Of the columns only the types, subtypes and species have, each is read by one scan.
    assert sum("p_size" in scan and "p_brand" in scan and "p_name" in scan for scan in lists) == 1
    assert not any("o_totalprice" in scan or "l_extendedprice" in scan for scan in lists)


def test_one_list_reads_one_source(spark, folder):
    text = plan(entry.queries()["dom_contractor"](spark, folder))
    assert "s_suppkey" in text and "c_custkey" not in text and "o_orderkey" not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(entry.queries()["scan_activity_fields"](spark, folder))
    assert "o_totalprice" not in text and "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_only_bounded_windows_lack_a_partition(spark, folder):
    """The one window over all rows counts blocks of 2^40 keys, not rows."""
    text = plan(entry.queries()["append_with_oids"](spark, folder))
    windows = re.findall(r"windowspecdefinition\(([^,]*), ([^,]*)", text)
    whole = [(first, second) for first, second in windows if " ASC" in first]
    assert len(windows) > len(whole) == 1
    assert whole[0][1].startswith("_area#")


def test_matching_forms_needs_no_shuffle_of_titles(spark, folder):
    text = plan(entry.queries()["form_match"](spark, folder))
    before_scan = text[: text.index("page_id")]
    assert "Exchange hashpartitioning(text" not in before_scan


def test_chemicals_are_filtered_before_they_are_updated(spark, tables, tmp_path):
    """Without any broadcast: only chemicals with a GUID of the day meet the keys."""
    from fieldweave.plans import sync

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sync.sync(tables, folder=str(tmp_path / "run")).changed_chemicals)
        assert text.index("LeftOuter") < text.index("LeftSemi")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_named_stands_are_moved(spark, tables, tmp_path):
    """Few new rows and many stands: the stands are filtered where they are read."""
    from fieldweave.operators import activities as A

    spark.range(200_000).selectExpr("id AS ObjectID", "repeat('x', 100) AS SHAPE").write.parquet(str(tmp_path / "stand"))
    stands = spark.read.parquet(str(tmp_path / "stand"))
    layout = "PARENT_GUID string, Parent_OID long, SHAPE string, _read_order long, _stand_oid long"
    spark.createDataFrame([("g", None, None, 1, 7)], layout).write.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        df = A.enrich_stand(spark.read.parquet(str(tmp_path / "rows")), stands)
        assert [tuple(r)[1:3] for r in df.collect()] == [(7, "x" * 100)]
        assert "BroadcastHashJoin [ObjectID" in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_all_fields_are_decoded_in_one_join(spark, tables, tmp_path):
    """Without any broadcast: rows are shuffled once whole and once as their codes, for any number of fields."""
    from fieldweave.operators import coded, lists

    tables["activity"].write.parquet(str(tmp_path / "rows"))
    coded.code_lists(tables, lists.all_properties(tables)).write.parquet(str(tmp_path / "lists"))
    facts, known = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "lists"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = []
        for bindings in (coded.bindings_of("activity")[:1], coded.bindings_of("activity")):
            text = plan(coded.decode(facts, bindings, known))
            exchanges.append(len(re.findall(r"Exchange hashpartitioning", text)))
            # The scan of the rows stands behind two exchanges, one of them narrow.
            assert text.count("office_only") and len(re.findall(r"FileScan parquet \[[^\]]*OBJECTID", text)) == 1
            assert len(re.findall(r"FileScan parquet \[[^\]]*Supervisor", text)) == 2
        assert exchanges[0] == exchanges[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decoding_reads_the_needed_lists(spark, folder):
    from fieldweave.operators import coded, lists
    from fieldweave.sources.tables import BoundTables

    own = BoundTables(spark, folder)
    text = plan(coded.code_lists(own, lists.all_properties(own), ["harv_status"]))
    assert text.count("FileScan") == 1 and "l_linestatus" in text
