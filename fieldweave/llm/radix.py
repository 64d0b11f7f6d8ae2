"""Exact duplicates, found by splitting documents byte by byte."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import BLANKS, forget, packed_row, stored

FIRST_DIGIT, GROWTH = 256, 8


def normalised(text: Column) -> Column:
    """One space for each run of blanks; NULL becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and ``row``, a struct of ``carry``.

    Most significant digits first: documents are grouped by their first ``FIRST_DIGIT`` bytes. Groups of one are done.
    The others are split by the following bytes, ``GROWTH`` times as many in each round, until a group has one member
    or its text has ended; then its members are equal byte by byte, and no digest is compared. The number of rounds
    grows with the logarithm of the longest text. Grouping combines copies before the shuffle, and the join that hands
    out the groups of the next round is between two stored tables, so that Spark can split a hot group over tasks. These
    joins are sort-merge joins at every size: the tables of shared digits grow with the corpus.

    NULL texts count as empty ones; empty texts are equal. Of equal texts the row with the smallest id stays; rows with
    a NULL id come last. Rows that repeat an id and a text count each in ``group_size``, and one of them stays. Other
    columns may have any name, as only ``carry`` is kept, inside ``row``. No rows give no rows.
    """
    text = F.encode(normalised(F.col(text_col)), "utf-8")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), packed_row(carry).alias("row"), text.alias("rest"))
    digit = F.substring("rest", 1, FIRST_DIGIT)
    shared = stored(
        base.select(digit.alias("digit")).groupBy("digit").count().filter("count > 1")
        .select("digit", F.monotonically_increasing_id().alias("part"))
    )
    alone = (
        base.select("doc_id", "row", digit.alias("digit"), F.sha2("rest", 256).alias("text_sha256"))
        .join(shared.hint("merge"), "digit", "left_anti")
        .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                F.lit(True).alias("kept"), "text_sha256", "row")
    )
    tied = stored(
        base.withColumn("digit", digit).join(shared.hint("merge"), "digit")
        .select(F.monotonically_increasing_id().alias("place"), "part", "doc_id", "row", "rest",
                F.sha2("rest", 256).alias("text_sha256"))
    )
    members = _split(tied.select("place", "part", "doc_id", F.expr(f"substring(rest, {FIRST_DIGIT + 1})").alias("rest"),
                                 (F.octet_length("rest") < FIRST_DIGIT).alias("ended")))
    found = tied.drop("rest", "part").join(members, "place", "left")
    rest = found.select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("place") == F.col("keep_place"))).alias("kept"), "text_sha256", "row")
    return alone.unionByName(rest)


def _split(state: DataFrame) -> DataFrame:
    """``place, keep_id, keep_place, group_size`` of the members of groups of equal texts."""
    width, done, kept = FIRST_DIGIT, [], None
    while True:
        width *= GROWTH
        digit = F.substring("rest", 1, width)
        sizes = (
            state.withColumn("digit", F.when(F.col("ended"), F.lit(b"")).otherwise(digit)).groupBy("part", "digit", "ended")
            .agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"),
                 F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("keep_place"))
            .filter("group_size > 1").withColumn("next", F.monotonically_increasing_id())
        )
        sizes = stored(sizes)
        joined = state.withColumn("digit", F.when(F.col("ended"), F.lit(b"")).otherwise(digit)).join(sizes.hint("merge"), ["part", "digit", "ended"])
        done.append(stored(joined.filter("ended").select("place", "keep_id", "keep_place", "group_size")))
        open_ = stored(joined.filter("not ended").select(
            "place", F.col("next").alias("part"), "doc_id", F.expr(f"substring(rest, {width + 1})").alias("rest"),
            (F.octet_length("rest") < width).alias("ended")))
        if kept is not None:
            forget(kept)
        state = kept = open_
        if state.isEmpty():
            break
    members = done[0]
    for more in done[1:]:
        members = members.unionByName(more)
    return members


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return exact_groups(docs, carry=tuple(docs.columns)).filter("kept").select("row.*")
