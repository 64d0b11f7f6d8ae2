"""Row identifiers: GlobalIDs, GUID columns and new ObjectIDs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from fieldweave.operators.joins import sieve, sifted
from fieldweave.sources.sinks import stored, work_folder

# A block holds 2^12 neighbouring keys, and so at most that many rows, as keys are unique; an area holds 2^20 blocks.
BLOCK_BITS = 12
AREA_BITS = 20

# Equal rows that are written out together.
COPIES = 1 << 16

CONTENT_HASH = "_content_hash"


def add_global_ids(rows: DataFrame, dataset: str, oid: str = "ObjectID") -> DataFrame:
    """``rows`` with a ``GlobalID`` column, unless there is one."""
    if "globalid" in (name.lower() for name in rows.columns):
        return rows
    return rows.withColumn("GlobalID", X.global_id(dataset, oid))


def content(columns: list[str]) -> Column:
    """The values of a row as one text that no other values give: each with its length in front, NULL as ``N``."""
    texts = [F.col(f"`{name}`").cast("string") for name in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in texts])


def _numbered_copies(rows: DataFrame, dataset: str, values: list[Column], copies: int) -> DataFrame:
    """``rows`` with a GlobalID from the values of a row and its number among equal rows.

    Equal rows are counted and then written out by their numbers, in blocks of ``copies``; nothing is sorted, and the
    blocks of a row that fills a third of the table are dealt to all tasks.
    """
    counted = rows.groupBy(*values).agg(F.count("*").alias("_copies"))
    last = F.floor((F.col("_copies") - 1) / copies)
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = blocks.repartition(F.col("_block"), *values)
    begin = F.col("_block") * copies
    each = dealt.withColumn("_number", F.explode(F.sequence(begin + 1, F.least(begin + copies, F.col("_copies")))))
    return each.select(*values, _content_id(rows.columns, dataset, F.col("_number").cast("string")))


def _content_id(columns: list[str], dataset: str, number: Column) -> Column:
    return X.global_id(dataset, F.concat(content(columns), F.lit("#"), number)).alias("GlobalID")


def add_content_ids(rows: DataFrame, dataset: str, copies: int = COPIES) -> DataFrame:
    """``rows`` of a table without a key with a ``GlobalID`` column, unless there is one.

    An identifier comes from the row's values and its number among equal rows, so the same rows get the same ones again.
    Rows are first counted by a hash of their values. Those whose hash is the only one of its kind are number 1 where they
    stand, so whole rows neither fill hash maps nor move. The rest, all repeated rows among them, is grouped by its values.
    """
    if "globalid" in (name.lower() for name in rows.columns):
        return rows
    values = [F.col(f"`{name}`") for name in rows.columns]
    folder = work_folder(rows.sparkSession)
    hashed = rows.withColumn(CONTENT_HASH, F.xxhash64(*values))
    counts = hashed.groupBy(CONTENT_HASH).agg(F.count("*").alias("_copies"))
    repeated = stored(counts.filter("_copies > 1").select(CONTENT_HASH), f"{folder}/repeated")
    by = sieve(repeated, CONTENT_HASH, least=0)
    by = by._replace(rows=stored(by.rows, f"{folder}/sieve"))
    several = _numbered_copies(sifted(hashed, by, CONTENT_HASH).select(*values), dataset, values, copies)
    alone = sifted(hashed, by, CONTENT_HASH, passed=False)
    return several.unionByName(alone.select(*values, _content_id(rows.columns, dataset, F.lit("1"))))


def add_guid_column(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with an empty text column ``name``, unless there is one."""
    if name.lower() in (column.lower() for column in rows.columns):
        return rows
    return rows.withColumn(name, F.lit(None).cast("string"))


def number_rows(rows: DataFrame, group: str, key: str, name: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` numbered 1, 2, 3 … by ``group``, then by the unique whole number ``key``, without one global sort.

    Keys are numbered inside blocks of neighbouring keys, and the numbers then join the rows, so nothing else is sorted.
    The start of a block is the number of rows in the blocks before it, found from the block sizes in two steps, so each
    window spans a bounded number of rows. Nothing depends on how rows are split into tasks: a repeated task gives the
    same numbers.
    """
    block = F.shiftright(F.col(key).cast("long"), bits).alias("_block")
    keys = rows.select(group, key, block)
    sizes = keys.groupBy(group, "_block").agg(F.count("*").alias("_rows"))
    sizes = sizes.withColumn("_area", F.shiftright("_block", AREA_BITS))
    areas = sizes.groupBy(group, "_area").agg(F.sum("_rows").alias("_rows"))

    def before(order: WindowSpec) -> Column:
        return F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # An area spans 2^32 keys, so tables have a handful of them.
    starts = areas.select(group, "_area", before(Window.orderBy(group, "_area")).alias("_area_start"))
    in_area = before(Window.partitionBy(group, "_area").orderBy("_block"))
    blocks = (
        sizes.select(group, "_area", "_block", in_area.alias("_block_start"))
        .join(starts, [group, "_area"])
        .select(group, "_block", (F.col("_area_start") + F.col("_block_start")).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy(group, "_block").orderBy(key))
    numbered = keys.withColumn("_place", place).join(blocks, [group, "_block"])
    numbers = numbered.select(group, key, (F.col("_start") + F.col("_place")).alias(name))
    return rows.join(numbers, [group, key]).select(*rows.columns, name)


def next_object_ids(
    target: DataFrame, rows: DataFrame, group: str, key: str, id_col: str = "OBJECTID", highest: int | None = None
) -> DataFrame:
    """``rows`` with ``id_col`` counting on from the highest one in ``target``, in the order of ``group`` and ``key``.

    Who knows the highest one passes it, and ``target`` is not read.
    """
    last = F.lit(highest) if highest is not None else target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_highest")).scalar()
    numbered = number_rows(rows, group, key, "_number")
    return numbered.withColumn(id_col, F.col("_number") + last).drop("_number")
