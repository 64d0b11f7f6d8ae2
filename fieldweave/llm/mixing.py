"""Mix sources to target weights."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import BLANKS, packed_row, ranged, stored, word_count

#: Weights of the sources by code point, repeating.
WEIGHTS = (3, 1, 2)
#: The mix holds SHARE_UP / SHARE_DOWN of all words, and a source is used at most MOST times.
SHARE_UP, SHARE_DOWN, MOST = 3, 2, 2


def targets(sizes: DataFrame) -> DataFrame:
    """``source_key, source_size, target`` from ``source_key, source_size``.

    A target is the source's share by weight of the mix. Targets above ``MOST`` times the source's size stop there, and
    what they leave is shared again among the others until none is above. Each round settles at least one source;
    only sums over the sources reach the driver.
    """
    ranked = ranged(sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1)), ["all", "source_key"], "all", "one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("before_one") % len(WEIGHTS) + 1).cast("int"))
    rows = stored(ranked.select("source_key", "source_size", weight.cast("long").alias("weight")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    # Sums of whole numbers, so no order of adding changes them: a target is weight * spare / (SHARE_DOWN * weights).
    capped = F.lit(False)
    spare, weights = SHARE_UP * total, rows.agg(F.sum("weight")).first()[0] or 1
    # Products of all words and all weights pass 64 bits.
    wide = lambda column: F.col(column).cast("decimal(19,0)")
    number = lambda value: F.lit(Decimal(value)).cast("decimal(38,0)")
    while True:
        above = wide("weight") * number(spare) > wide("source_size") * number(MOST * SHARE_DOWN * weights)
        full, left = rows.agg(
            F.sum(F.when(capped | above, F.col("source_size"))), F.sum(F.when(~(capped | above), F.col("weight")))).first()
        following = (SHARE_UP * total - MOST * SHARE_DOWN * (full or 0), left or 0)
        capped = capped | above
        if following == (spare, weights) or not following[1]:
            spare, weights = following
            break
        spare, weights = following
    free = (wide("weight") * number(spare)).cast("double") / F.lit(float(SHARE_DOWN * max(weights, 1)))
    target = F.when(capped, (F.col("source_size") * MOST).cast("double")).otherwise(free)
    return rows.select("source_key", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken`` and ``row``, a struct of ``carry``.

    Each source's documents are put in the order of a hash of their id. Running totals of words over that order, summed
    by range-sorted tasks, tell where the source's target is reached: all documents are taken as many whole times as
    the target holds the source, and once more up to the exact word at which the rest is used up. ``taken`` is the
    number of words, at most ``MOST`` times ``size``.

    NULL texts have no words and are taken with none; NULL sources are a source of their own, the last one. Rows that
    repeat an id follow each other and are taken each for itself; NULL ids come first. No rows give no rows. Other
    columns may have any name, as only ``carry`` is kept, inside ``row``.
    """
    source = F.col(source_col)
    rows = docs.select(
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("source_key"),
        F.md5(F.col(id_col).cast("string").cast("binary")).alias("draw"), F.col(id_col).cast("long").alias("doc_id"),
        word_count(F.col(text_col)).alias("size"), packed_row(carry).alias("row"))
    ordered = ranged(rows, ["source_key", "draw", "doc_id"], "source_key", "size")
    goals = stored(targets(ordered.groupBy("source_key").agg(F.sum("size").alias("source_size"))))
    whole = F.col("target").cast("long")
    times = F.when(F.col("source_size") > 0, F.expr("cast(target as bigint) div source_size")).otherwise(0)
    last = F.greatest(F.lit(0), F.least(F.col("size"), whole - times * F.col("source_size") - F.col("before_size")))
    return ordered.join(goals, "source_key").select(
        "doc_id", "size", "source_size", "target", (times * F.col("size") + last).cast("long").alias("taken"), "row")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a document taken twice is two rows.

    A document of which only some words are taken has a row with these first words, one space between them, behind the
    blanks that the text begins with, and ``n_chars`` follows its text. A document that is not taken has no row.
    """
    taken = mix(docs, carry=tuple(docs.columns)).filter("taken > 0")
    copies = F.expr("transform(sequence(0, cast((taken - 1) div size as int)), i -> least(size, taken - i * size))")
    rows = taken.select("row", "size", F.explode(copies).alias("part"))
    lead = F.regexp_extract("row.text", r"^[\x20\x09-\x0D]*", 0)
    body = F.regexp_replace("row.text", r"^[\x20\x09-\x0D]+", "")
    cut = F.concat(lead, F.array_join(F.slice(F.split(body, BLANKS), F.lit(1), F.col("part").cast("int")), " "))
    text = F.when(F.col("part") < F.col("size"), cut).otherwise(F.col("row.text"))
    is_cut = F.col("part") < F.col("size")
    changed = {"text": text, "n_chars": F.when(is_cut, F.length(text)).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": text}
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
