"""Near duplicates by MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import in_parts, stored, unused
from fieldweave.llm.graph import components
from fieldweave.llm.hashing import U64, mixed, odd_numbers, window_hashes, word_hashes

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair of similarity 0.75 shares no band with probability (1 - 0.75 ** ROWS) ** BANDS, 5e-6.
BANDS, ROWS = 32, 4
#: Of the 128 bits of two sketches, 16 differ on average at similarity 0.75; more than 35 with probability 2e-6.
FAR_BITS = 35

_FACTORS = odd_numbers(BANDS * ROWS, 81)
_SHIFTS = odd_numbers(BANDS * ROWS, 82)
_BAND = odd_numbers(ROWS, 83)


def shingles(text: str | None) -> np.ndarray:
    """The set of word shingles of a text as sorted numbers; a shorter text is one shingle."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if 0 < len(words) < WORDS:
        return mixed(window_hashes(words, len(words)) + U64(len(words)))
    return np.unique(window_hashes(words, WORDS))


def signature(items: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash (a * x + b) over the set."""
    least = np.full(len(_FACTORS), U64(2**64 - 1))
    for start in range(0, len(items), 512):
        block = items[start:start + 512]
        np.minimum(least, (_FACTORS[:, None] * block + _SHIFTS[:, None]).min(axis=1), out=least)
    return least


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mixed(np.arange(BANDS, dtype=U64))
    for batch in in_parts(batches):
        sizes, digests, keys, sketches = [], [], [], []
        for text in batch.column(2).to_pylist():
            items = shingles(text)
            sizes.append(len(items))
            if not len(items):
                digests.append(None)
                keys.append(None)
                sketches.append((0, 0))
                continue
            least = signature(items)
            digests.append(xxhash.xxh3_128_digest(items.tobytes()))
            keys.append(mixed((least.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=U64) + seeds).view(np.int64))
            bits = (mixed(least) & U64(1)).astype(np.uint8)
            sketches.append(tuple(np.packbits(bits).view(np.int64)))
        offsets = np.r_[0, np.cumsum([0 if k is None else BANDS for k in keys])].astype(np.int32)
        flat = np.concatenate([k for k in keys if k is not None] or [np.empty(0, np.int64)])
        first, second = zip(*sketches) if sketches else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.ListArray.from_arrays(offsets, flat), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
            names=["doc_id", "text_key", "n_shingles", "set_id", "bands", "s1", "s2"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        found = [shingles(text).view(np.int64) for text in batch.column(1).to_pylist()]
        offsets = np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)
        items = pa.ListArray.from_arrays(offsets, np.concatenate(found or [np.empty(0, np.int64)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), items], names=["row", "items"])


def _near(a: str, b: str) -> Column:
    """What two texts with a link meet at any rate: sizes and sketches are close."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    differ = sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("s1", "s2"))
    return (100 * n >= PERCENT * m) & (100 * m >= PERCENT * n) & (differ <= FAR_BITS)


def _pair(a: str, b: str) -> list[Column]:
    x, y = F.col(f"{a}.row"), F.col(f"{b}.row")
    return [F.greatest(x, y).alias("u"), F.least(x, y).alias("v")]


def _sets_of(rows: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``row, items``: the full sets of the texts of ``rows``."""
    wanted = stored(rows.distinct().join(nodes.select("row", F.col("doc_id").alias("id"), F.col("text_key").alias("key")), "row"))
    found = texts.join(wanted.hint("merge"), (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")))
    return stored(found.select("row", "text").mapInArrow(_sets, "row long, items array<long>").dropDuplicates(["row"]))


def _similar(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    u, v = (sets.select(F.col("row").alias(c), F.col("items").alias(f"items_{c}")) for c in "uv")
    return pairs.join(u, "u").join(v, "v").filter(_similar("items_u", "items_v")).select("u", "v")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    return _compared(pairs, _sets_of(pairs.select(F.explode(F.array("u", "v")).alias("row")), texts, nodes))


def _least_shared(size: Column, partner: str) -> Column:
    """The least number of shingles that a set of ``size`` shares with one that it is linked with.

    A link has (100 + PERCENT) * both >= PERCENT * (size + other size). The other set has ``size`` shingles or more if it is
    the ``longer`` one, and PERCENT of a hundred of them or more if it is any.
    """
    return F.ceil(2 * PERCENT * size / (100 + PERCENT)) if partner == "longer" else F.ceil(PERCENT * size / 100)


def _rarest(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``item, row, part, n_shingles, s1, s2, own, place, short``: the rarest shingles of each set of ``rows``, as far as components share them.

    In one order of all shingles, those that one component alone has first, then by frequency, two linked sets share one among
    their first ``size - least shared + 1``. ``place`` counts in this order, ``own`` the shingles of one component alone; ``short`` says that the shingle is
    among those of the set as the smaller one of a pair.
    """
    items = sets.join(rows.select("row", "part"), "row").select("row", "part", F.explode("items").alias("item"))
    often = stored(items.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
                   .filter("low != high").select("item", "n"))
    ordered = items.select("row", "item").join(often.hint("merge"), "item").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("n", "item"))).alias("shared"))
    size, own = F.col("n_shingles"), F.col("n_shingles") - F.size("shared")
    wanted = (size - _least_shared(size, "any") + 1 - own).cast("int")
    first = ordered.join(rows, "row").filter(wanted > 0).select(
        "row", "part", "n_shingles", "s1", "s2", own.alias("own"), F.posexplode(F.slice("shared", F.lit(1), wanted)).alias("n", "each"))
    place = F.col("own") + F.col("n")
    return first.select("row", "part", "n_shingles", "s1", "s2", "own", F.col("each.item").alias("item"), place.alias("place"),
                        (place <= size - _least_shared(size, "longer")).alias("short"))


def _may_link(a: str, b: str) -> Column:
    """What two rows of ``_rarest`` with one shingle meet if their sets are linked and this is the first shingle that both have."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    smaller = F.when((n < m) | ((n == m) & (F.col(f"{a}.row") < F.col(f"{b}.row"))), F.col(f"{a}.short")).otherwise(F.col(f"{b}.short"))
    # From the first shingle that both have on, enough must be left.
    left = (100 + PERCENT) * F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place")) >= PERCENT * (n + m)
    return smaller & left & _near(a, b)


def _hub_pairs(rarest: DataFrame) -> DataFrame:
    """Each node with the hubs of its rarest shingles, if they are in another component.

    The hub of a shingle is the node with the least share of shingles that no other component has, among those of like size. In a
    group of near copies that is the one with the fewest edits, which most others are linked with. Pairs are no more than ``rarest``.
    """
    rows = rarest.withColumn("like", F.floor(F.log("n_shingles") / F.log(F.lit(100 / PERCENT))))
    hubs = stored(rows.groupBy("item", "like").agg(F.min_by("row", F.struct(F.col("own") / F.col("n_shingles"), F.col("row"))).alias("row")))
    hubs = stored(rows.join(hubs.hint("merge"), ["item", "like", "row"]))
    same = (F.col("a.item") == F.col("b.item")) & (F.col("a.like") == F.col("b.like")) & (F.col("a.part") != F.col("b.part"))
    return stored(rows.alias("a").join(hubs.alias("b"), same & _may_link("a", "b")).select(*_pair("a", "b")).distinct())


def _all_pairs(rarest: DataFrame) -> DataFrame:
    """All nodes of different components that share one of their rarest shingles, as linked ones do.

    What the pages of a site have in common is frequent among them, so pages with one frame meet only if little else is in them.
    One of two nodes is outside the component that most nodes with the shingle belong to.
    """
    shares = rarest.groupBy("item", "part").agg(F.count(F.lit(1)).alias("n"))
    main = shares.groupBy("item").agg(F.max_by("part", "n").alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    ends = stored(rarest.join(main.hint("merge"), "item"))
    apart = (F.col("a.part") != F.col("b.part")) & ((F.col("a.part") == F.col("a.main")) | (F.col("a.row") < F.col("b.row")))
    same = (F.col("a.item") == F.col("b.item")) & apart & _may_link("a", "b")
    return stored(ends.alias("a").join(ends.filter("part != main").alias("b"), same).select(*_pair("a", "b")).distinct())


def _mixed_buckets(members: DataFrame, tied: DataFrame) -> DataFrame:
    """The ``members`` of buckets that are in several components so far, each with its component as ``part``."""
    named = members.join(tied.select(F.col("u").alias("row"), "v"), "row", "left").withColumn("part", F.coalesce("v", "row")).drop("v")
    parts = named.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high")
    return stored(named.join(parts.select("band"), "band"))


def _tied_within(tied: DataFrame, members: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``tied`` with the links between nodes of mixed buckets that are in no common component.

    Nodes are compared with the hubs of their rarest shingles first, at a cost in proportion to the rows, which leaves little of a
    large group of near copies apart. All pairs of what is in mixed buckets still then follow.
    """
    sets = None
    for pairs in (_hub_pairs, _all_pairs):
        members = _mixed_buckets(members.drop("part"), tied)
        rows = stored(members.filter("row != center").select("row", "part", "n_shingles", "s1", "s2").distinct())
        if rows.isEmpty():
            break
        sets = sets or _sets_of(rows.select("row"), texts, nodes)
        tied = _tied_more(tied, _compared(pairs(stored(_rarest(rows, sets))), sets))
    return tied


def _apart(pairs: DataFrame, tied: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components so far."""
    ends = [tied.select(F.col("u").alias(c), F.col("v").alias(f"part_{c}")) for c in "uv"]
    named = pairs.join(ends[0], "u", "left").join(ends[1], "v", "left")
    return named.filter(F.coalesce("part_u", "u") != F.coalesce("part_v", "v")).select("u", "v")


def _tied_more(tied: DataFrame, links: DataFrame) -> DataFrame:
    links = stored(links)
    return tied if links.isEmpty() else components(tied.unionByName(links))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``, and ``text_key``, a hash of its text.

    Texts with equal shingle sets are one node. Nodes that share a band of minima are a bucket. Every node is compared
    with the first node of each of its buckets: by size and sketch of the signature inside the join, then by full
    sets, with the smallest of these first nodes first, and with others if they are not in one component by then. After
    large-star and small-star steps over the links found, most buckets lie in one component. The nodes of the others are
    compared with the node that has the least of its own among those with one of their rarest shingles. What is still apart is
    joined on its rarest shingles, of which linked nodes share one, so no candidate pair that could still connect two components is
    left out, no bucket is capped, and what many pages share pairs none of them. Sizes, places and sketches are compared
    inside that join, full sets after it; the steps are then repeated with the links found. Joins are between stored tables, which
    lets Spark split hot keys.

    Texts without words have no shingles and are linked with nothing. NULL ids come last when the row that stays is
    chosen; of rows that repeat an id within a component one stays. Other columns are not read. No rows give no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    described = stored(
        texts.mapInArrow(_described, "doc_id long, text_key long, n_shingles long, set_id binary, bands array<long>, s1 long, s2 long")
        .withColumn("row", F.monotonically_increasing_id()))
    copies = stored(
        described.filter("set_id is not null").groupBy("set_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("node")).filter("n > 1").drop("n"))
    rows = stored(
        described.select("row", "doc_id", "text_key", "n_shingles", "set_id").join(copies.hint("merge"), "set_id", "left")
        .select("row", "doc_id", "text_key", "n_shingles", F.coalesce("node", "row").alias("node")))
    repeats = rows.filter("row != node").select("row")
    nodes = described.filter("set_id is not null").join(repeats, "row", "left_anti")
    in_bands = nodes.select(F.posexplode("bands").alias("place", "band"), "row")
    buckets = stored(
        in_bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("center")).filter("n > 1").drop("n"))
    members = stored(
        in_bands.join(buckets.hint("merge"), "band")
        .join(described.select("row", "n_shingles", "s1", "s2"), "row"))
    centers = members.filter("row = center")
    links = F.col("a.band") == F.col("b.band")
    first = stored(
        members.filter("row != center").alias("a").join(centers.alias("b"), links & _near("a", "b")).select(*_pair("a", "b")).distinct())
    tied = components(_verified(first.groupBy("u").agg(F.min("v").alias("v")), texts, described))
    tied = _tied_more(tied, _verified(stored(_apart(first, tied)), texts, described))

    tied = _tied_within(tied, members, texts, described)

    placed = stored(
        rows.join(tied.select(F.col("u").alias("node"), "v"), "node", "left")
        .select("row", "doc_id", "text_key", "n_shingles", F.coalesce("v", "node").alias("part")))
    groups = stored(
        placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"),
                                   F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("first_row")).filter("n > 1").drop("n"))
    return placed.join(groups, "part", "left").select(
        "doc_id", "n_shingles", F.when(F.col("first_row").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id"),
        (F.col("first_row").isNull() | (F.col("row") == F.col("first_row"))).alias("kept"), "text_key")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows equal in id and text all stay if one of them does."""
    own, key = unused(docs, "gone_id"), unused(docs, "gone_key")
    found = near_groups(docs, id_col, text_col).groupBy(F.col("doc_id").alias(own), F.col("text_key").alias(key)).agg(F.max("kept").alias("kept"))
    found = stored(found.filter("not kept").drop("kept"))
    gone = (F.xxhash64(text_col) == F.col(key)) & F.col(id_col).cast("long").eqNullSafe(F.col(own))
    return docs.join(found.hint("merge"), gone, "left_anti")
