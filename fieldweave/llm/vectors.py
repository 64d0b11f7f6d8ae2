"""Near duplicates among embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import ranged, stored
from fieldweave.llm.graph import components

THRESHOLD = 0.95
#: Vectors in a block, and in the tiles in which two blocks are compared.
BLOCK, TILE = 4096, 512
#: Dimensions after which the bounds are looked at; a power of two at a time.
FIRST_DIMENSIONS = 16
#: Rounding of a sum of products, far above what doubles need.
SLACK = 1e-9
#: Above this share of pairs that are still open a whole tile is multiplied on.
DENSE = 0.05


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            part = _matrix(batch.column(0))
            total = part.T @ part if total is None else total + part.T @ part
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "value"])


def principal_axes(units: DataFrame, size: int) -> np.ndarray:
    """Axes of falling variance for the column ``unit`` of vectors of ``size`` components.

    Each task sums its products; the driver gets one number for each pair of components.
    """
    sums = units.select("unit").mapInArrow(_moments, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    moments = np.zeros((size, size))
    for i, j, value in sums.collect():
        moments[i, j] = moments[j, i] = value
    return np.linalg.eigh(moments)[1][:, ::-1].copy()


def open_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the pairs of unit vectors with a product of at least ``threshold``.

    Products of the leading dimensions come first. What the others can add is at most the product of the norms of the
    rests, so a pair is done once even that does not reach the threshold.
    """
    size = a.shape[1]
    done = min(FIRST_DIMENSIONS, size)
    sums = a[:, :done] @ b[:, :done].T
    rest = lambda x, n: np.sqrt(np.einsum("ij,ij->i", x[:, n:], x[:, n:]))
    i, j = np.nonzero(sums + np.outer(rest(a, done), rest(b, done)) >= threshold - SLACK)
    if len(i) > DENSE * sums.size:
        sums += a[:, done:] @ b[:, done:].T
        return np.nonzero(sums >= threshold)
    found = sums[i, j]
    while done < size and len(i):
        following = min(2 * done, size)
        found = found + np.einsum("ij,ij->i", a[i, done:following], b[j, done:following])
        done = following
        keep = found + rest(a, done)[i] * rest(b, done)[j] >= threshold - SLACK
        i, j, found = i[keep], j[keep], found[keep]
    keep = found >= threshold
    return i[keep], j[keep]


def _compared(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = [np.frombuffer(row[f"nodes_{s}"], np.int64) for s in "ab"]
                sizes = [np.frombuffer(row[f"sizes_{s}"], np.int64) for s in "ab"]
                a, b = (np.frombuffer(row[f"units_{s}"], np.float64).reshape(len(n), -1) for s, n in zip("ab", nodes))
                own = row["a"] == row["b"]
                at_b = 0 if own else len(a)
                label = np.arange(len(a) + (0 if own else len(b)))
                links = np.zeros(len(label), np.int64)
                for x in range(0, len(a), TILE):
                    for y in range(x if own else 0, len(b), TILE):
                        i, j = open_pairs(a[x:x + TILE], b[y:y + TILE], threshold)
                        if own and x == y:
                            i, j = i[i < j], j[i < j]
                        if not len(i):
                            continue
                        i, j = i + x, j + y
                        links += np.bincount(i, sizes[1][j], len(label)).astype(np.int64)
                        links += np.bincount(j + at_b, sizes[0][i], len(label)).astype(np.int64)
                        _join(label, i, j + at_b)
                every = nodes[0] if own else np.concatenate(nodes)
                linked = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every[linked]), pa.array(links[linked]), pa.array(every[label[linked]])], names=["node", "links", "near"])

    return run


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give all places that pairs connect the smallest label among them."""
    while True:
        x, y = label[i], label[j]
        differ = x != y
        if not differ.any():
            return
        low, high = np.minimum(x, y)[differ], np.maximum(x, y)[differ]
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label[:] = label[label]


def _packed(axes: dict[int, np.ndarray]):
    def run(key, table):
        # Within a block vectors have one length; ``part`` numbers (length, block) pairs.
        units = _matrix(table.column("unit").combine_chunks())
        lead = table.column("lead").to_numpy()
        turned = units @ axes[units.shape[1]] if units.shape[1] in axes else units
        return pa.table({
            "size": [units.shape[1]], "block": [key[1].as_py()], "low": [float(lead.min())], "high": [float(lead.max())],
            "nodes": [table.column("node").to_numpy().astype(np.int64).tobytes()],
            "sizes": [table.column("n").to_numpy().astype(np.int64).tobytes()], "units": [np.ascontiguousarray(turned).tobytes()]})

    return run


def near_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Equal vectors are one node. Unit vectors are turned to their principal axes, sorted by the first of them and cut into
    blocks of ``BLOCK``. Vectors further apart on an axis than two unit vectors of that cosine can be are no pair, so each
    block meets only the blocks in reach; such a pair of blocks is one row, compared tile by tile, leading dimensions
    first. A pair of blocks returns for each node its number of links and its smallest connection there, not the pairs.

    NULL vectors, empty, zero ones and such with NULL or non-finite components link with nothing. Vectors of different
    length do not link; the axes are those of the most frequent length, other lengths are compared unturned. Rows with
    a NULL id come last when the row that stays is chosen; of rows that repeat an id within a component one stays. No
    rows give no rows; other columns are not read. ``threshold`` is above 0.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double") + 0.0)
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    whole = F.col("vector").isNotNull() & ~F.exists("vector", wrong) & F.exists("vector", lambda x: x != 0)
    rows = stored(rows.select("vec_id", F.when(whole, F.col("vector")).alias("vector"), F.monotonically_increasing_id().alias("row")))
    nodes = stored(rows.filter("vector is not null").groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("node")))
    # Scaled by the largest component first, so that neither large nor small ones leave the range of doubles.
    top = F.array_max(F.transform("vector", F.abs))
    scaled = nodes.select("node", "n", F.size("vector").cast("long").alias("size"), F.transform("vector", lambda x: x / top).alias("scaled"))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    units = stored(scaled.withColumn("norm", norm).select(
        "node", "n", "size", F.transform("scaled", lambda x: x / F.col("norm")).alias("unit")))
    frequent = units.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    axes = {} if frequent is None else {frequent["size"]: principal_axes(units.filter(F.col("size") == frequent["size"]), frequent["size"])}
    first = {size: axis[:, 0] for size, axis in axes.items()}

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [float(np.dot(u, first[len(u)])) if len(u) in first else u[0] for u in batch.column(3).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=["node", "n", "size", "unit", "lead"])

    led = units.mapInArrow(lead, "node long, n long, size long, unit array<double>, lead double").withColumn("one", F.lit(1))
    blocks = ranged(led, ["size", "lead", "node"], "size", "one").withColumn("block", F.floor(F.col("before_one") / BLOCK))
    packed = stored(blocks.select("size", "block", "node", "n", "unit", "lead").groupBy("size", "block").applyInArrow(
        _packed(axes), "size long, block long, low double, high double, nodes binary, sizes binary, units binary"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    slot = lambda x: F.floor(x / reach)
    narrow = packed.select("size", "block", "low", "high")
    left = narrow.withColumn("slot", F.explode(F.sequence(slot(F.col("low")), slot(F.col("high") + reach)))).alias("l")
    right = narrow.withColumn("slot", F.explode(F.sequence(slot(F.col("low")), slot(F.col("high"))))).alias("r")
    meet = left.join(right, (F.col("l.size") == F.col("r.size")) & (F.col("l.slot") == F.col("r.slot"))
                     & (F.col("r.block") >= F.col("l.block")) & (F.col("r.low") <= F.col("l.high") + reach))
    meet = meet.select(F.col("l.size").alias("size"), F.col("l.block").alias("a"), F.col("r.block").alias("b")).distinct()
    side = lambda s: packed.select("size", F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "sizes", "units")])
    found = stored(meet.join(side("a"), ["size", "a"]).join(side("b"), ["size", "b"]).mapInArrow(
        _compared(threshold), "node long, links long, near long"))
    tied = components(found.select(F.col("node").alias("u"), F.col("near").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    facts = nodes.select("node", "vector", "n").join(links, "node", "left").join(
        tied.select(F.col("u").alias("node"), "v"), "node", "left")
    facts = stored(facts.filter("n > 1 or links is not null").select(
        "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("v", "node").alias("part")))
    placed = stored(rows.join(facts, "vector", "left").select("row", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "part"))
    groups = stored(placed.filter("part is not null").groupBy("part").agg(
        F.min("vec_id").alias("first_id"), F.coalesce(F.min_by("row", "vec_id"), F.min("row")).alias("first_row")))
    return placed.join(groups, "part", "left").select(
        "vec_id", "n_links", F.when(F.col("first_row").isNull(), F.col("vec_id")).otherwise(F.col("first_id")).alias("component_id"),
        (F.col("first_row").isNull() | (F.col("row") == F.col("first_row"))).alias("kept"))
