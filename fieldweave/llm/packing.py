"""Pack documents into sequences of equal length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import in_parts, ranged, stored
from fieldweave.llm.tokens import ids_by

LENGTH = 2048
#: Rests of documents are packed in whole units of so many tokens.
UNIT = 16
END = 1
#: The linear program ends after so many steps without gain, or steps for each class; any basis packs every document.
IDLE, STEPS = 50, 8


def patterns(demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """(items of each class, how often) for ``demand[c]`` items of ``c`` units in sequences of ``room`` units.

    The cutting-stock linear program over all patterns, solved by column generation: the duals of the present basis
    price an unbounded knapsack over the room, and its best pattern enters the basis, until none prices above one.
    Uses are then rounded down. Patterns that leave the least room come first.
    """
    classes = np.flatnonzero(demand[:room])
    if not len(classes):
        return []
    # Tiny unequal shares keep steps from having no length, with which bases could follow each other in a circle.
    wanted = demand[classes] + np.random.default_rng(room).uniform(1e-4, 1e-3, len(classes))
    least, idle = np.inf, 0
    basis = np.diag((room // classes).astype(float))  # one column for each pattern, one row for each class
    uses = wanted / np.diag(basis)
    inverse = np.diag(1 / np.diag(basis))
    for _ in range(STEPS * len(classes)):
        uses = np.maximum(inverse @ wanted, 0.0)
        worth = inverse.sum(axis=0)
        best, last = np.zeros(room + 1), np.full(room + 1, -1)
        for space in range(1, room + 1):
            fits = classes <= space
            values = best[space - classes[fits]] + worth[fits]
            best[space], last[space] = best[space - 1], -1
            if len(values) and values.max() > best[space] + 1e-12:
                last[space] = int(values.argmax())
                best[space] = values[last[space]]
        idle = 0 if uses.sum() < least - 1e-6 else idle + 1
        least = min(least, uses.sum())
        if best[room] <= 1 + 1e-7 or idle > IDLE:  # beyond that only rounding errors move
            break
        entering, space = np.zeros(len(classes)), room
        while space > 0:
            if last[space] < 0:
                space -= 1
            else:
                entering[last[space]] += 1
                space -= classes[last[space]]
        direction = inverse @ entering
        steps = np.where(direction > 1e-7, uses / np.where(direction > 1e-7, direction, 1), np.inf)
        # Of equally short steps the one over the largest pivot keeps the basis well apart from a singular one.
        leaving = int(np.argmax(np.where(steps <= steps.min() + 1e-9, direction, -np.inf)))
        if not np.isfinite(steps[leaving]):
            break
        basis[:, leaving] = entering
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - np.outer(direction, row)
        inverse[leaving] = row
    found = []
    for column, use in zip(basis.T, uses):
        if use + 1e-6 >= 1:
            items = np.zeros(room, np.int64)
            items[classes] = column.astype(np.int64)
            found.append((items, int(use + 1e-6)))
    taken = sum((items * use for items, use in found), np.zeros(room, np.int64))
    while (taken > demand[:room]).any():  # what rounding of the solution put over the demand
        n = next(n for n, (items, _) in enumerate(found) if (items[taken > demand[:room]] > 0).any())
        taken -= found[n][0]
        found[n] = (found[n][0], found[n][1] - 1)
    return sorted(((items, use) for items, use in found if use), key=lambda f: room - int(f[0] @ np.arange(room)))


class Places:
    """Where the item of a class and rank goes, and where the loose ids go that fill what room the patterns leave.

    ``most`` sequences at most are filled by patterns, as many as there are ids to fill them.
    """

    def __init__(self, found: list[tuple[np.ndarray, int]], unit: int, length: int, most: int) -> None:
        self.unit, self.length, self.sequences = unit, length, 0
        self.rows: dict[int, tuple[np.ndarray, ...]] = {}
        runs: dict[int, list[tuple]] = {}
        gaps = [(0, 1, 0)]
        for items, use in found:
            use = min(use, most - self.sequences)
            offset = 0
            for size in np.flatnonzero(items) if use else ():
                runs.setdefault(int(size), []).append((items[size], use, self.sequences, offset * unit))
                offset += items[size] * size
            if use and offset * unit < length:
                gaps.append(((length - offset * unit) * use, length - offset * unit, self.sequences))
            self.sequences += use
        for size, parts in runs.items():
            each, use, base, offset = (np.array(x, np.int64) for x in zip(*parts))
            self.rows[size] = (np.r_[0, np.cumsum(each * use)], each, base, offset)
        total, self.gap, self.gap_base = (np.array(x, np.int64) for x in zip(*gaps))
        self.gap_starts = np.cumsum(total) - total
        self.gaps = int(total.sum())

    def loose(self, at: int, left: int, after: int) -> tuple[int, int, int]:
        """(ids, sequence, offset) of the next piece of loose ids, of which ``at`` come before; new sequences begin at ``after``."""
        if at < self.gaps:
            n = int(np.searchsorted(self.gap_starts, at, "right")) - 1
            use, inside = divmod(at - int(self.gap_starts[n]), int(self.gap[n]))
            gap = int(self.gap[n])
            return min(left, gap - inside), int(self.gap_base[n]) + use, self.length - gap + inside
        at -= self.gaps
        return min(left, self.length - at % self.length), after + at // self.length, at % self.length

    def of(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.full(len(sizes), -1, np.int64), np.full(len(sizes), -1, np.int64)
        for size in np.unique(sizes):
            if int(size) not in self.rows:
                continue
            starts, each, base, first = self.rows[int(size)]
            at = np.flatnonzero((sizes == size) & (ranks < starts[-1]))
            part = np.searchsorted(starts, ranks[at], "right") - 1
            use, place = np.divmod(ranks[at] - starts[part], each[part])
            sequence[at] = base[part] + use
            offset[at] = first[part] + place * size * self.unit
        return sequence, offset


def _tokenized(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_by(path)
        last = np.array([end], ids.kind).tobytes()
        width = len(last)
        for batch in in_parts(batches):
            found = [ids.of(text or "") + last for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), pa.array([len(x) // width for x in found], pa.int64()),
                 pa.array([width] * len(found), pa.int32())], names=["doc_id", "ids", "doc_tokens", "width"])

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its token ids, then ``end``; ``ids`` are those of the piece as little-endian unsigned 32-bit
    numbers. ``tokenizer`` is the path of a file that every executor has installed. Whole stretches of ``length`` ids
    are sequences of their own. The rests, in whole units of ``UNIT`` ids, are items of a cutting-stock problem whose demand
    is a histogram with one class per number of units, the only thing that reaches the driver. Its rounded patterns
    are dealt to the documents by their rank within their class. The ids behind the last unit, and rests that no pattern
    took, are laid end to end and cut to fill first the room that patterns leave, then further sequences. Patterns are used
    only as often as there are ids to fill them, so that only the very last sequence can have padding.

    Ranks and totals are summed over range-sorted tasks. NULL and empty texts are the end id alone. Rows that repeat an id are
    documents of their own. No rows give no rows; other columns are not read. ``length`` is a multiple of ``UNIT``.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = stored(
        texts.mapInArrow(_tokenized(tokenizer, end), "doc_id long, ids binary, doc_tokens long, width int")
        .withColumn("row", F.monotonically_increasing_id()))
    rest = F.col("doc_tokens") % length
    sizes = tokens.select(
        "row", F.expr(f"doc_tokens div {length}").alias("whole"), rest.alias("rest"),
        (rest / UNIT).cast("long").alias("units"), F.lit(1).alias("one"), F.xxhash64("row").alias("draw"))
    ranked = ranged(sizes, ["units", "draw", "row"], "units", "one")
    demand = np.zeros(length // UNIT, np.int64)
    left = 0
    for units, count, ids in ranked.groupBy("units").agg(F.count(F.lit(1)), F.sum("rest")).collect():
        demand[units] = count
        left += ids
    demand[0] = 0
    places = Places(patterns(demand, length // UNIT), UNIT, length, left // length)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, whole, left, units, rank = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in range(5))
            sequence, offset = places.of(units, rank)
            loose = np.where(sequence >= 0, left - units * UNIT, left)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row, whole, left, loose, sequence, offset)],
                                             names=["row", "whole", "rest", "loose", "sequence", "at"])

    found = ranked.select("row", "whole", "rest", "units", "before_one").mapInArrow(
        placed, "row long, whole long, rest long, loose long, sequence long, at long").withColumn("all", F.lit(0))
    plan = stored(ranged(found, ["all", "row"], "all", "whole", "loose").drop("all"))
    base = places.sequences
    stream = base + (plan.agg(F.sum("whole")).first()[0] or 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            pieces: list[tuple] = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<u2" if r["width"] == 2 else "<u4").astype("<u4")
                parts = [(n * length, length, base + r["before_whole"] + n, 0) for n in range(r["whole"])]
                start = r["whole"] * length
                if r["sequence"] >= 0:
                    parts.append((start, r["rest"] - r["loose"], r["sequence"], r["at"]))
                    start += r["rest"] - r["loose"]
                left, at = r["loose"], r["before_loose"]
                while left:
                    size, sequence, offset = places.loose(at, left, stream)
                    parts.append((start, size, sequence, offset))
                    start, left, at = start + size, left - size, at + size
                pieces += [(r["doc_id"], s, n, ids[s:s + n].tobytes(), r["doc_tokens"], q, o) for s, n, q, o in parts]
            columns = list(zip(*pieces)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3)],
                                             names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return tokens.join(plan.hint("merge"), "row").mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
