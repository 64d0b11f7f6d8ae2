"""Passages that documents share, found in a compacted de Bruijn graph of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldweave.llm.common import in_parts, stored
from fieldweave.llm.hashing import U64, window_hashes, word_hashes

#: Words of an edge; its nodes are its first and its last ``WINDOW - 1`` words.
WINDOW = 13
#: Words of an anchor. Of the anchors in a window the one with the smallest hash stands for it.
ANCHOR = 6
#: The id that stands for NULL: no document comes later.
LAST = 2**63 - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def anchors(hashes: np.ndarray) -> np.ndarray:
    """The anchor of each window: equal windows have equal anchors."""
    parts = window_hashes(hashes, ANCHOR)
    count = len(hashes) - WINDOW + 1
    if count < 1:
        return np.empty(0, U64)
    least = parts[:count].copy()
    for n in range(1, WINDOW - ANCHOR + 1):
        np.minimum(least, parts[n:n + count], out=least)
    return least


def _lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(x) for x in arrays])].astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(offsets, flat.astype(kind, copy=False))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        sizes, whole, digests, found = [], [], [], []
        for text in batch.column(2).to_pylist():
            words = words_of(text)
            sizes.append(len(words))
            joined = b" ".join(words)
            whole.append(xxhash.xxh3_128_digest(joined) if len(words) >= WINDOW else None)
            digests.append(hashlib.sha256(joined).hexdigest())
            found.append(np.unique(anchors(word_hashes(joined))).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(whole, pa.binary()), pa.array(digests, pa.string()),
             _lists(found, np.int64)], names=["did", "text_key", "n_words", "whole", "sha", "anchors"])


def _windows(bits: int):
    """Windows whose anchor is shared: place and edge, a hash of ``bits`` bits."""
    mask = U64(2**bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            places, edges = [], []
            for text, known in zip(batch.column(2).to_pylist(), batch.column(3)):
                hashes = word_hashes(text.encode("utf-8", "surrogatepass"))
                at = np.flatnonzero(np.isin(anchors(hashes), known.values.to_numpy().view(U64)))
                places.append(at)
                edges.append((window_hashes(hashes, WINDOW)[at] & mask).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(places, np.int32), _lists(edges, np.int64)], names=["row", "did", "places", "edges"])

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows of a row that lie on one path, place after place. Rows come sorted by row and place."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in range(5)])
        if held is not None:
            table = np.concatenate([held, table], axis=1)
        row, place, first, source, path = table
        new = np.ones(len(row), bool)
        new[1:] = ~((row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1) & (first[1:] == first[:-1])
                    & (source[1:] == source[:-1] + 1) & (path[1:] == path[:-1]))
        starts = np.flatnonzero(new)
        # The last run may go on in the next batch.
        held = table[:, starts[-1]:]
        yield _runs(table[:, :starts[-1]], starts[:-1])
    if held is not None:
        yield _runs(held, np.array([0]))


def _runs(table: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    row, place, first, source, _ = table
    sizes = np.diff(np.r_[starts, table.shape[1]])
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int64)) for x in (row[starts], place[starts], first[starts], source[starts], sizes + WINDOW - 1)],
        names=["row", "start", "first", "source", "words"])


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        rows = []
        for did, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = words_of(text)
            rows += [(did, w["source"], w["words"], _digest(words[w["source"]:w["source"] + w["words"]])) for w in wanted]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                                         names=["first", "source", "words", "digest"])


SPANS = "array<struct<start:long,words:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of ``wanted`` runs whose digest they have; ``failed`` are the runs that have another one."""
    for batch in in_parts(batches):
        removed, digests, spans, failed = [], [], [], []
        for text, wanted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = words_of(text)
            gone = np.zeros(len(words), bool)
            held = set()
            for w in wanted:
                start, size = w["start"], w["words"]
                if (start, size) not in held and _digest(words[start:start + size]) == w["digest"]:
                    held.add((start, size))
                    gone[start:start + size] = True
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(b" ".join(w for w, out in zip(words, gone) if not out)).hexdigest())
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
            spans.append([{"start": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2])])
            others = {(w["start"], w["words"]) for w in wanted} - held
            failed.append([{"start": start, "words": size} for start, size in sorted(others)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, _SPANS), pa.array(failed, _SPANS)],
            names=["row", "n_removed", "kept_sha256", "spans", "failed"])


def _without(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``row, n_removed, kept_sha256, spans, failed`` for the rows that ``wanted (row, start, words, digest)`` names."""
    runs = wanted.groupBy("row").agg(F.collect_list(F.struct("start", "words", "digest")).alias("wanted"))
    return stored(texts.select("row", "text").join(runs.hint("merge"), "row").select("row", "text", "wanted").mapInArrow(
        _kept, f"row long, n_removed long, kept_sha256 string, spans {SPANS}, failed {SPANS}").dropDuplicates(["row"]))


def _named_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row, document, place and digest of the windows at some places of each text."""
    for batch in in_parts(batches, 50):
        rows = []
        for row, did, text, places in zip(*(batch.column(n).to_pylist() for n in range(4))):
            words = words_of(text)
            rows += [(row, did, place, _digest(words[place:place + WINDOW])) for place in places]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                                         names=["row", "did", "start", "digest"])


def _by_digest(failed: DataFrame, at: DataFrame, texts: DataFrame) -> DataFrame:
    """``row, start, words, digest``: the repeated windows among all whose edge lies in a run of ``failed``.

    Such an edge may stand for different words, so that its first place says nothing. Digests of the words tell them
    apart, and each has a first document of its own.
    """
    last = F.col("run.start") + F.col("run.words") - WINDOW
    places = failed.select("row", F.explode("failed").alias("run")).select(
        "row", F.explode(F.sequence(F.col("run.start").cast("int"), last.cast("int"))).alias("place")).distinct()
    doubted = stored(at.join(places.hint("merge"), ["row", "place"]).select("edge").distinct())
    again = at.join(doubted.hint("merge"), "edge").groupBy("row").agg(F.collect_set("place").alias("places"))
    named = stored(texts.select("row", "did", "text").join(again.hint("merge"), "row").select("row", "did", "text", "places").mapInArrow(
        _named_windows, "row long, did long, start long, digest binary"))
    least = named.groupBy("digest").agg(F.min("did").alias("first"), F.max("did").alias("last")).filter("first < last").drop("last")
    return named.join(least.hint("merge"), "digest").filter("did > first").select("row", "start", F.lit(WINDOW).cast("long").alias("words"), "digest")


def paths(edges: DataFrame) -> DataFrame:
    """``edge, first, source, path`` from ``edge, first, source, least, most``: each edge with the start of its path.

    ``first`` and ``source`` are document and place of an edge's first occurrence; ``least`` and ``most`` are the smallest
    and the largest edge that follows its occurrences, 0 if none does. A path goes on from an edge to the next place of the same document
    if that edge is the only one to follow, and follows no other edge; a join counts what an edge
    follows. Documents are far apart in the order, so no window spans more than the edges of one.
    """
    entered = edges.filter("least = most and least != 0").groupBy(F.col("least").alias("edge")).agg(F.count(F.lit(1)).alias("entries"))
    named = edges.join(entered, "edge", "left")
    order = Window.partitionBy("first").orderBy("source")
    goes_on = (
        (F.col("source") == F.lag("source").over(order) + 1) & (F.lag("least").over(order) == F.col("edge"))
        & (F.lag("most").over(order) == F.col("edge")) & (F.coalesce("entries", F.lit(0)) <= 1))
    begun = named.withColumn("begin", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("source")))
    return begun.select("edge", "first", "source", F.max("begin").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("path"))


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edge_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256, spans``.

    Words go that a window of ``WINDOW`` words covers whose words also start in a document with a smaller id; ``spans``
    are the stretches of them. Windows are edges of a de Bruijn graph. Only windows that can be repeated are made into
    edges: an anchor of ``ANCHOR`` words stands for each window, and one that only one document has repeats nothing.
    Repeated edges keep the place of their first occurrence, paths of them without branches are compacted, and runs of
    windows along a path become spans with the place in the first document that they repeat. Words at both places
    are compared, by digests of 16 bytes, before anything is removed. Where they differ, as different windows have one hash
    of ``edge_bits`` bits, all windows with the hashes of such a run are named by digests instead and looked up once more.

    Of equal texts only the first goes through this; all words of the others go if they have ``WINDOW``. A document with
    a NULL id comes after all others, and such documents do not remove each other's words; nor do rows that repeat an id.
    NULL and empty texts have no words. No rows give no rows; other columns are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("did"),
        F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    described = stored(
        texts.select("did", "text_key", "text").mapInArrow(
            _described, "did long, text_key long, n_words long, whole binary, sha string, anchors array<long>")
        .withColumn("row", F.monotonically_increasing_id()))
    copies = stored(described.filter("whole is not null").groupBy("whole").agg(
        F.min("did").alias("first"), F.coalesce(F.min_by("row", "did"), F.min("row")).alias("node"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    rows = stored(described.select("row", "did", "n_words", "whole", "sha").join(copies.hint("merge"), "whole", "left").select(
        "row", "did", "n_words", "sha", F.coalesce("node", "row").alias("node"), F.coalesce(F.col("did") > F.col("first"), F.lit(False)).alias("copy")))
    others = rows.filter("row != node").select("row")
    single = described.filter("whole is not null").join(others.hint("merge"), "row", "left_anti")
    found = single.select(F.explode("anchors").alias("anchor"), "row")
    shared = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    wanted = stored(found.join(shared.hint("merge"), "anchor").groupBy("row").agg(F.collect_list("anchor").alias("anchors")))
    wanted = described.select("row", "did", "text_key").join(wanted.hint("merge"), "row")
    likely = stored(texts.select("did", "text_key", "text").join(wanted.hint("merge"), ["did", "text_key"]).select("row", "did", "text", "anchors"))

    windows = stored(likely.mapInArrow(_windows(edge_bits), "row long, did long, places array<int>, edges array<long>"))
    at = windows.select("row", "did", F.explode(F.arrays_zip("places", "edges")).alias("w")).select(
        "row", "did", F.col("w.places").alias("place"), F.col("w.edges").alias("edge"))
    later = [F.slice(c, F.lit(2), F.size(c)).alias(name) for c, name in (("places", "next_place"), ("edges", "next_edge"))]
    chained = windows.select("did", F.explode(F.arrays_zip("places", "edges", *later)).alias("w")).select(
        "did", F.col("w.places").alias("place"), F.col("w.edges").alias("edge"),
        F.when(F.col("w.next_place") == F.col("w.places") + 1, F.col("w.next_edge")).otherwise(F.lit(0)).alias("following"))
    # Document and place as one number, so that the smallest is found without sorting.
    shift = F.lit(2**32).cast("decimal(10,0)")
    code = F.col("did").cast("decimal(19,0)") * shift + F.col("place").cast("decimal(10,0)")
    edges = chained.groupBy("edge").agg(
        F.min(code).alias("code"), F.max("did").alias("last"), F.min("following").alias("least"), F.max("following").alias("most"))
    first = F.floor(F.col("code") / shift).cast("long")
    edges = edges.withColumn("first", first).filter(F.col("first") < F.col("last"))
    edges = edges.withColumn("source", (F.col("code") - F.col("first").cast("decimal(19,0)") * shift).cast("long"))
    placed = stored(paths(stored(edges.select("edge", "first", "source", "least", "most"))))

    hits = at.join(placed.hint("merge"), "edge").filter("did > first").select(
        "row", F.col("place").cast("long").alias("place"), "first", "source", "path")
    spans = stored(hits.repartition("row").sortWithinPartitions("row", "place").mapInArrow(
        _spans, "row long, start long, first long, source long, words long"))
    sources = spans.select("first", "source", "words").distinct().groupBy("first").agg(F.collect_list(F.struct("source", "words")).alias("wanted"))
    digests = stored(likely.select(F.col("did").alias("first"), "text").join(sources.hint("merge"), "first").select("first", "text", "wanted").mapInArrow(
        _source_digests, "first long, source long, words long, digest binary").distinct())
    checked = spans.join(digests.hint("merge"), ["first", "source", "words"]).select("row", "start", "words", "digest")
    cut = _without(likely, checked)
    failed = cut.filter(F.size("failed") > 0)
    if not failed.isEmpty():
        more = stored(_by_digest(failed.select("row", "failed"), at, likely))
        touched = stored(more.select("row").distinct())
        again = _without(likely, checked.join(touched.hint("merge"), "row", "left_semi").unionByName(more))
        cut = cut.join(touched.hint("merge"), "row", "left_anti").unionByName(again)
    cut = cut.drop("failed")
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("words")))
    none = F.array().cast("array<struct<start:long,words:long>>")
    return rows.join(cut.withColumnRenamed("row", "node"), "node", "left").select(
        F.when(F.col("did") != LAST, F.col("did")).alias("doc_id"), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(F.col("copy"), every).otherwise(F.coalesce("spans", none)).alias("spans"))
