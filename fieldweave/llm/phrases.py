"""Collocations: phrases that stand together more often than their parts would, by a multikey quicksort of suffixes."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldweave.llm.common import forget, in_parts, stored
from fieldweave.operators.joins import split_join
from fieldweave.sources.sinks import remove_folder, work_folder

#: Words of the longest phrase, occurrences of a candidate, and rows for each language.
LONGEST, LEAST, KEPT = 3, 10, 2000
#: A longer phrase with this share, in percent, of a candidate's occurrences takes its place.
ABSORBED = 50
#: Words that a task counts before it sends them on, and bytes of a text that it looks at at a time.
CHUNK, BLOCK = 2_000_000, 1 << 20
#: Bytes of text for each bucket of phrases, and buckets that texts are dealt to at once.
BUCKET_BYTES, FAN = 8 << 20, 2048
#: Parts in which more buckets than that are stored, to be dealt one part after the other.
PARTS = 16
#: Groups of a language's candidates that are ranked apart before the last ranking.
RANK_GROUPS = 64

# Characters that end a piece of text, and those between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Lower letters, one byte that no UTF-8 text holds for all ends, and one blank.
_FOLDED = bytes.maketrans(bytes(range(65, 91)) + ENDS + BLANKS, bytes(range(97, 123)) + b"\xff" * len(ENDS) + b" " * len(BLANKS))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: A count of one byte that says that the count follows, and bytes of rows that are sent on at a time.
_MANY, _SENT_BYTES = 255, 1 << 20
#: What is before the phrases of a bucket: its number, theirs, and the bytes of their texts; and what is before a row: its bytes.
_HEAD, _SIZE = struct.Struct("<QQQ"), struct.Struct("<Q")
_CODEC = pa.Codec("zstd", compression_level=1)


def _blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, block by block; ``b"\\xff"`` ends a piece."""
    raw = text.encode().translate(_FOLDED)
    at = 0
    while at < len(raw):
        end = at + BLOCK
        if end < len(raw):
            end = raw.rfind(b" ", at, end) + 1 or raw.find(b" ", end) + 1 or len(raw)
        yield raw[at:end].replace(b"\xff", b" \xff ").split()
        at = end


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Words:
    """Words of one language in reading order, by number; -1 ends a piece."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        end = self.numbers.get(b"\xff")
        if end is not None:
            numbers[numbers == end] = -1
        self.parts.append(numbers)
        self.size += len(numbers)

    def close(self) -> None:
        self.parts.append(np.array([-1]))
        self.size += 1

    def counts(self, longest: int, whole: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers of the words of each distinct phrase, -1 behind its end; how often it begins here; all words.

        If the text goes on, its last words begin nothing yet and stay.
        """
        codes = np.concatenate([*self.parts, np.full(longest, -1)])
        upto = self.size if whole else max(0, self.size - longest + 1)
        place, base = np.flatnonzero(codes[:upto] >= 0), len(self.numbers)
        own = codes[place]
        times = np.bincount(own, minlength=base)
        known = np.full((base, longest), -1, np.int32)
        known[:, 0] = np.arange(base)
        rows, sizes, total = [known[times > 0]], [times[times > 0]], len(own)
        for m in range(2, longest + 1):
            # A phrase of m words is one of m - 1 words and the word behind it.
            last = codes[place + m - 1]
            keep = last >= 0
            place, key = place[keep], own[keep] * base + last[keep]
            if m < longest:
                found, own, times = np.unique(key, return_inverse=True, return_counts=True)
            else:
                found, times = np.unique(key, return_counts=True)
            table = known[found // base]
            table[:, m - 1] = found % base
            rows.append(table)
            sizes.append(times)
            known = table
        self.parts, self.size = ([], 0) if whole else ([codes[upto:self.size]], self.size - upto)
        return np.concatenate(rows), np.concatenate(sizes), total


def _digests(words: pa.Array, language: str, table: np.ndarray) -> np.ndarray:
    """A hash of each phrase and its language."""
    own = np.array([*map(xxhash.xxh3_64_intdigest, words.to_pylist()), 0], np.uint64)
    found = np.full(len(table), xxhash.xxh3_64_intdigest(language.encode()), np.uint64)
    for column in table.T:
        found = np.where(column < 0, found, (found ^ own[column]) * _MIX)
        found ^= found >> np.uint64(29)
    return found


def _joined(words: pa.Array, table: np.ndarray) -> pa.Array:
    """The phrases as texts, their words joined by blanks; a line end closes each."""
    either = pa.concat_arrays([pc.binary_join_element_wise(words, "", mark) for mark in (" ", "\n")])
    parts, last = [], np.full(len(table), True)
    for column in table.T[::-1]:
        parts.append(either.take(pa.array(column + len(words) * last, mask=column < 0)))
        last = column < 0
    return pc.binary_join_element_wise(*parts[::-1], "", null_handling="skip")


SENT = "bucket long, lang string, phrases binary"


def _rows(language: str, found: Iterator[tuple[int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """The pieces of each bucket as one compressed row, some rows at a time."""
    keys, rows, size = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([language] * len(keys), pa.string()), pa.array(rows, pa.binary())],
            names=["bucket", "lang", "phrases"])

    for bucket, pieces in found:
        plain = b"".join(pieces)
        keys.append(bucket)
        rows.append(_SIZE.pack(len(plain)) + _CODEC.compress(plain, asbytes=True))
        size += len(rows[-1])
        if size >= _SENT_BYTES:
            yield batch()
            keys, rows, size = [], [], 0
    if rows:
        yield batch()


def _sent(words: pa.Array, language: str, table: np.ndarray, times: np.ndarray, buckets: int, share: int) -> Iterator[pa.RecordBatch]:
    """The phrases, dealt to buckets by all their words; those of ``share`` neighbouring buckets are one row.

    Each bucket in a row has a head, a byte for each count, large counts, and texts.
    """
    bucket = (_digests(words, language, table) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    texts = _joined(words, table[order])
    bucket, times = bucket[order], times[order]
    limits = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    own = bucket[limits[:-1]].tolist()
    many = times >= _MANY
    small, large = (memoryview(a.tobytes()) for a in (np.minimum(times, _MANY).astype(np.uint8), times[many].astype("<i8")))
    data, at = memoryview(texts.buffers()[2]), np.frombuffer(texts.buffers()[1], np.int32)[limits].tolist()
    large_at, limits = (8 * np.r_[0, np.cumsum(many)][limits]).tolist(), limits.tolist()

    def found() -> Iterator[tuple[int, list[bytes]]]:
        pieces = []
        for n, number in enumerate(own):
            start, end = limits[n], limits[n + 1]
            pieces += [_HEAD.pack(number, end - start, at[n + 1] - at[n]), small[start:end],
                       large[large_at[n]:large_at[n + 1]], data[at[n]:at[n + 1]]]
            if n + 1 == len(own) or own[n + 1] // share != number // share:
                yield number // share, pieces
                pieces = []

    return _rows(language, found())


def _counted(longest: int, buckets: int, share: int):
    """Phrases of whole texts, counted by each task before they are sent. Bucket -1 takes the number of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, _Words] = {}

        def sent(language: str, whole: bool) -> Iterator[pa.RecordBatch]:
            own = open_[language]
            words = pa.array(list(own.numbers), pa.binary())
            table, times, total = own.counts(longest, whole)
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1]), pa.array([language]), pa.array([total.to_bytes(8, "little")])], names=["bucket", "lang", "phrases"])
                # The mark of ends is among the words, but never in a phrase.
                marked = pc.if_else(pc.equal(words, b"\xff"), pa.scalar(b""), words).cast(pa.string())
                yield from _sent(marked, language, table, times, buckets, share)
            if not whole:
                # Only the words that stay keep their numbers.
                left, names = own.parts[0], list(own.numbers)
                own.numbers = _Numbers()
                own.parts = [np.array([-1 if n < 0 else own.numbers[names[n]] for n in left], np.int64)]

        for batch in in_parts(batches, 200):
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = open_.setdefault(language, _Words())
                for words in _blocks(text.as_py() or ""):
                    own.add(words)
                    if sum(w.size for w in open_.values()) >= CHUNK:
                        for other in [name for name in open_ if name != language]:
                            yield from sent(other, True)
                            del open_[other]
                        yield from sent(language, False)
                own.close()
        for language in open_:
            yield from sent(language, True)

    return run


def _plain(row: bytes) -> memoryview:
    return memoryview(_CODEC.decompress(memoryview(row)[_SIZE.size:], *_SIZE.unpack_from(row), asbytes=True))


def _pieces(plain: memoryview) -> Iterator[tuple[int, memoryview, np.ndarray, memoryview]]:
    """Of each bucket in a row: its number, all of it, its counts, and its texts."""
    at = 0
    while at < len(plain):
        bucket, n, size = _HEAD.unpack_from(plain, at)
        begin = at + _HEAD.size
        times = np.frombuffer(plain, np.uint8, n, begin)
        begin += n + 8 * np.count_nonzero(times == _MANY)
        yield bucket, plain[at:begin + size], times, plain[begin:begin + size]
        at = begin + size


def _read(rows: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Texts and counts of the phrases of rows that ``_sent`` made."""
    texts, counts = [], []
    for row in rows:
        for _, piece, small, text in _pieces(_plain(row)):
            times = small.astype(np.int64)
            large = np.flatnonzero(small == _MANY)
            times[large] = np.frombuffer(piece, "<i8", len(large), _HEAD.size + len(small))
            counts.append(times)
            texts.append(text)
    return b"".join(texts), np.concatenate(counts)


def _cut(texts: bytes, ends: np.ndarray) -> pa.Array:
    """The texts up to each of ``ends``, with the mark there."""
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.r_[0, ends + 1]), pa.py_buffer(texts))


def _numbered(texts: bytes, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the words of each phrase, -1 behind its end, and where each phrase's line end stands."""
    raw = np.frombuffer(texts, np.uint8)
    marks = np.flatnonzero((raw == ord(" ")) | (raw == ord("\n")))
    lasts = np.flatnonzero(raw[marks] == ord("\n"))
    numbers = _cut(texts.replace(b"\n", b" "), marks).dictionary_encode().indices.to_numpy()
    sizes = np.diff(lasts, prepend=-1)
    table = np.full((len(lasts), longest), -1, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    table[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers
    return table, marks[lasts]


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, list[bytes]]]:
    """``bucket, language, rows``, where rows come sorted by bucket and language."""
    key, rows = None, []
    for batch in batches:
        for bucket, language, row in zip(*(batch.column(n) for n in range(3))):
            own = bucket.as_py(), language.as_py()
            if own != key and rows:
                yield *key, rows
                rows = []
            key = own
            rows.append(row.as_py())
    if rows:
        yield *key, rows


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that hold several buckets, put together some at a time, as rows of one bucket each."""
    def found(rows: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
        own: dict[int, list[bytes]] = {}
        for row in rows:
            for bucket, piece, _, _ in _pieces(_plain(row)):
                own.setdefault(bucket, []).append(piece)
        yield from own.items()

    for bucket, language, rows in _by_bucket(batches):
        if bucket < 0:
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(rows)), pa.array([language] * len(rows)), pa.array(rows)],
                                             names=["bucket", "lang", "phrases"])
            continue
        some, size = [], 0
        for n, row in enumerate(rows, 1):
            some.append(row)
            size += len(row)
            if size >= BUCKET_BYTES or n == len(rows):
                yield from _rows(language, found(some))
                some, size = [], 0


def equal_partitions(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of each group of equal rows of ``keys``, and the group's weight, for groups of at least that weight.

    Multikey three-way quicksort of pointers, all partitions of a round at once: each is parted by one of its own keys
    into lower, equal and higher ones. Equal ones point to the next key of their rows; where that was the end of the rows
    (-1), the size of the partition is the count. A partition of less weight than ``least`` is abandoned.
    """
    rng, width = np.random.default_rng(0), keys.shape[1] + 1
    kind = np.int32 if keys.size + len(keys) < 2 ** 31 else np.int64
    flat = np.full((len(keys), width), -1, kind)
    flat[:, :-1] = keys
    flat = flat.ravel()
    pointers, sizes = np.arange(len(keys), dtype=kind) * kind(width), np.array([len(keys)])
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(pointers):
        starts = np.cumsum(sizes) - sizes
        own = flat[pointers]
        pivot = own[starts + (rng.random(len(starts)) * sizes).astype(np.int64)]
        mine = np.repeat(pivot, sizes)
        low, same = own < mine, own == mine
        n_low, n_same = np.cumsum(low, dtype=kind), np.cumsum(same, dtype=kind)
        before_low, before_same = n_low[starts] - low[starts], n_same[starts] - same[starts]
        lows, sames = n_low[starts + sizes - 1] - before_low, n_same[starts + sizes - 1] - before_same
        # Where a pointer goes: behind the lower sides of its partition, in the order of its own side.
        moved, weighed = np.empty_like(pointers), np.empty_like(weights)
        place = np.where(low, n_low + np.repeat((starts - 1 - before_low).astype(kind), sizes),
                         n_same + np.repeat((starts + lows - 1 - before_same).astype(kind), sizes))
        high = np.flatnonzero(~(low | same))
        place[high] = high + (np.repeat((lows + sames + before_low + before_same).astype(kind), sizes) - n_low - n_same)[high]
        moved[place], weighed[place] = pointers, weights
        parts = np.column_stack([lows, sames, sizes - lows - sames]).ravel()
        used = np.flatnonzero(parts)
        parts, equal, parent = parts[used], used % 3 == 1, used // 3
        ends = np.cumsum(parts)
        begins = ends - parts
        weight = np.diff(np.cumsum(weighed)[ends - 1], prepend=0)
        enough, done = weight >= least, equal & (pivot[parent] < 0)
        rows.append(moved[begins[done & enough]] // width)
        found.append(weight[done & enough])
        alive = enough & ~done
        kept = np.repeat(alive, parts)
        # Equal ones go on at the next key.
        pointers = (moved + np.repeat(equal, parts))[kept].astype(kind, copy=False)
        weights, sizes = weighed[kept], parts[alive]
    return np.concatenate(rows), np.concatenate(found)


def _frequent(longest: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, language, rows in _by_bucket(batches):
            if bucket < 0:
                phrases, times = pa.nulls(1, pa.string()), np.array([sum(int.from_bytes(r, "little") for r in rows)])
            else:
                texts, weights = _read(rows)
                table, ends = _numbered(texts, longest)
                chosen, times = equal_partitions(table, weights, least)
                phrases = pc.ascii_rtrim(_cut(texts, ends).take(pa.array(chosen)), "\n").cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(times), pa.string()), phrases, pa.array(times)], names=["lang", "phrase", "n"])

    return run


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES, fan: int = FAN,
) -> DataFrame:
    """``lang, phrase, n`` of the phrases of one to ``longest`` words with ``least`` occurrences, and of all words (phrase NULL).

    Each task counts the phrases that begin at each of its words and deals them, by all their words, to buckets of about
    ``bucket_bytes`` of text. So a phrase is at most one row for each task there, however often it occurs, and no word or
    language makes a bucket larger than others. Of more than ``fan`` buckets several stand together at first. Then their
    rows are stored in parts, and each part is dealt to its buckets, counted and deleted before the next one, so that the
    disk holds the phrases once and one part of them again, whatever the size of the text. The result is a stored table.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    share = math.ceil(buckets / fan)
    together = math.ceil(buckets / share)
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.mapInArrow(_counted(longest, buckets, share), SENT)

    def counted(dealt: DataFrame, tasks: int) -> DataFrame:
        routed = dealt.repartition(tasks, "bucket", "lang").sortWithinPartitions("bucket", "lang")
        return routed.mapInArrow(_frequent(longest, least), "lang string, phrase string, n long")

    if share == 1:
        return stored(counted(sent, max(partitions, buckets)))
    each = math.ceil(together / PARTS)
    part = F.floor(F.greatest(F.col("bucket"), F.lit(0)) / each).cast("int")
    kept = stored(sent.withColumn("part", part).sortWithinPartitions("part", "bucket", "lang"), by="part")
    folder = work_folder(spark)
    parts = math.ceil(together / each)
    for n in range(parts):
        own = kept.filter(F.col("part") == n).select("bucket", "lang", "phrases").mapInArrow(_dealt, SENT)
        counts = stored(counted(own, max(math.ceil(partitions / parts), each * share)), folder)
        remove_folder(spark, f"{kept.stored_in}/part={n}")
    forget(kept)
    return counts


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, kept: int = KEPT, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Each language's first ``kept`` phrases of two to ``longest`` words: ``lang, rank, phrase, a, l, r, n, score``.

    ASCII letters are lowered, texts end at marks and line ends into pieces, and words are what stands between blanks.
    ``a`` is the number of places where the phrase stands within a piece, ``n`` all words of its language. Cut in two it
    scores ``1000000 * a * a / (l * r)``, rounded down, by the counts of its parts; the cut with the lowest score counts, the
    first of equal ones. A phrase that a longer candidate holds half of the time is left out. Ties go by ``a``, then by the
    bytes of the phrase. Products are decimals of 38 digits.

    A NULL text counts as empty, a NULL language as ``und``. Empty texts and no rows give no rows; repeated rows count each
    time; other columns are not read.
    """
    counts = phrase_counts(docs, longest, least, lang_col, text_col)
    phrases = counts.filter("phrase is not null")
    words = F.split("phrase", " ")
    every = phrases.withColumn("words", words).filter(F.size("words") > 1).withColumnRenamed("n", "a")
    part = lambda begin, length: F.array_join(F.slice("words", begin, length), " ")
    cuts = every.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        own = phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = split_join(cuts, own, ["lang", side], "inner")
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    upper = F.lit(1000000).cast("decimal(7,0)") * wide("a") * wide("a")
    scored = cuts.withColumns({"_upper": upper.cast("decimal(38,0)"), "_lower": (wide("l") * wide("r")).cast("decimal(38,0)")})
    scored = scored.withColumn("score", F.expr("_upper div _lower"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    longer = every.filter(F.size("words") > 2).select("lang", "a", F.explode(inner).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * ABSORBED)
    left = split_join(best, longer, ["lang", "phrase"], "left").filter(free).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    first = left.withColumn("_group", group).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order)))
    first = first.filter(F.col("_place") <= kept)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= kept)
    totals = counts.filter("phrase is null").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
