"""Joins of many rows, of which a third may share one key, with a side that has each key once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_HASH = "_key_hash"

# A sieve has a bit for each remainder of a key's hash: 64 to a word, 2^9 words to a row. At most 2^26 bits are 8 MB.
WORD_BITS = 6
ROW_BITS = WORD_BITS + 9
SIEVE_BITS = 26

# Spark sends fewer keys than that to the rows by itself.
SIEVED_FROM = 100_000


class Sieve(NamedTuple):
    """One bit for each remainder of the hash of a key; rows whose bit is not set have none of the keys."""

    rows: DataFrame
    bits: int


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def sieve(keys: DataFrame, key: str, least: int | None = None) -> Sieve | None:
    """The sieve of ``keys``, which are stored; None if they are so few that they need none.

    Its size is bounded, so it may be sent to every task. The more keys there are the more other rows pass it.
    """
    number = keys.count()
    if number < (SIEVED_FROM if least is None else least):
        return None
    bits = min(SIEVE_BITS, max(ROW_BITS, (64 * number).bit_length()))
    place = _place(key, bits)
    one = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`), 64) AS int))")
    word = F.shiftright(place, WORD_BITS)
    empty = keys.sparkSession.range(1 << (bits - WORD_BITS)).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_set"))
    words = keys.filter(F.col(key).isNotNull()).select(word.alias("_word"), one.alias("_set")).unionByName(empty)
    words = words.groupBy("_word").agg(F.bit_or("_set").alias("_set"))
    row = F.shiftright("_word", ROW_BITS - WORD_BITS).alias("_row")
    dense = words.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("_word", "_set"))).alias("_words"))
    return Sieve(dense.select("_row", F.col("_words._set").alias("_words")), bits)


def sifted(rows: DataFrame, by: Sieve, key: str, passed: bool = True) -> DataFrame:
    """The ``rows`` that pass a sieve, among them all that have one of its keys, or those that do not."""
    place = _place(key, by.bits)
    index = F.shiftright(place, WORD_BITS).bitwiseAND(F.lit((1 << (ROW_BITS - WORD_BITS)) - 1)).cast("int")
    bit = F.getbit(F.get("_words", index), F.pmod(F.xxhash64(key), F.lit(64)).cast("int"))
    found = rows.withColumn("_row", F.shiftright(place, ROW_BITS)).join(F.broadcast(by.rows), "_row")
    return found.filter(bit == (1 if passed else 0)).select(*[F.col(f"`{name}`") for name in rows.columns])


def split_join(rows: DataFrame, unique: DataFrame, keys: list[str], how: str, by: Sieve | None = None) -> DataFrame:
    """``rows`` joined with ``unique`` so that tasks can share the rows of a hot key.

    While ``unique`` is small Spark sends it to the rows, which stay in place. Otherwise Spark shuffles both sides and,
    by measured size, splits the partitions that are too large, but only if it has shuffled both sides for this join.
    A side fresh from a GROUP BY on the same keys is not shuffled again, so nothing would be split. With a hash of the
    keys as one more key that side, the smaller one, is shuffled too.

    ``by`` is a sieve of the first key, if there is one. Rows that do not pass it meet nothing and are not shuffled.
    """
    if by:
        near = split_join(sifted(rows, by, keys[0]), unique, keys, how)
        if how in ("inner", "left_semi"):
            return near
        return near.unionByName(sifted(rows, by, keys[0], passed=False), allowMissingColumns=True)
    digest = F.xxhash64(*keys)
    joined = rows.withColumn(KEY_HASH, digest).join(unique.withColumn(KEY_HASH, digest), [*keys, KEY_HASH], how)
    return joined.drop(KEY_HASH)
