"""A Bloom filter over keys, as a table.

The filter is a table of 64-bit words. A key belongs to one word and sets a few bits of it, so
testing a key is a single look-up: a broadcast join on the word's number. The table is built by
a grouped bit_or that Spark combines before its shuffle; its size is bounded, whatever the
number of keys. A full filter lets more through, it never loses a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from staymart.scratch import stage

BITS_PER_KEY = 3  # set in a word
KEYS_PER_WORD = 4  # so that about one key in a hundred passes by chance
MOST_WORDS = 1 << 20  # 16 MB of words and numbers


def words_for(keys: int) -> int:
    """How many words a filter of so many keys has: a power of two."""
    return min(MOST_WORDS, 1 << max(0, -(-keys // KEYS_PER_WORD) - 1).bit_length())


def word_of(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words)).cast("int")


def bits_of(key: Column) -> Column:
    spread = F.xxhash64(key, F.lit(2))
    one = F.lit(1).cast("long")
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_PER_KEY)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def key_filter(keys: DataFrame, key: str, folder: str, count: int | None = None) -> tuple[DataFrame, int]:
    """``(word, bits)`` rows, written, and the number of words. NULL keys are left out."""
    keys = keys.where(F.col(key).isNotNull())
    words = words_for(keys.count() if count is None else count)
    rows = keys.groupBy(word_of(F.col(key), words).alias("word")).agg(F.bit_or(bits_of(F.col(key))).alias("bits"))
    return stage(rows, folder, "filter"), words


def with_test(rows: DataFrame, key: str, built: tuple[DataFrame, int], name: str) -> DataFrame:
    """``rows`` with a boolean: may the key be one of the filter's? Never false for one of them,
    false for NULL. No row is shuffled."""
    table, words = built
    table = F.broadcast(table.toDF("__word", "__bits"))
    tested = rows.join(table, word_of(F.col(key), words) == F.col("__word"), "left")
    wanted = bits_of(F.col(key))
    hit = F.coalesce(F.col("__bits").bitwiseAND(wanted) == wanted, F.lit(False)) & F.col(key).isNotNull()
    return tested.select(*rows.columns, hit.alias(name))


def passing(rows: DataFrame, key: str, built: tuple[DataFrame, int], hit: bool = True) -> DataFrame:
    """The rows whose key passes the filter, or, without ``hit``, all others."""
    test = with_test(rows, key, built, "__hit")
    return test.where(F.col("__hit") if hit else ~F.col("__hit")).drop("__hit")
