"""Semi-join reduction by a Bloom filter of words: a 64-bit word per key hash, a few bits set in it.

The filter is a table (word number, bits), built by one grouped OR and joined by
broadcast. Its size follows the number of keys and is bounded; where keys are
too many for the bound, no filter is used and every row passes. A filter only
ever lets too much pass, so a join has to follow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

BITS_PER_KEY = 16
BITS_SET = 4
# 2^21 rows of two numbers: about 50 MB once broadcast.
MOST_WORDS = 1 << 21
# Up to this number of keys a filter of that size still drops most other rows; it has 4 bits a key then.
MOST_KEYS = 1 << 25


def _word(code: Column, words: int) -> Column:
    return F.pmod(code, F.lit(words)).cast("int")


def _mask(code: Column) -> Column:
    """The bits of a key in its word; they hang on other bits of the hash than the word's number."""
    other = F.xxhash64(code)
    places = [F.shiftright(other, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_SET)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def words_for(n: int) -> int | None:
    """Words of a filter for ``n`` keys, None where it would be too large."""
    words = max(1, -(-n * BITS_PER_KEY // 64))
    return words if words <= MOST_WORDS else None


def _size(n: int) -> int | None:
    """Words of the filter that is used: the largest one also for more keys than it is made for."""
    return words_for(min(n, 4 * MOST_WORDS)) if n <= MOST_KEYS else None


def bloom_filter(members: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(word, bits) of the keys of ``members``."""
    code = F.xxhash64(*keys)
    return members.select(_word(code, words).alias("word"), _mask(code).alias("mask")).groupBy("word").agg(
        F.bit_or("mask").alias("bits")
    )


def might_be_member(df: DataFrame, members: DataFrame, keys: Sequence[str], count: int | None = None) -> DataFrame:
    """Rows whose keys may be among those of ``members``; all rows where a filter would be too large.

    ``members`` should be a stored table with few repeated keys; it is read once
    for its count, if that is not given, and once for the filter.
    """
    words = _size(members.count() if count is None else count)
    if words is None:
        return df
    keys = list(keys)
    held = F.broadcast(bloom_filter(members, keys, words))
    code = F.xxhash64(*keys)
    joined = df.join(held, _word(code, words) == F.col("word"))
    return joined.where(F.col("bits").bitwiseAND(_mask(code)) == _mask(code)).select(*df.columns)


def split_members(df: DataFrame, members: DataFrame, keys: Sequence[str], count: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys may be among the ``count`` keys of ``members``, all other rows).

    All rows of a key are on one side. Where a filter would be too large, the second part is empty.
    The filter is stored once; ``df`` is read for each part.
    """
    words = _size(count)
    if words is None:
        return df, df.limit(0)
    held = F.broadcast(cut_lineage(bloom_filter(members, list(keys), words)))
    code = F.xxhash64(*keys)
    joined = df.join(held, _word(code, words) == F.col("word"), "left")
    hit = F.coalesce(F.col("bits").bitwiseAND(_mask(code)) == _mask(code), F.lit(False))
    return joined.where(hit).select(*df.columns), joined.where(~hit).select(*df.columns)
