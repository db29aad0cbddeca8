"""A Bloom filter of keys, built and tested by built-in functions.

The bits are set by one aggregate with a map-side combine and reach the scan as a scalar subquery: an array of longs that
is evaluated once and held by every task. Its size follows the number of keys, ``BITS_PER_KEY`` each, up to ``MOST_BITS``
(2 MB); beyond that the filter lets more rows pass. It never loses one, and a join decides on what passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_BITS = 1 << 24
PROBES = 4


def _places(key: Column, bits: int) -> Column:
    """The bits of a hashed key."""
    again = F.xxhash64(key)
    return F.array(*[F.pmod(key.bitwiseXOR(F.shiftleft(again, 7 * i)), F.lit(bits)) for i in range(PROBES)])


def filter_bits(keys: int) -> int:
    """Bits for a number of keys: a power of two."""
    wanted = max(64, min(MOST_BITS, BITS_PER_KEY * keys))
    return 1 << (wanted - 1).bit_length()


def key_filter(hashes: DataFrame, keys: int) -> Column:
    """The filter of ``hashes`` (one column of longs, about ``keys`` values) as a column: an array of longs."""
    bits = filter_bits(keys)
    place = F.explode(_places(F.col(hashes.columns[0]), bits))
    words = hashes.select(place.alias("p")).select(
        F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 AS int))").alias("mask")
    )
    none = hashes.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = words.unionByName(none).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    # A fixed number of words: at most MOST_BITS / 64.
    whole = words.agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("words"))
    return whole.select(F.transform("words", lambda w: w["mask"])).scalar()


def might_hold(words: Column, keys: int, hashed: Column) -> Column:
    """Whether the filter may hold a hashed key."""
    places = _places(hashed, filter_bits(keys))
    found = F.lit(True)
    for i in range(PROBES):
        word = F.element_at(words, (F.shiftright(places[i], 6) + 1).cast("int"))
        bit = places[i].bitwiseAND(F.lit(63)).cast("int")
        found = found & (F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1)
    return found
