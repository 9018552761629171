"""A Bloom filter of fixed size, built by one aggregate and read as a scalar subquery.

A value sets up to four bits of one 64-bit word (a blocked filter: one lookup per
test).  Words are or-ed with partial sums per task, at most one row per word, so
the filter has the same size whatever the number of values.  It has no false
negatives: a value of the set is always reported as perhaps contained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: words of 64 bits: 256 KB, about one false positive in sixty for 200,000 values
WORDS = 1 << 15
#: bits that a value sets, each named by six bits of its hash
BITS = 4


def _word_and_mask(value: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(value)
    mask = None
    for i in range(BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS), F.lit(words)).cast("int"), mask


def bloom_filter(values: DataFrame, value: Column, words: int = WORDS) -> Column:
    """The filter of a column's values: an array of ``words`` longs, as a scalar subquery."""
    word, mask = _word_and_mask(value, words)
    every_word = values.sparkSession.range(words).select(F.col("id").cast("int").alias("word"),
                                                         F.lit(0).cast("bigint").alias("bits"))
    merged = (values.select(word.alias("word"), mask.alias("bits")).unionByName(every_word)
              .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    # one row of `words` longs: a constant, not the data
    rows = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return merged.agg(rows["bits"].alias("filter")).scalar()


def perhaps_contains(bloom: Column, value: Column, words: int = WORDS) -> Column:
    """False only if the value is surely not in the filter's set."""
    word, mask = _word_and_mask(value, words)
    return F.get(bloom, word).bitwiseAND(mask) == mask
