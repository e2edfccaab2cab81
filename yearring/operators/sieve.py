"""Rows of a wide table that may match one of many keys, found where they lie.

A join on more keys than a broadcast holds moves both sides.  If few rows match, nearly all of that is in vain: a bitmap of the keys' hash numbers,
at most 64 MB, is broadcast instead, and only rows whose bit is set go on to the exact join.  No match is missed; some rows pass
without one, about one in twelve with 43 million keys, and beyond that more, up to all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each key, and bits at most: 64 MB.
BITS_PER_KEY, MAX_BITS = 16, 1 << 29
# A block is one row of the broadcast, of 32 words of 64 bits.
_WORDS = 32


def _bits(count: int) -> int:
    return min(MAX_BITS, 1 << max(11, (BITS_PER_KEY * count - 1).bit_length()))


def sieve(keys: DataFrame, number: Column, count: int) -> DataFrame:
    """The bitmap of the 64-bit ``number`` of about ``count`` keys, as blocks of words; blocks without a key are left out."""
    slots = keys.select(number.bitwiseAND(F.lit(_bits(count) - 1)).alias("_slot"))
    bit = F.bit_or(F.expr("shiftleft(1L, CAST(_slot & 63 AS INT))")).alias("_bits")
    words = slots.groupBy(F.shiftright("_slot", 6).alias("_word")).agg(bit)
    entry = F.struct(F.col("_word").bitwiseAND(F.lit(_WORDS - 1)).cast("int"), F.col("_bits"))
    blocks = words.groupBy(F.shiftright("_word", 5).alias("_block")).agg(F.map_from_entries(F.collect_list(entry)).alias("_map"))
    places = F.sequence(F.lit(0), F.lit(_WORDS - 1))
    return blocks.select("_block", F.transform(places, lambda i: F.coalesce(F.col("_map")[i], F.lit(0).cast("long"))).alias("_words"))


def marked(rows: DataFrame, number: Column, keys: DataFrame, key_number: Column, count: int, name: str = "_may") -> DataFrame:
    """``rows`` with a flag: whether their number may be one of the keys' numbers."""
    slot = number.bitwiseAND(F.lit(_bits(count) - 1))
    blocks = F.broadcast(sieve(keys, key_number, count))
    joined = rows.join(blocks, F.shiftright(slot, 11) == F.col("_block"), "left")
    word = F.get("_words", F.shiftright(slot, 6).bitwiseAND(F.lit(_WORDS - 1)).cast("int"))
    # The word moved right, so that the wanted bit is the lowest.
    bit = F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(bit == 1, F.lit(False)).alias(name))


def sifted(rows: DataFrame, number: Column, keys: DataFrame, key_number: Column, count: int) -> DataFrame:
    """The rows that may match a key."""
    return marked(rows, number, keys, key_number, count).filter("_may").drop("_may")
