"""A Bloom filter of keys as a small table, to pick rows before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits: 4 MB with their numbers, however many keys there are. Where there are more than it can tell
# apart, more rows pass.
WORDS = 1 << 18
#: Most words of a filter that is told to all tasks, 16 MB.
MOST_WORDS = 1 << 20


def words_for(keys: int) -> int:
    """Words for that many keys, 16 bits each, as a power of two."""
    return min(max(1 << 10, 1 << (keys // 4).bit_length()), MOST_WORDS)


def _word_and_bits(key: str, words: int) -> tuple[Column, Column]:
    """Place of a key in the filter, and its four bits there."""
    h = f"xxhash64({key})"
    bits = " | ".join(f"shiftleft(1L, int(shiftright({h}, {6 * k}) & 63))" for k in range(4))
    return F.expr(f"int(pmod(shiftright({h}, 24), {words}))"), F.expr(bits)


def bloom_words(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """(word, held): one row for each word in use, ``words`` at most. A NULL key is a key."""
    word, bits = _word_and_bits(key, words)
    return keys.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("held"))


def may_be_among(df: DataFrame, key: str, filter_words: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows whose key passes the filter: all of its keys, and some others. ``df`` is not shuffled."""
    return _compared(df, key, filter_words, words, "left_semi")


def surely_not_among(df: DataFrame, key: str, filter_words: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows that ``may_be_among`` leaves out, none of which has a key of the filter. ``df`` is not shuffled."""
    return _compared(df, key, filter_words, words, "left_anti")


def _compared(df: DataFrame, key: str, filter_words: DataFrame, words: int, how: str) -> DataFrame:
    word, bits = _word_and_bits(key, words)
    return df.join(F.broadcast(filter_words), (word == F.col("word")) & (F.col("held").bitwiseAND(bits) == bits), how)
