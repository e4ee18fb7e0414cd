"""Bloom filters as DataFrames: rows without a partner are dropped before a join moves them.

A key sets four bits of one 64-bit word. Words are or-ed per word, which map tasks do before the shuffle,
then gathered into segments of 64 words, so that a lookup in the broadcast filter is one hash probe, one
array access and one mask, all inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.session import materialize

BITS_PER_KEY = 16  # some 2 % of the keys that are not in the set pass
SEGMENT = 64  # words of 64 bits
MAX_BYTES = 256 << 20


class Bloom:
    """A filter over the keys ``on`` of a table; ``words`` holds one row per segment.

    ``words`` is None where the filter would take more than ``max_bytes``: it then lets all rows pass.
    """

    def __init__(self, n_keys: int, words: DataFrame | None, n_segments: int):
        self.n_keys, self.words, self.n_segments = n_keys, words, n_segments

    def possible(self, df: DataFrame, on: Sequence[str]) -> DataFrame:
        """Rows of ``df`` whose key may be in the set: all that are, and few others. Null keys go."""
        present = df.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in on]))
        if self.words is None:
            return present
        word, mask = _place(on, self.n_segments)
        found = present.join(F.broadcast(self.words), F.floor(word / SEGMENT) == F.col("_segment"))
        held = F.get("_words", F.pmod(word, F.lit(SEGMENT)).cast("int"))
        return found.filter(held.bitwiseAND(mask) == mask).select(*df.columns)


def _place(on: Sequence[str], n_segments: int) -> tuple[Column, Column]:
    """The word of a key and its bits in it, from two hashes."""
    word = F.pmod(F.xxhash64(*on), F.lit(n_segments * SEGMENT))
    bits = F.xxhash64(F.lit(1), *on)
    places = [F.pmod(F.shiftright(bits, 6 * i), F.lit(64)).cast("int") for i in range(4)]
    ones = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    return word, reduce(lambda x, y: x.bitwiseOR(y), ones)


def bloom_filter(
    keys: DataFrame, on: Sequence[str], *, bits_per_key: int = BITS_PER_KEY, max_bytes: int = MAX_BYTES
) -> Bloom:
    """A Bloom filter of the rows of ``keys``, sized by their number; repeated keys may be left in.

    An empty set gives a filter that nothing passes. The number of rows is counted first, so the size of
    what is broadcast is known before it is built.
    """
    n = keys.count()
    n_segments = max(1, -(-n * bits_per_key // (64 * SEGMENT)))
    if n_segments * (8 * SEGMENT + 64) > max_bytes:
        return Bloom(n, None, n_segments)
    word, mask = _place(on, n_segments)
    held = keys.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    entry = F.struct(F.pmod("_word", F.lit(SEGMENT)).cast("int").alias("at"), F.col("_mask").alias("mask"))
    segments = held.groupBy(F.floor(F.col("_word") / SEGMENT).alias("_segment")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_held")
    )
    dense = F.transform(F.sequence(F.lit(0), F.lit(SEGMENT - 1)), lambda i: F.coalesce(F.col("_held")[i], F.lit(0)))
    return Bloom(n, materialize(segments.select("_segment", dense.alias("_words")), "bloom"), n_segments)


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str], **size: int) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``; only hits and the filter's few false positives are shuffled."""
    wanted = _as_in(df, keys, on)
    likely = bloom_filter(wanted, on, **size).possible(df, on)
    # Not a semi join: Catalyst would push it below the filter, and every row would be shuffled.
    return likely.join(wanted.distinct(), list(on)).select(*df.columns)


def anti_join(df: DataFrame, keys: DataFrame, on: Sequence[str], **size: int) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` or null: what the filter rules out stays where it is."""
    wanted = _as_in(df, keys, on)
    bloom = bloom_filter(wanted, on, **size)
    if bloom.words is None:
        return df.join(wanted.distinct(), list(on), "left_anti").select(*df.columns)
    word, mask = _place(on, bloom.n_segments)
    held = F.get("_words", F.pmod(word, F.lit(SEGMENT)).cast("int"))
    seen = df.join(F.broadcast(bloom.words), F.floor(word / SEGMENT) == F.col("_segment"), "left")
    present = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in on])
    seen = seen.withColumn("_maybe", present & F.coalesce(held.bitwiseAND(mask) == mask, F.lit(False)))
    out = seen.filter("not _maybe").select(*df.columns)
    return out.unionByName(seen.filter("_maybe").join(wanted.distinct(), list(on), "left_anti").select(*df.columns))


def _as_in(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The key columns in the types of ``df``, as hashes depend on the type; keys that don't fit match nothing."""
    types = dict(df.dtypes)
    return keys.select(*[F.col(c) if dict(keys.dtypes)[c] == types[c] else F.col(c).try_cast(types[c]).alias(c) for c in on])
