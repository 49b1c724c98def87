"""Exact, seeded splits (train / eval, train / validation / test).

The split is a row predicate derived from the hash order (see
``HashOrder.cut``), so assigning rows to parts never shuffles the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlecorpus.operators.rank import HashOrder
from titlecorpus.operators.select import first_n


def fraction_size(frac: float, n: int) -> int:
    """Rows taken by an exact fraction sample: round-half-even of frac * n."""
    return round(frac * n)


def split_fraction(df: DataFrame, frac: float = 0.1, seed=42, key: str = "id",
                   part: str = "eval", rest: str = "train", split_col: str = "split") -> DataFrame:
    """Add ``split_col``: exactly round(frac * n) rows are ``part``."""
    order = HashOrder(df, key, seed)
    k = fraction_size(frac, order.count())
    return df.withColumn(split_col, F.when(order.cut(k), F.lit(part)).otherwise(F.lit(rest)))


#: Words of 64 bits of the filter of the removed keys: 64 MB with their numbers, however many keys.
FILTER_WORDS = 1 << 22


def _bits(key: str) -> tuple[Column, Column]:
    """Word of a key in the filter, and its four bits there."""
    h = F.xxhash64(key)
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {22 + 6 * i}) & 63 as int))") for i in range(4)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return h, mask


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(_word, _held): a Bloom filter of the keys, blocked by word; filters of parts merge by OR. At most FILTER_WORDS rows."""
    h, mask = _bits(key)
    return keys.withColumn("_h", h).select(F.pmod("_h", F.lit(FILTER_WORDS)).alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_held"))


def complement(df: DataFrame, part: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``df`` whose key is not in ``part`` (difference by row identity).

    A row whose bits the filter of the part's keys lacks is surely no member
    and stays where it is; only the others, the members and a few more, meet
    the keys in a shuffle. Exact at any size; a part of far more keys than the
    filter has bits shuffles more rows. Rows without a key stay.
    """
    keys = part.select(key)
    h, mask = _bits(key)
    probed = df.withColumn("_h", h).withColumns({"_word": F.pmod("_h", F.lit(FILTER_WORDS)), "_mask": mask})
    probed = probed.join(F.broadcast(key_filter(keys, key)), "_word", "left")
    hit = F.coalesce(F.col("_held").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    met = probed.where(hit).select(*df.columns).join(keys, key, "left_anti")
    return probed.where(~hit).select(*df.columns).unionByName(met.select(*df.columns))


def three_way_sizes(held_frac: float, n: int) -> tuple[int, int]:
    """(held-out rows, test rows): held = ceil(t * n), test = ceil(held / 2)."""
    held = math.ceil(held_frac * n)
    return held, math.ceil(0.5 * held)


def split_three_way(df: DataFrame, held_frac: float = 0.1, seed=42, key: str = "id",
                    split_col: str = "split") -> DataFrame:
    """train / validation / test with exact sizes from one hash order."""
    order = HashOrder(df, key, seed)
    held, test = three_way_sizes(held_frac, order.count())
    in_test, in_held = order.cuts([test, held])
    return df.withColumn(
        split_col,
        F.when(in_test, F.lit("test")).when(in_held, F.lit("validation")).otherwise(F.lit("train")))


def first_k_of_split(df: DataFrame, k: int, seed=42, key: str = "id",
                     split_col: str = "split", name: str = "eval") -> DataFrame:
    """First ``k`` rows of a split in its (hash) order."""
    part = df.where(F.col(split_col) == F.lit(name))
    return first_n(part, [HashOrder(part, key, seed).h, F.col(key)], k)
