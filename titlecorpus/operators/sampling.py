"""Seeded samples: N without replacement, k with replacement, epoch batches.

All draws are functions of ``md5('<seed>:<key>')``: exact sizes, the same
rows on every run and cluster size, no ``sample()`` (whose size is random).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlecorpus.functions.keys import seeded_int
from titlecorpus.operators.rank import HashOrder, hash_rank


def sample_n(df: DataFrame, n: int, seed, key: str = "id") -> DataFrame:
    """``n`` rows without replacement, clamped to the population."""
    return HashOrder(df, key, seed).take(n)


def sample_n_strict(df: DataFrame, n: int, seed, key: str = "id") -> DataFrame:
    """As ``sample_n`` but more rows than available is an error."""
    order = HashOrder(df, key, seed)
    if n > order.count():
        raise ValueError(f"Cannot take a larger sample ({n}) than population ({order.count()})")
    return order.take(n)


def sample_n_reindexed(df: DataFrame, n: int, seed=42, key: str = "id",
                       index_col: str = "index") -> DataFrame:
    """Strict seeded sample numbered ``index`` = 0..n-1 in draw order."""
    order = HashOrder(df, key, seed)
    total = order.count()
    if n > total:
        raise ValueError(f"Cannot take a larger sample ({n}) than population ({total})")
    ranked = hash_rank(order.take(n), key, seed, index_col)
    return ranked.withColumn(index_col, F.col(index_col) - 1)


def draw_with_replacement(df: DataFrame, k: int, seed, order_seed=42, key: str = "id",
                          rank_col: str = "rank") -> DataFrame:
    """``k`` independent uniform draws (repeats allowed) from the rows of
    ``df`` numbered 1..n in their seeded order (``order_seed``). Draw ``d``
    picks rank ``md5('<seed>:<d>')[:8] mod n + 1``. Output: the drawn rows
    with ``rank_col`` and ``draw`` (0..k-1), one row per draw."""
    spark = df.sparkSession
    order = HashOrder(df, key, order_seed)
    n = order.count()
    if n <= 0 or k <= 0:
        return df.limit(0).withColumn(rank_col, F.lit(0).cast("long")).withColumn(
            "draw", F.lit(0).cast("long"))
    draws = spark.range(k).select(
        F.col("id").alias("draw"),
        (F.pmod(seeded_int(F.col("id"), seed), F.lit(n)) + 1).alias(rank_col))
    return order.rows_for(draws, rank_col)


def epoch_batches(df: DataFrame, epochs: int, batch_size: int, seed, key: str = "id") -> DataFrame:
    """Per epoch, a fresh seeded shuffle cut into batches of ``batch_size``
    (the last one may be short): adds ``epoch``, ``position``, ``batch_id``."""
    if epochs <= 0:
        return df.limit(0).select(F.lit(0).alias("epoch"), key, F.lit(0).cast("long").alias("position"),
                                  F.lit(0).cast("long").alias("batch_id"))
    per_epoch = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    epoch_seed: Column = F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"))
    ranked = hash_rank(per_epoch, key, epoch_seed, "position", group_cols=["epoch"])
    return ranked.withColumn("batch_id", F.floor((F.col("position") - 1) / F.lit(batch_size)))
