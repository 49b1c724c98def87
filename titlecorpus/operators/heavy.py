"""Joins of occurrences with a table of one row a key, safe for keys that hold a large share of the rows.

A count per hash bucket of the keys is a sketch that merges by addition: one
bounded aggregation over the rows themselves, not over the table, so a key that
the table lacks is seen as well. Every key of at least 1 in SHARE rows lies in a
bucket that is that heavy; there are SHARE such buckets at most. Rows of heavy
buckets are salted over REPLICAS places and the table's rows of these buckets
are copied to each; all other keys meet in one place. The rows come out of one
join, whatever the sizes; where the table is small by Spark's own estimate and
threshold, Spark broadcasts it and nothing is salted.

Rows that hold lists of keys need not send a row for each occurrence: they are
dealt to blocks of about BLOCK_BYTES of keys (``dealt``), each block's different
keys meet the table once, and come back as the dictionary of their block
(``looked_up``). A key has a few rows a block at most, so none is heavy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlecorpus.session import ship_package

BUCKETS, SHARE, REPLICAS = 1 << 16, 1000, 64
BLOCK_BYTES = 24 << 20


def bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def heavy_buckets(rows: DataFrame, key: str) -> DataFrame:
    """(_bucket) of the hash buckets that hold at least 1 in SHARE of the rows with a key; SHARE rows at most."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(bucket(key).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.join(F.broadcast(total), F.col("_n") * SHARE >= F.col("_total")).select("_bucket")


def is_small(table: DataFrame) -> bool:
    """Whether Spark, by its estimate and its threshold, would broadcast ``table``."""
    threshold = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def spread_join(rows: DataFrame, table: DataFrame, key: str, by) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per ``key``); ``by``: columns that tell the rows of one key apart."""
    if is_small(table):
        return rows.join(table, key, "left")
    heavy = heavy_buckets(rows, key)
    spread = F.pmod(F.xxhash64(*by), F.lit(REPLICAS)).cast("int")
    salted = rows.withColumn("_b", bucket(key)).join(F.broadcast(heavy), F.col("_b") == F.col("_bucket"), "left")
    # Rows without a key match nothing; salted alike, they do not meet in one task either.
    salted = salted.withColumn("_salt", F.when(F.col("_bucket").isNotNull() | F.col(key).isNull(), spread).otherwise(0)).drop("_b", "_bucket")
    copies = table.withColumn("_b", bucket(key)).join(F.broadcast(heavy), F.col("_b") == F.col("_bucket"), "left")
    places = F.when(F.col("_bucket").isNotNull(), F.sequence(F.lit(0), F.lit(REPLICAS - 1))).otherwise(F.array(F.lit(0)))
    copies = copies.withColumn("_salt", F.explode(places)).drop("_b", "_bucket")
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def block_count(df: DataFrame, size: Column) -> int:
    """Blocks for the rows of ``df``, of ``size`` bytes of keys each."""
    total = df.agg(F.sum(size.cast("double"))).first()[0] or 0
    return math.ceil(total / BLOCK_BYTES) or 1


def dealt(rows: DataFrame, by: str, blocks: int) -> DataFrame:
    """``rows`` with ``_block``, one of so many ``blocks`` by the hash of ``by``, partitioned by it."""
    return rows.withColumn("_block", F.pmod(F.xxhash64(by), F.lit(blocks))).repartition("_block")


def _parts(keys):
    """(offsets, bounds, key): parts of each row, keys of each part, and the keys; a part is a list or a string with a space between keys."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    part = keys.flatten()
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False))])
    if not pa.types.is_string(part.type):
        ends = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
        return bounds, np.concatenate([[0], ends]), part.flatten()
    part = pc.split_pattern(pc.fill_null(part, ""), " ")
    key = part.flatten()
    there = pc.not_equal(key, "")
    ends = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    offsets = part.offsets.to_numpy()
    return bounds, ends[offsets - offsets[0]], key.filter(there)


def looked_up(blocks: DataFrame, rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with ``values`` in place of ``keys``: for each part the ``value`` of its keys in ``table`` (one row per ``key``), NULL if there is none.

    ``blocks``: as ``dealt`` gives them, with ``keys``; an array of parts, each
    an array of keys or a string with a space between them. ``rows``: those of
    ``blocks``, or made of them inside their blocks.
    """
    types = dict(table.dtypes)
    ship_package(table.sparkSession)

    def different(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            bounds, ends, found = _parts(b.column("keys"))
            if not len(found):
                continue
            block = np.repeat(b.column("_block").to_numpy(), np.diff(ends[bounds]))
            known = found.dictionary_encode()
            names, block = np.unique(block, return_inverse=True)
            code = np.asarray(known.indices.fill_null(-1)).astype(np.int64)
            there = code >= 0
            pair = np.unique(block[there] * len(known.dictionary) + code[there])
            yield pa.RecordBatch.from_arrays([pa.array(names[pair // len(known.dictionary)]), known.dictionary.take(pa.array(pair % len(known.dictionary)))], ["_block", "_key"])

    def look(left, right):
        import pyarrow as pa
        import pyarrow.compute as pc

        bounds, ends, found = _parts(left.column("keys").combine_chunks())
        right = right.combine_chunks()
        at = pc.index_in(found, value_set=right.column("_key"))
        flat = right.column("_value").combine_chunks().take(at)
        parts = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), flat)
        values = pa.ListArray.from_arrays(pa.array(bounds.astype("int32")), parts)
        return pa.table([*(left.column(c) for c in given), values], [*given, "values"])

    pairs = blocks.sortWithinPartitions("_block").mapInArrow(different, f"_block long, _key {types[key]}")
    entries = pairs.join(table.select(F.col(key).alias("_key"), F.col(value).alias("_value")).where("_key is not null"), "_key").select("_block", "_key", "_value")
    given = [c for c in rows.columns if c not in ("_block", "keys")]
    schema = rows.select(*given).withColumn("values", F.lit(None).cast(f"array<array<{types[value]}>>")).schema
    return rows.groupBy("_block").cogroup(entries.groupBy("_block")).applyInArrow(look, schema)
