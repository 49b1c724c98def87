"""Helpers shared by the operators: stored intermediates and a join that survives hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.session import ship_package, work_path

#: Keys that a hot_join treats apart. Every other key holds less than 1/1000 of the rows.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def hot_join(rows: DataFrame, per_key: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join of ``rows`` with ``per_key`` (one row per key), safe for hot keys.

    The HOT_KEYS keys of the largest ``weight`` (rows held) are broadcast, at
    most HOT_KEYS rows whatever the input; all other keys meet through a
    shuffle, where no key then holds more than 1/HOT_KEYS of the rows.
    ``weight`` is dropped. ``rows`` is read twice; NULL keys get NULLs and
    stay out of the shuffle.
    """
    extra = [c for c in per_key.columns if c not in (key, weight)]
    hot = F.broadcast(per_key.orderBy(F.desc(weight), key).limit(HOT_KEYS).drop(weight))
    keyed, empty = rows.where(F.col(key).isNotNull()), rows.where(F.col(key).isNull())
    types = dict(per_key.dtypes)
    none = empty.select("*", *(F.lit(None).cast(types[c]).alias(c) for c in extra))
    cold = keyed.join(hot.select(key), key, "left_anti").join(per_key.drop(weight), key, "left")
    columns = [*rows.columns, *extra]
    return keyed.join(hot, key).select(columns).unionByName(cold.select(columns)).unionByName(none.select(columns))


#: Text bytes that one step of a Python task holds (a single longer text is one step).
STEP_BYTES = 4 << 20


def steps(batches, column: str, most: int = STEP_BYTES):
    """Slices of Arrow batches whose ``column`` holds at most ``most`` bytes, one row at least."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, "right")))
            yield pa.RecordBatch.from_arrays([c.slice(start, end - start) for c in batch.columns], schema=batch.schema)
            start = end
