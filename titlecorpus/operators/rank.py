"""Exact global ranks and cuts without a one-partition window.

Three building blocks, chosen by the kind of order:

* ``HashOrder`` -- order by ``(md5('<seed>:<key>'), key)``. The md5 hex
  digits are uniform, so their prefix is an order-preserving, skew-free
  bucket. Counting per bucket (a tiny map-side-combined aggregation) gives
  every bucket's offset; ``cut(k)`` turns "rank <= k" into a plain row
  predicate (no shuffle of the rows at all) and ``rank()`` numbers rows with
  one shuffle by bucket plus a broadcast of at most 65 536 offsets.
* ``file_order_rank`` -- line order of a file scan, from the scan's own
  ``_metadata`` (file path, split start) and the per-split row index. No
  shuffle; the offsets table has one row per input split.
* ``global_rank`` -- any other order: range partitioning, checkpointed so
  that the sampled range bounds cannot move between the count and the use,
  then per-partition offsets. Used where the order is not a hash
  (append ids).

All three are deterministic, so a lost executor recomputes the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlecorpus.functions.keys import hex_prefix_int, seeded_hash
from titlecorpus.session import shared_dir, work_path

_BUCKET_DIGITS = 4            # 65 536 buckets per refinement level
_HASH_DIGITS = 32
_EXACT_LIMIT = 200_000        # rows of one bucket that one task sorts; more are refined first
_BROADCAST_SPLITS = 10_000_000  # input splits whose offsets (24 bytes each) are broadcast


class HashOrder:
    """Rows of ``df`` ordered by ``(md5('<seed>:<key>'), key)``.

    ``cut`` and ``cuts`` are predicates on the key, so rows that share a key
    fall on the same side; ``take`` gives exactly k rows in any case.
    """

    def __init__(self, df: DataFrame, key: str, seed):
        self.df = df
        self.key = key
        self.seed = seed
        self.h = seeded_hash(key, seed)
        self._hist: list[tuple[str, int]] | None = None
        self._keys: DataFrame | None = None

    # -- histogram -----------------------------------------------------
    def _keyed(self) -> DataFrame:
        """(key, hash) of all rows, written once: the jobs that look for a
        boundary read these narrow rows, not the rows of ``df`` again."""
        if self._keys is None:
            path = work_path(self.df.sparkSession, "hash-keys")
            self.df.select(F.col(self.key), self.h.alias("_h")).write.parquet(path)
            self._keys = self.df.sparkSession.read.parquet(path)
        return self._keys

    def _histogram(self, prefix: str = "") -> list[tuple[str, int]]:
        digits = len(prefix) + _BUCKET_DIGITS
        keyed = self._keyed()
        if prefix:
            keyed = keyed.where(F.col("_h").startswith(prefix))
        rows = (keyed.groupBy(F.substring("_h", 1, digits).alias("_b"))
                .agg(F.count(F.lit(1)).alias("n")).collect())
        return sorted((r["_b"], r["n"]) for r in rows)

    def count(self) -> int:
        if self._hist is None:
            self._hist = self._histogram()
        return sum(n for _, n in self._hist)

    # -- cut -------------------------------------------------------------
    def boundary(self, k: int):
        """``(h, key)`` of the k-th row in hash order (1-based), or None."""
        total = self.count()
        if k <= 0 or k > total:
            return None
        hist, prefix, remaining = self._hist, "", k
        while True:
            before = 0
            for bucket, n in hist:
                if before + n >= remaining:
                    break
                before += n
            remaining -= before
            if len(bucket) >= _HASH_DIGITS:
                # One hash is one key: all its rows are ties.
                key = (self._keyed().where(F.col("_h") == bucket).agg(F.max(self.key).alias("k")).first()["k"])
                return bucket, key
            if n <= _EXACT_LIMIT:
                # The top-``remaining`` of one bucket, reduced to its last
                # row on the executors: one row reaches the driver.
                last = (self._keyed()
                        .where(F.col("_h").startswith(bucket))
                        .orderBy("_h", self.key).limit(remaining)
                        .agg(F.max(F.struct("_h", self.key)).alias("m")).first()["m"])
                return last["_h"], last[self.key]
            prefix = bucket
            hist = self._histogram(prefix)

    def boundaries(self, ks) -> dict:
        """``{k: (h, key)}`` of the k-th rows for several k at once: one job
        ranks only the buckets that hold them; a bucket too large for that
        is refined on its own (``boundary``)."""
        total = self.count()
        found, pending = {}, {}
        for k in sorted({int(k) for k in ks if 0 < int(k) <= total}):
            before = 0
            for bucket, n in self._hist:
                if before + n >= k:
                    break
                before += n
            if n <= _EXACT_LIMIT:
                pending[k] = (bucket, k - before)
            else:
                found[k] = self.boundary(k)
        if pending:
            buckets = sorted({b for b, _ in pending.values()})
            local = sorted({r for _, r in pending.values()})
            digits = len(buckets[0])
            within = Window.partitionBy("_b").orderBy("_h", self.key)
            # At most len(buckets) x len(ks) rows reach the driver.
            rows = (self._keyed().withColumn("_b", F.substring("_h", 1, digits))
                    .where(F.col("_b").isin(buckets))
                    .withColumn("_r", F.row_number().over(within))
                    .where(F.col("_r").isin(local)).collect())
            at = {(r["_b"], r["_r"]): (r["_h"], r[self.key]) for r in rows}
            found.update({k: at[pos] for k, pos in pending.items()})
        return found

    def cuts(self, ks) -> list:
        """Predicates for several k, with all boundaries found in one job."""
        total = self.count()
        bounds = self.boundaries([k for k in ks if 0 < k < total])
        return [self._cut_at(k, total, bounds.get(k)) for k in ks]

    def cut(self, k: int) -> Column:
        """Predicate: True for the first ``k`` rows in hash order."""
        return self.cuts([k])[0]

    def _cut_at(self, k: int, total: int, bound) -> Column:
        if k <= 0:
            return F.lit(False)
        if k >= total:
            return F.lit(True)
        # One md5 per row: (h, key) <= (h_k, key_k) as a struct comparison.
        return _position(self.h, F.col(self.key)) <= self._literal(bound)

    def take(self, k: int) -> DataFrame:
        """Exactly the first ``k`` rows (all, if there are fewer); which of
        the rows that share the last key are among them is left open."""
        total = self.count()
        if k <= 0:
            return self.df.limit(0)
        if k >= total:
            return self.df
        bound = self.boundary(k)
        before, ties = (self._keyed().agg(
            F.count_if(_position(F.col("_h"), F.col(self.key)) < self._literal(bound)).alias("b"),
            F.count_if(_position(F.col("_h"), F.col(self.key)) == self._literal(bound)).alias("t")).first())
        own = _position(self.h, F.col(self.key))
        if before + ties == k:
            return self.df.where(own <= self._literal(bound))
        # Rows of one key only.
        return self.df.where(own < self._literal(bound)).unionByName(
            self.df.where(own == self._literal(bound)).limit(k - before))

    def _literal(self, bound) -> Column:
        kind = self.df.schema[self.key].dataType
        return _position(F.lit(bound[0]), F.lit(bound[1]).cast(kind))

    def rows_at(self, positions, rank_col: str = "rank") -> DataFrame:
        """Rows at the given 1-based positions (duplicates allowed), each
        with ``rank_col``. Only the buckets that hold those positions are
        ranked, so the cost does not grow with the number of rows skipped."""
        self.count()
        wanted = sorted({int(p) for p in positions if 1 <= int(p) <= self.count()})
        if not wanted:
            return self.df.limit(0).withColumn(rank_col, F.lit(0).cast("long"))
        offsets, before = {}, 0
        for bucket, n in self._hist:
            if any(before < p <= before + n for p in wanted):
                offsets[bucket] = before
            before += n
        spark = self.df.sparkSession
        # At most len(positions) rows: a broadcast bounded by the argument.
        offs = F.broadcast(spark.createDataFrame(sorted(offsets.items()), "_b string, _off long"))
        digits = len(next(iter(offsets)))
        keyed = self.df.withColumn("_h", self.h).withColumn("_b", F.substring("_h", 1, digits))
        picked = keyed.where(F.col("_b").isin(list(offsets))).join(offs, "_b")
        within = Window.partitionBy("_b").orderBy("_h", self.key)
        ranked = picked.withColumn(rank_col, (F.col("_off") + F.row_number().over(within)).cast("long"))
        return ranked.where(F.col(rank_col).isin(wanted)).drop("_h", "_b", "_off")

    def rows_for(self, wanted: DataFrame, rank_col: str = "rank") -> DataFrame:
        """The rows of ``wanted``, each with the row of the order at its 1-based
        position ``rank_col``; positions may repeat, and any number of them
        stays distributed.

        The histogram's prefix sums are cut into cells of equal width, so a
        position finds its bucket by an equality on the cell and a range: at
        most two rows a bucket, broadcast. Only buckets that hold a wanted
        position are ranked.
        """
        total = self.count()
        spark = self.df.sparkSession
        spans, before = [], 0
        for bucket, n in self._hist:
            spans.append((bucket, before, n))
            before += n
        width = max(1, -(-total // max(1, len(spans))))
        table = spark.createDataFrame(spans, "_b string, _off long, _n long")
        cell = lambda x: F.floor(x / width).cast("long")
        cells = table.withColumn("_cell", F.explode(F.sequence(cell(F.col("_off")), cell(F.col("_off") + F.col("_n") - 1))))
        place = F.col(rank_col) - 1
        placed = wanted.withColumn("_cell", cell(place)).join(F.broadcast(cells), "_cell").where(
            (place >= F.col("_off")) & (place < F.col("_off") + F.col("_n"))).drop("_cell", "_n")
        hit = F.broadcast(placed.select("_b", "_off").distinct())
        digits = len(spans[0][0]) if spans else _BUCKET_DIGITS
        keyed = self.df.withColumn("_h", self.h).withColumn("_b", F.substring("_h", 1, digits)).join(hit, "_b")
        within = Window.partitionBy("_b").orderBy("_h", self.key)
        ranked = keyed.withColumn(rank_col, (F.col("_off") + F.row_number().over(within)).cast("long")).drop("_h", "_b", "_off")
        return ranked.join(placed.drop("_b", "_off"), rank_col)

    # -- rank ------------------------------------------------------------
    def rank(self, rank_col: str = "rank", group_cols=()) -> DataFrame:
        """Add ``rank_col`` = exact 1-based rank in hash order (per group)."""
        return hash_rank(self.df, self.key, self.seed, rank_col, group_cols)


def _position(h: Column, key: Column) -> Column:
    return F.struct(h.alias("h"), key.alias("k"))


def hash_rank(df: DataFrame, key: str, seed, rank_col: str = "rank",
              group_cols=()) -> DataFrame:
    """Exact 1-based rank of rows by ``(md5('<seed>:<key>'), key)`` per group.

    One shuffle of the rows by (group, bucket); offsets are a broadcast of
    at most groups x 65 536 rows.
    """
    groups = list(group_cols)
    keyed = (df.withColumn("_h", seeded_hash(key, seed))
             .withColumn("_b", hex_prefix_int(F.col("_h"), _BUCKET_DIGITS)))
    counts = keyed.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_b",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    return (keyed.join(F.broadcast(offsets), [*groups, "_b"])
            .withColumn(rank_col, (F.col("_off") + F.row_number().over(within)).cast("long"))
            .drop("_h", "_b", "_off"))


# -- file order ---------------------------------------------------------------
def with_file_order(df: DataFrame) -> DataFrame:
    """Tag rows of a file scan with their position key.

    Must be applied directly on the scan: ``_metadata`` and the row index
    inside the split are taken in the same projection as the read.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


FILE_ORDER = ("_file", "_block", "_row")


def file_order_rank(tagged: DataFrame, rank_col: str = "line_no") -> DataFrame:
    """Exact 1-based line order over all files of a scan tagged by
    ``with_file_order``: order = (file path, split start, row in split).

    A split's offset is keyed by a hash of its file and start, so the offsets
    are 24 bytes a split and are broadcast up to ``_BROADCAST_SPLITS`` of them
    (more than a petabyte in splits of 128 MB). A row whose split has no
    offset, because the input changed between the two reads, is an error.
    """
    key = F.xxhash64("_file", "_block")
    splits = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(key.alias("_split"),
                            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"))
    if tagged.rdd.getNumPartitions() + len(tagged.inputFiles()) <= _BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    known = F.when(F.col("_off").isNull(), F.raise_error(F.lit("the input files changed while they were read")).cast("long")) \
        .otherwise(F.col("_off"))
    return (tagged.withColumn("_split", key).join(offsets, "_split", "left")
            .withColumn(rank_col, (known + F.col("_row")).cast("long")).drop("_split", "_off"))


# -- any order -----------------------------------------------------------------
#: Keys that one task holds to find the n-th; for more the keys are range-partitioned.
TOP_KEYS = 100_000


def first_by(df: DataFrame, order_cols, n: int) -> DataFrame:
    """Exactly the first ``n`` rows by ``order_cols`` (all, if there are fewer).

    Only the order columns are sorted: they are range-partitioned, the
    partition that holds place ``n`` is found from the partitions' counts, and
    the key at that place cuts ``df`` by a predicate. No row of ``df`` is
    shuffled; of rows with the very last key as many are taken as are missing.
    """
    spark = df.sparkSession
    shared_dir(spark)
    position = F.struct(*((F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order_cols)))
    keys = df.select(position.alias("_k"))
    if n <= TOP_KEYS:
        # Each task keeps its n least keys; those meet in one task.
        least = keys.orderBy("_k").limit(n).agg(F.count(F.lit(1)).alias("n"), F.max("_k").alias("k")).first()
        if least["n"] < n:
            return df
        bound = _literal(keys, least["k"])
        held = keys.agg(F.count_if(F.col("_k") < bound).alias("below"), F.count_if(F.col("_k") == bound).alias("ties")).first()
        return _cut(df, position, bound, n - held["below"], held["ties"])
    parts = max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    placed = (keys.repartitionByRange(parts, "_k").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    before = 0
    # One row per partition reaches the driver.
    for r in sorted(placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()):
        if before + r["n"] >= n:
            break
        before += r["n"]
    else:
        return df
    # Range partitions keep equal keys together, so all ties are in this one.
    inside = placed.where(F.col("_pid") == r["_pid"])
    place = F.row_number().over(Window.partitionBy("_pid").orderBy("_k"))
    rank = F.rank().over(Window.partitionBy("_pid").orderBy("_k"))
    last = inside.withColumn("_place", place).withColumn("_rank", rank).where(F.col("_place") == n - before).first()
    bound = _literal(placed, last["_k"])
    missing = n - before - last["_rank"] + 1
    return _cut(df, position, bound, missing, inside.where(F.col("_k") == bound).limit(missing + 1).count())


def _literal(keys: DataFrame, value) -> Column:
    fields = keys.schema["_k"].dataType.fields
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, fields)))


def _cut(df: DataFrame, position: Column, bound: Column, missing: int, ties: int) -> DataFrame:
    """The rows before ``bound`` and ``missing`` of the ``ties`` at it."""
    if ties == missing:
        return df.where(position <= bound)
    return df.where(position < bound).unionByName(df.where(position == bound).limit(missing))


def global_rank(df: DataFrame, order_cols, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based rank by ``order_cols`` (a total order) for any key.

    Range-partitions and sorts the rows, then numbers them inside each
    partition; the partitioned data is checkpointed to the shared folder
    so the sampled range bounds stay fixed for both uses and survive the
    loss of an executor.
    """
    spark = df.sparkSession
    shared_dir(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # As wide as the input (one range per input split) or the cluster.
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    placed = (df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: a bounded broadcast.
    offsets = F.broadcast(counts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (placed.join(offsets, "_pid")
            .withColumn(rank_col, (F.col("_off") + local + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))
