"""Exact top-k search by inner product, by buckets of the vectors' lengths.

Candidates of about the same length (CLASSES classes a doubling) form a bucket,
split into blocks of about BLOCK rows; a query meets blocks in groups of about
QUERIES. The SEEDS longest vectors come first: the k-th best product with them
bounds a query's k-th best from below. Of the other buckets a query meets those
only whose length can reach that bound. In a block the bound becomes a local
cosine: that which a vector of the block's greatest length needs. If it is
SHARP at least, the query looks by coordinates, at vectors whose entries in its
FOCUS largest coordinates lie where that cosine allows; else by length, at the
vectors long enough. What is left is multiplied, so every score is exact.

Defined results: vectors that are NULL or hold NULL, NaN or an infinite entry
take no part, nor do rows without an id or of another length than most have (of
lengths equally frequent the smaller); zero vectors do, with scores of 0. Rows
equal in id and vector are one. Candidates of a query are the rows of other
ids; an id with two vectors asks twice. A score beyond a long stands as the
largest or smallest long. Ties go to the smaller id. An empty table gives an
empty result. Only the named id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlecorpus.llm.common import stored, table
from titlecorpus.llm.whitening import commonest_length, finite

CLASSES, BLOCK, QUERIES, SEEDS = 8, 8192, 1024, 4096
SHARP, FOCUS = 0.7, 4
#: Class of what has no logarithm: the shortest candidates, and queries that any candidate may serve.
LOWEST = -100000
#: Relative room for the rounding of lengths and bounds.
SLACK = 1e-9
TOP = 2**63 - 1
SCALE = 1024
FOUND = "row long, query_id long, vec_id long, score long"


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows: doubles while every sum stays below 2^53, else longs, as far as they reach."""
    bound = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(q.shape[1], 1)
    if bound < 2**53:
        return q.astype(np.float64) @ c.astype(np.float64).T
    if bound < 2**62:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, -TOP, TOP).astype(np.int64)


def ranked(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest allowed scores, ties to the smaller id."""
    lowest = -np.inf if score.dtype == np.float64 else -TOP - 1
    open_ = np.where(allowed, score, lowest)
    least = np.partition(open_, -k, axis=1)[:, -k] if open_.shape[1] > k else np.full(len(open_), lowest)
    i, j = np.nonzero(allowed & (open_ >= least[:, None]))
    order = np.lexsort((ids[j], -score[i, j], i))
    i, j = i[order], j[order]
    first = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[first], j[first]


class Block:
    """Candidates of a block, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, -lengths))
        self.ids, self.vectors, self.lengths = ids[order], vectors[order], lengths[order]
        self.directions = self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.sorted: dict[int, tuple] = {}

    def local(self, need: np.ndarray) -> np.ndarray:
        """Cosine that the longest vector needs for a product of ``need`` times the query's length."""
        longest = self.lengths[0] if len(self.lengths) else 0.0
        return np.where(np.isneginf(need), -1.0, need * (1 - SLACK) / longest if longest > 0 else np.where(need > 0, 2.0, -1.0))

    def by_length(self, need: float) -> int:
        """How many vectors, from the longest on, are long enough."""
        return len(self.ids) if need <= 0 else int(np.searchsorted(-self.lengths, -need * (1 - SLACK), "right"))

    def by_coordinates(self, q: np.ndarray, cosine: float) -> np.ndarray:
        """Places of the vectors whose entries in the query's largest coordinates allow that cosine."""
        unit = q / np.sqrt((q * q).sum())
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        # A vector within the angle of the query is within it of the query's angle to the axis, too.
        wide, axis = np.arccos(min(1.0, cosine)), np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, axis + wide)) - SLACK
        high = np.cos(np.maximum(0, axis - wide)) + SLACK
        if (f := int(focus[0])) not in self.sorted:
            order = np.argsort(self.directions[:, f], kind="stable")
            self.sorted[f] = order, self.directions[order, f]
        order, entries = self.sorted[f]
        at = order[np.searchsorted(entries, low[0]):np.searchsorted(entries, high[0], "right")]
        for f, lo, hi in zip(focus[1:], low[1:], high[1:]):
            entry = self.directions[at, f]
            at = at[(entry >= lo) & (entry <= hi)]
        return at

    def best(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, least: np.ndarray, k: int):
        """(query, place, score) of each query's ``k`` best with a score of ``least`` (-inf: any) at least."""
        known = np.isfinite(least) & (lengths > 0)
        need = np.where(known, least / np.where(lengths > 0, lengths, 1), -np.inf)
        local = self.local(need)
        sharp = (local >= SHARP) & (local <= 1 + SLACK)
        out = []
        for i in np.flatnonzero(sharp):
            at = self.by_coordinates(vectors[i].astype(np.float64), float(local[i]))
            score = products(vectors[i:i + 1], self.vectors[at])
            _, j = ranked(score, (self.ids[at] != ids[i])[None, :] & (score >= least[i]), self.ids[at], k)
            out.append((np.full(len(j), i), at[j], score[0, j]))
        rest = np.flatnonzero(local < SHARP)
        reach = np.array([self.by_length(x) for x in need[rest]], np.int64)
        rest, reach = rest[np.argsort(reach, kind="stable")], np.sort(reach)
        for s in range(0, len(rest), 128):
            some, most = rest[s:s + 128], int(reach[s:s + 128].max())
            score = products(vectors[some], self.vectors[:most])
            i, j = ranked(score, (self.ids[None, :most] != ids[some][:, None]) & (score >= least[some][:, None]), self.ids[:most], k)
            out.append((some[i], j, score[i, j]))
        whole = lambda part: np.concatenate([np.asarray(x[part], np.int64) for x in out]) if out else np.zeros(0, np.int64)
        return whole(0), whole(1), whole(2)


def matrix(column, d: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).astype(np.int64).reshape(len(column), d)


def search(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, query_id, rank, vec_id, score): the ``k`` highest products of each row for which ``is_query`` holds, of vectors of whole numbers."""
    spark = rows.sparkSession
    found = rows.where(F.col(key).isNotNull() & finite(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<long>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    d = commonest_length(found, "v")
    if d is None:
        return spark.createDataFrame([], "row long, query_id long, rank int, vec_id long, score long")
    found = found.where(F.size("v") == d).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # Of equal vectors only the first k + 1 ids can be among a query's best; Spark limits each task's rows of a vector before they meet.
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    numbers = {"row": F.monotonically_increasing_id(), "length": F.sqrt(square)}
    firsts = stored(found.drop("q").distinct().withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy").withColumns(numbers), "product_rows")
    queries = stored(found.where("q").drop("q").withColumns(numbers), "product_queries")
    class_of = lambda x: F.coalesce(F.when(x > 0, F.floor(F.log2(x) * CLASSES).cast("int")), F.lit(LOWEST))

    def block(q, c):
        import pyarrow as pa

        out = [np.zeros(0, np.int64)] * 4
        if q.num_rows and c.num_rows:
            ids, row = np.asarray(q["id"]), np.asarray(q["row"])
            least = np.asarray(q["least"].cast("double").fill_null(-np.inf))
            held = Block(np.asarray(c["id"]), matrix(c["v"], d), np.asarray(c["length"]))
            i, j, score = held.best(ids, matrix(q["v"], d), np.asarray(q["length"]), least, k)
            out = [row[i], ids[i], held.ids[j], score]
        return pa.table([pa.array(x, pa.int64()) for x in out], ["row", "query_id", "vec_id", "score"])

    dealt = lambda n: F.pmod(F.xxhash64("row"), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    parts = lambda df, by, size, name: df.groupBy(by).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    # The longest vectors meet all queries.
    seeds = stored(firsts.orderBy(F.desc("length"), "id", "row").limit(SEEDS), "product_seeds")
    groups = queries.agg(F.greatest(F.ceil(F.count("*") / QUERIES), F.lit(1)).cast("int").alias("groups"))
    asked = queries.withColumn("least", F.lit(None).cast("long")).join(F.broadcast(groups)).select(dealt("groups").alias("g"), "id", "row", "v", "length", "least")
    offered = seeds.join(F.broadcast(groups)).select(every("groups").alias("g"), "id", "v", "length")
    first = stored(asked.groupBy("g").cogroup(offered.groupBy("g")).applyInArrow(block, FOUND), "product_first")

    # Then each query meets the blocks of the classes that may reach its k-th best so far. Classes: some hundreds at most, whatever the table.
    kth = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k).drop("n")
    need = F.try_divide(F.col("least"), F.col("length")) * (1 - SLACK)
    asked = stored(queries.join(kth, "row", "left").withColumn("t", class_of(need)), "product_asked")
    rest = stored(firsts.join(F.broadcast(seeds.select("row")), "row", "left_anti").withColumn("c", class_of(F.col("length"))), "product_rest")
    met = F.broadcast(parts(asked, "t", QUERIES, "nq").join(F.broadcast(parts(rest, "c", BLOCK, "nb")), F.col("c") >= F.col("t")))
    pair = [F.col("t").alias("qt"), F.col("c").alias("vc")]
    left = asked.join(met, "t").select(*pair, dealt("nq").alias("b"), every("nb").alias("j"), "id", "row", "v", "length", "least")
    right = rest.join(met, "c").select(*pair, every("nq").alias("b"), dealt("nb").alias("j"), "id", "v", "length")
    cell = ["qt", "vc", "b", "j"]
    more = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(block, FOUND)

    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    best = first.unionByName(more).withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return best.select("row", "query_id", "rank", "vec_id", "score")


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) with floor(SCALE * x) for each component."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    return embeddings.where(finite(F.col("embedding"))).select("vec_id", whole.alias("embedding"))


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(whole_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH whole AS (
  SELECT vec_id, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
