"""Approximate nearest neighbours by learned partitions.

On a bounded sample: a graph of nearest neighbours is cut into balanced parts
(bisection by the first principal direction, then swaps of node pairs that
lower the cut), and a small network learns from a vector which parts its
neighbours are in. The network gives every row of the table its most probable
part, and every query its ``probes`` most probable ones; within them queries
meet rows in blocks and are ranked by the exact cosine. ``probes`` is the least
number that finds RECALL of the neighbours of held-out sample vectors, plus one.

Blocks: parts are dealt by hash into blocks of about BLOCK rows, on the side of
the rows and of the queries, so a hot part or a hot vector is many small tasks.
Of equal vectors only the ``k + 1`` with the smallest ids can be among the
nearest, and only these are searched; that loses nothing.

Defined results: vectors that are NULL, zero, hold NULL or non-finite
components, are of another length than most, or have a NULL id take no part;
rows repeated whole count once; with fewer candidates than k all are returned;
an empty table gives no rows. Ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlecorpus.llm.common import stored, table

#: Vectors of the sample, neighbours of each in its graph, rows a part should hold, and most parts.
SAMPLE, GRAPH, PART_ROWS, PARTS = 8192, 10, 2000, 256
#: Rows of a block, and queries.
BLOCK, QUERY_BLOCK = 8192, 2048
RECALL, HIDDEN, EPOCHS = 0.97, 128, 30


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ids of the k nearest of each unit vector, itself left out."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for s in range(0, len(x), 512):
        sim = x[s:s + 512] @ x.T
        sim[np.arange(len(sim)), np.arange(s, s + len(sim))] = -np.inf
        out[s:s + 512] = np.argsort(-sim, axis=1, kind="stable")[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """Part of each vector: halves of halves, equal in size, with few graph edges between them."""
    part = np.zeros(len(x), np.int64)
    for p in range(parts.bit_length() - 1):
        whole = part.copy()
        for one in range(1 << p):
            at = np.flatnonzero(whole == one)
            mid = x[at] - x[at].mean(0)
            side = np.zeros(len(x), np.int8)  # 0 outside, 1 and -1 the halves
            order = at[np.argsort(mid @ np.linalg.eigh(mid.T @ mid)[1][:, -1], kind="stable")]
            side[order[:len(at) // 2]], side[order[len(at) // 2:]] = 1, -1
            for r in range(rounds):
                pull = side[graph[at]].sum(1)
                np.add.at(pull_all := np.zeros(len(x)), graph[at].ravel(), np.repeat(side[at], graph.shape[1]))
                gain = -side[at] * (pull + pull_all[at])
                left, right = at[side[at] == 1], at[side[at] == -1]
                left, right = left[np.argsort(-gain[side[at] == 1], kind="stable")], right[np.argsort(-gain[side[at] == -1], kind="stable")]
                both = np.sort(gain[side[at] == 1])[::-1][:min(len(left), len(right))] + np.sort(gain[side[at] == -1])[::-1][:min(len(left), len(right))]
                swaps = int((both > 0).sum()) // 2
                if not swaps:
                    break
                side[left[:swaps]], side[right[:swaps]] = -1, 1
            part[at] = 2 * one + (side[at] == -1)
    return part


@dataclass
class Router:
    """Two-layer network: vector -> probabilities of the parts, as logits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]


def train(x: np.ndarray, target: np.ndarray, seed: int = 5) -> Router:
    """Cross entropy to soft labels, Adam over mini batches."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    p = [rng.normal(0, np.sqrt(2 / d) * np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 256):
            b, y = x[order[s:s + 256]], target[order[s:s + 256]]
            h = np.maximum(b @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            dz = (z / z.sum(1, keepdims=True) - y) / len(b)
            dh = (dz @ p[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((b.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - 5e-3 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Router(*p, probes=parts)


def fit(sample: np.ndarray, parts: int) -> Router:
    """Router over ``parts`` (a power of two) parts from sample vectors."""
    x = unit(sample)
    if parts == 1 or len(x) < 8 * parts:
        d = x.shape[1] if len(x) else 1
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, GRAPH)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(1, keepdims=True)
    held = np.arange(len(x)) % 5 == 0
    router = train(x[~held], target[~held])
    routed = router.parts(x, parts)
    nearest = routed[:, 0][graph[held][:, :5]]
    place = (routed[held][:, None, :] == nearest[:, :, None]).argmax(2)  # probes needed for each neighbour, less one
    found = np.array([(place < n).mean() for n in range(1, parts + 1)])
    router.probes = min(parts, int(np.argmax(found >= RECALL)) + 2)
    return router


def usable(v: Column) -> Column:
    return (v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
            & F.exists(v, lambda c: c != 0))


def vectors_of(column) -> np.ndarray:
    """Matrix of an Arrow list column of equally long vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, cosine) of each query's k nearest candidates with another id than its own."""
    out = []
    uc, nc = unit(c), np.sqrt((c * c).sum(1))
    for s in range(0, len(q), 256):
        ids, some = q_id[s:s + 256], q[s:s + 256]
        sim = unit(some) @ uc.T
        sim[ids[:, None] == c_id[None, :]] = -np.inf
        least = np.partition(sim, -k, axis=1)[:, -k] if sim.shape[1] > k else np.full(len(some), -2.0)
        # The product rounds by position; what may be among the first is computed again, alike for equal vectors.
        i, j = np.nonzero(sim >= np.maximum(least, -2.0)[:, None] - 1e-9)
        score = (some[i] * c[j]).sum(1) / (np.sqrt((some[i] * some[i]).sum(1)) * nc[j])
        order = np.lexsort((c_id[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((ids[i[first]], c_id[j[first]], score[first]))
    return tuple(np.concatenate(a) for a in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def search(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each row for which ``is_query`` holds."""
    import pyarrow as pa

    result = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    given = rows.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    most = given.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return spark.createDataFrame([], result)
    given = given.where(F.size("v") == most["d"]).groupBy("id", "v", "q").agg(F.lit(1).alias("one")).drop("one")
    # Of equal vectors the first k + 1 by id; Spark limits each task's rows of a vector before they meet.
    copy = F.row_number().over(W.partitionBy("v").orderBy("id"))
    firsts = stored(given.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy", "q"), "ann_rows")
    queries = given.where("q").drop("q")

    n = firsts.count()
    parts = 1 << min(PARTS.bit_length() - 1, max(0, int(np.ceil(np.log2(max(n, 1) / PART_ROWS)))))
    sample = firsts.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()["v"]
    router = fit(np.array(sample.tolist(), np.float64).reshape(len(sample), -1), parts)

    def route(probes: int):
        def routed(batches):
            for b in batches:
                if b.num_rows:
                    chosen = router.parts(unit(vectors_of(b.column("v"))), probes)
                    yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(list(chosen.astype(np.int32)), pa.list_(pa.int32()))], ["id", "v", "p"])
        return routed

    shape = "id long, v array<double>, p array<int>"
    indexed = stored(firsts.mapInArrow(route(1), shape).select("id", "v", F.col("p")[0].alias("p")), "ann_index")
    asked = stored(queries.mapInArrow(route(router.probes), shape).select("id", "v", F.explode("p").alias("p")), "ann_queries")
    blocks = lambda df, size: df.groupBy("p").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    # One row per part, PARTS at most.
    deal = F.broadcast(blocks(indexed, BLOCK).withColumnRenamed("n", "nb").join(blocks(asked, QUERY_BLOCK).withColumnRenamed("n", "nq"), "p"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = asked.join(deal, "p").select("p", own("nq").alias("b"), every("nb").alias("c"), "id", "v")
    right = indexed.join(deal, "p").select("p", every("nq").alias("b"), own("nb").alias("c"), "id", "v")

    def block(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            whole = lambda t: (t["id"].to_numpy(), vectors_of(t["v"].combine_chunks()))
            found = nearest(*whole(q), *whole(c), k)
        return pa.table([pa.array(a) for a in found], ["query_id", "vec_id", "score"])

    met = left.groupBy("p", "b", "c").cogroup(right.groupBy("p", "b", "c")).applyInArrow(block, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
