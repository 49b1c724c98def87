"""Whitening of embedding vectors with MLlib's block matrices.

The distinct vectors are the fit list. Its rows, centred by their mean, are
indexed and dealt into distributed blocks (BlockMatrix); the transpose times
the matrix gives the scatter, of one column by one column each, which alone
comes to the driver. Its eigenvectors, scaled by the roots of the eigenvalues,
are a small block matrix that the blocks of all rows are multiplied with.

A block matrix numbers rows by an int and keeps a key per block on the driver,
so a table of more than BAND rows is several matrices, whose scatters add up.

Defined results: vectors that are NULL or hold NULL, NaN or an infinite entry
are left out, and so are vectors of another length than most have (of lengths
equally frequent the smaller). Repeated rows each have a result. Components
without variance (rank deficient lists, a single vector) do not exist; an empty
table gives an empty result. Entries beyond 2^62 after scaling count as 2^62;
``deviation`` is NULL where it does not fit a long. Only the named id and
vector columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import stored, table

#: Rows of a block, columns of a block, blocks that one task multiplies, and rows of a matrix.
ROWS, COLUMNS, TASK_BLOCKS, BAND = 1024, 1024, 64, 1 << 28
COMPONENTS = 16
#: Eigenvalues below this share of the largest one, times the dimensions, are rounding.
RANK = 1e-13
#: Constants of the query's whole numbers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1000000
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def finite(v: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    return v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))


def commonest_length(rows: DataFrame, vector: str) -> int | None:
    most = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return None if most is None else most["d"]


def numbered(rows: DataFrame, band: int) -> list[tuple[DataFrame, int]]:
    """Stored ``rows`` with ``index``, from 0 in each of the bands of whole files that hold about ``band`` rows, and the rows of each.

    ``rows`` are all rows of the files, with columns added at most. A row's place in its file never changes, so a lost task numbers alike. The
    driver sees one count a file.
    """
    located = rows.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")})
    files = sorted(tuple(r) for r in located.groupBy("_file").count().collect())
    bands, start = [[]], 0
    for name, n in files:
        if bands[-1] and start + n > band:
            bands.append([])
            start = 0
        bands[-1].append((name, start))
        start += n
    held = dict(files)
    out = []
    for part in bands:
        if not part:
            continue
        first = F.broadcast(rows.sparkSession.createDataFrame(part, "_file string, _first long"))
        mine = located.where(F.col("_file").between(part[0][0], part[-1][0])).join(first, "_file")
        out.append((mine.withColumn("index", F.col("_first") + F.col("_at")).drop("_file", "_first", "_at"), sum(held[name] for name, _ in part)))
    return out


def blocks(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """Block matrix of ``rows`` (index, values); all in the JVM."""
    vectors = rows.select(F.col("index").cast("long").alias("index"), array_to_vector("values").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, d).toBlockMatrix(ROWS, min(d, COLUMNS))


def scatter(m: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times matrix. The rows' blocks are dealt to many tasks, whose small products are added.

    MLlib takes the number of such tasks as a second argument, which only its
    JVM method has; without it one task would get all blocks.
    """
    count = -(-n // ROWS)
    cores = m._java_matrix_wrapper._sc.defaultParallelism
    splits = min(count, max(cores, -(-count // TASK_BLOCKS)))
    made = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


@dataclass
class Whitening:
    """``n`` vectors of ``sums`` and ``mean``; ``matrix`` takes a centred row to its whitened components."""

    n: int
    sums: list
    mean: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, vector: str) -> Column:
        return F.zip_with(F.col(vector).cast("array<double>"), F.lit([float(x) for x in self.mean]), lambda x, m: x - m)

    def projected(self, rows: DataFrame, n: int, vector: str) -> BlockMatrix:
        d, k = self.matrix.shape
        spark = rows.sparkSession
        weights = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(self.matrix)], "index long, values array<double>")
        vectors = MLUtils.convertVectorColumnsFromML(weights.select("index", array_to_vector("values").alias("vector")), "vector")
        right = IndexedRowMatrix(vectors, d, k).toBlockMatrix(min(d, COLUMNS), k)
        return blocks(rows.select("index", self.centred(vector).alias("values")), n, d).multiply(right)

    def apply(self, rows: DataFrame, vector: str, band: int = BAND) -> DataFrame:
        """Stored ``rows`` with ``whitened``, an array of the components. A band's result is stored before the next one is made."""
        out = None
        for mine, n in numbered(rows, band) if self.matrix.shape[1] else []:
            made = self.projected(mine, n, vector).toIndexedRowMatrix()
            found = callMLlibFunc("getIndexedRows", made._java_matrix_wrapper._java_model).select("index", vector_to_array("vector").alias("whitened"))
            part = stored(mine.join(found, "index").drop("index"), "whitened")
            out = part if out is None else out.unionByName(part)
        return rows.withColumn("whitened", F.array().cast("array<double>")).limit(0) if out is None else out


def fit(rows: DataFrame, vector: str, components: int = COMPONENTS, band: int = BAND) -> Whitening | None:
    """Whitening fitted on each distinct vector of ``rows`` once (equally long, finite); None of an empty table.

    Sums of whole numbers are exact.
    """
    fit_list = stored(rows.select(vector).distinct(), "fit_list")
    bands = numbered(fit_list, band)
    n = sum(k for _, k in bands)
    if not n:
        return None
    whole = dict(rows.dtypes)[vector] not in ("array<float>", "array<double>")
    value = F.col("value").cast("decimal(20,0)") if whole else F.col("value").cast("double")
    sums = [r["s"] for r in fit_list.select(F.posexplode(vector).alias("dim", "value")).groupBy("dim").agg(F.sum(value).alias("s")).orderBy("dim").collect()]
    d = len(sums)
    mean = np.array([float(s / n) for s in sums])
    found = Whitening(n, [int(s) if whole else s for s in sums], mean, np.zeros((d, 0)), np.zeros(0))
    if not d:
        return found
    total = sum(scatter(blocks(mine.select("index", found.centred(vector).alias("values")), k, d), k) for mine, k in bands) / n
    values, vectors = np.linalg.eigh((total + total.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > max(values[0], 0) * RANK * d).sum()))
    found.matrix = vectors[:, :k] / np.sqrt(values[:k])
    found.explained = values[:k] / np.trace(total)
    if k:
        spread = sum(scatter(found.projected(mine, m, vector), m) for mine, m in bands) / n
        found.identity_error = float(np.abs(spread - np.eye(k)).max())
    return found


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "embeddings"))


def digest(embeddings: DataFrame, band: int = BAND) -> DataFrame:
    """The rows of the query from (vec_id, embedding)."""
    given = embeddings.select("vec_id", "embedding").where(finite(F.col("embedding")))
    limit = float(1 << 62)
    x = F.transform("embedding", lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(limit)), F.lit(-limit))) + SHIFT)
    d = commonest_length(given, "embedding")
    if not d:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    rows = stored(given.where(F.size("embedding") == d).select("vec_id", x.alias("x")), "whole_vectors")
    model = fit(rows, "x", band=band)
    n = F.lit(model.n).cast("long")
    sums = F.lit([s if abs(s) < 1 << 63 else None for s in model.sums]).cast("array<long>")
    apart = F.zip_with("x", sums, lambda a, s: F.try_subtract(F.try_multiply(n, a), s))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda acc, y: F.try_add(acc, F.try_multiply(y, y)))
    shares = F.lit([float(e) for e in model.explained]).cast("array<double>")
    whitened = model.apply(rows.withColumn("deviation", deviation), "x", band)
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), n.alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
