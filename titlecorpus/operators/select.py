"""Projections, filters and order-based limits (P1-P5, O10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlecorpus.functions.text import normalize_ws, task_prefix
from titlecorpus.operators.rank import first_by


def category_filter(df: DataFrame, category: str | None, col: Column | None = None) -> DataFrame:
    """Case-sensitive substring test on the space-joined categories text.

    Runs before any sampling. NULL categories never match. On Parquet the
    predicate reaches the scan as ``StringContains``.
    """
    if not category:
        return df
    c = F.col("categories") if col is None else col
    return df.where(c.contains(F.lit(category)))


def category_count(df: DataFrame, category: str | None) -> DataFrame:
    """One row ``n_found``: rows whose categories contain ``category``."""
    return category_filter(df, category).agg(F.count(F.lit(1)).alias("n_found"))


def normalize_text(df: DataFrame, cols) -> DataFrame:
    """Whitespace normalisation of the given columns, in place."""
    return df.withColumns({c: normalize_ws(c) for c in cols})


def pair_projection(df: DataFrame, input_col: str = "abstract",
                    target_col: str = "title", id_col: str = "id") -> DataFrame:
    """(id, input_text, target_text), rows with a NULL side dropped."""
    return (df.select(F.col(id_col).alias("id"),
                      F.col(input_col).alias("input_text"),
                      F.col(target_col).alias("target_text"))
            .dropna(subset=["input_text", "target_text"]))


def with_task_prefix(df: DataFrame, col: str = "input_text", prefix: str | None = None) -> DataFrame:
    """Put the task prefix (or ``prefix``) before ``col``, in place."""
    return df.withColumn(col, task_prefix(col) if prefix is None else task_prefix(col, prefix))


def first_n(df: DataFrame, order_cols, n: int | None) -> DataFrame:
    """First ``n`` rows by ``order_cols``; ``None`` = all, a negative ``n``
    leaves out the last ``-n`` (as a slice does).

    One plan at every size: the keys alone are ordered, the rows are then cut
    by a predicate (``first_by``). Rows that share the last key fill up to
    exactly ``n``.
    """
    if n is None:
        return df
    if n < 0:
        n = max(0, df.count() + n)
    if n == 0:
        return df.limit(0)
    return first_by(df, order_cols, n)


def row_at(df: DataFrame, order_col: str, index: int) -> DataFrame:
    """The row at 0-based position ``index`` in ``order_col`` order (0 or 1 row)."""
    if index < 0:
        raise IndexError("index must be >= 0")
    head = first_by(df, [order_col], index + 1)
    last = head.agg(F.max(order_col).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if last["n"] <= index:
        return df.limit(0)
    return head.where(F.col(order_col).eqNullSafe(F.lit(last["k"]))).limit(1)
