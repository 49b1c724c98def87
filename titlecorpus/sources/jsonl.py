"""JSON-lines corpus scan (one paper per line) with the three field states.

A field can be absent (-> fixed default text), JSON ``null`` (-> NULL) or
present (-> its value). ``from_json`` and ``get_json_object`` both return
NULL for absent *and* null, so presence is read from ``json_object_keys``.
A blank or malformed line aborts the job, as a strict line parser would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlecorpus.operators.rank import HashOrder, file_order_rank, hash_rank, with_file_order
from titlecorpus.operators.select import category_filter
from titlecorpus.schema import JSON_FIELDS

JSON_RECORD = T.StructType([T.StructField(k, T.StringType(), True) for k, _, _ in JSON_FIELDS])

RANK = "_rank"


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the dump with their file-order key (file, split, row)."""
    return with_file_order(spark.read.text(path))


def parse_records(lines: DataFrame) -> DataFrame:
    """Parse every line once into ``_rec`` (struct) and ``_keys`` (key list)."""
    keys = F.json_object_keys("value")
    bad = F.raise_error(F.concat(F.lit("Malformed JSON line: "), F.coalesce(F.col("value"), F.lit(""))))
    return lines.select(
        "*",
        F.from_json("value", JSON_RECORD, {"mode": "FAILFAST"}).alias("_rec"),
        F.when(keys.isNull(), bad).otherwise(keys).alias("_keys"),
    )


def field(json_key: str, default: str) -> Column:
    """Value of a key: the default text when absent, NULL when JSON null."""
    present = F.array_contains(F.col("_keys"), F.lit(json_key))
    return F.when(present, F.col("_rec").getField(json_key)).otherwise(F.lit(default))


def checked_categories() -> Column:
    """Categories of a parsed line; reading it validates the line first, so
    a filter cannot skip a blank or malformed line silently."""
    return F.when(F.col("_keys").isNotNull(), F.col("_rec.categories"))


def extract_fields(parsed: DataFrame, keep=()) -> DataFrame:
    """The four paper fields of parsed lines (plus ``keep`` columns)."""
    cols = [field(k, d).alias(name) for k, name, d in JSON_FIELDS]
    return parsed.select(*keep, *cols)


def load_arxiv_metadata(spark: SparkSession, path: str, n_papers: int | None = None,
                        random_select: bool = False, categories_filter: str | None = None,
                        seed=42, strict: bool = False,
                        observation: Observation | None = None) -> DataFrame:
    """Filter by category, take the first or a seeded random N, extract.

    ``observation`` (optional) receives ``n_found``, the number of lines that
    passed the filter, from the same job that reads them: the selection is a
    predicate over the whole scan, never an early-stopping limit, so the
    count is exact.

    Output: ``title, abstract, journal_ref, categories, _rank`` where
    ``_rank`` numbers the selected papers 1..n in selection order (file
    order, or the seeded random order). File order is numbered after the
    filter from per-split counts, so neither form shuffles the lines; a
    random pick ranks only the picked rows.
    """
    parsed = parse_records(read_json_lines(spark, path))
    if categories_filter:
        parsed = category_filter(parsed, categories_filter, checked_categories())
    if observation is not None:
        parsed = parsed.observe(observation, F.count(F.lit(1)).alias("n_found"))
    if random_select and n_papers is not None:
        # A line's number among the lines that passed: the same for any split size or core count.
        numbered = file_order_rank(parsed.withColumn("_row", F.monotonically_increasing_id()), "_line_no")
        order = HashOrder(numbered, "_line_no", seed)
        if strict and n_papers > order.count():
            raise ValueError(f"Cannot take {n_papers} papers from {order.count()} lines")
        selected = hash_rank(numbered.where(order.cut(n_papers)), "_line_no", seed, RANK)
    else:
        # Number the lines that passed the filter: row index re-taken above
        # the filter, offsets from per-split counts.
        renumbered = parsed.withColumn("_row", F.monotonically_increasing_id())
        selected = file_order_rank(renumbered, RANK)
        if n_papers is not None:
            if n_papers < 0:  # as a slice: all but the last
                n_papers = max(0, selected.count() + n_papers)
            selected = selected.where(F.col(RANK) <= n_papers)
    return extract_fields(selected, keep=(RANK,))


def match_count(spark: SparkSession, path: str, categories_filter: str) -> DataFrame:
    """Number of lines whose categories contain the filter (one row)."""
    parsed = parse_records(read_json_lines(spark, path))
    return category_filter(parsed, categories_filter, checked_categories()).agg(
        F.count(F.lit(1)).alias("n_found"))
