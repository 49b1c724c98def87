"""CSV and Parquet exports of a corpus, suffix-dispatched loading, named splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.operators.rank import FILE_ORDER, HashOrder, file_order_rank, hash_rank, with_file_order
from titlecorpus.schema import NA_TOKENS, PAPER_FILE_SCHEMA
from titlecorpus.sources.csv_split import read_csv_splits

# CSV layout that reads back cell for cell: quoted fields may hold newlines
# and doubled quotes; empty strings are written as empty cells.
_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def save_dataset(df: DataFrame, filename_base: str, type: str = "csv",
                 mode: str = "errorifexists") -> str:
    """Write ``<base>.csv`` or ``<base>.parquet`` (a folder of part files)."""
    cols = [f.name for f in PAPER_FILE_SCHEMA.fields if f.name in df.columns] or df.columns
    out = df.select(*cols)
    if type == "csv":
        path = f"{filename_base}.csv"
        out.write.mode(mode).options(**_CSV_OPTIONS).csv(path)
    elif type == "parquet":
        path = f"{filename_base}.parquet"
        out.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"Unsupported output type {type!r}: use 'csv' or 'parquet'.")
    return path


def null_tokens(df: DataFrame, cols) -> DataFrame:
    """Cells holding one of the missing-value tokens become NULL."""
    tokens = list(NA_TOKENS)
    return df.withColumns({c: F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def read_dataset(spark: SparkSession, filename: str, schema=PAPER_FILE_SCHEMA, whole_files: bool = False) -> DataFrame:
    """Scan by suffix, with the file-order key of each row.

    A CSV file is read in splits, however large (``csv_split``);
    ``whole_files`` gives each file to one task of Spark's parser instead.
    """
    if filename.endswith(".csv"):
        # Columns are bound by the names in the header; a file of the folder
        # whose header differs is an error, never a silent swap.
        raw = (spark.read.options(**_CSV_OPTIONS).option("multiLine", "true")
               .option("enforceSchema", "false").csv(filename))
        missing = [f.name for f in schema.fields if f.name not in raw.columns]
        if missing:
            raise ValueError(f"{filename} has no column {', '.join(missing)}")
        order = [F.col(c) for c in FILE_ORDER]
        tagged = with_file_order(raw) if whole_files else read_csv_splits(spark, filename, raw.columns, _CSV_OPTIONS)
        named = tagged.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields), *order)
        return null_tokens(named, [f.name for f in schema.fields])
    if filename.endswith(".parquet"):
        return with_file_order(spark.read.parquet(filename))
    raise ValueError("Unsupported file format. Please use a .csv or .parquet file.")


def load_dataset(spark: SparkSession, filename: str, n_rows: int | None = None,
                 random_select: bool = False, seed=42) -> DataFrame:
    """All rows, the first ``n_rows`` in file order, or exactly ``n_rows``
    seeded random rows (strict: more than available raises) numbered
    ``index`` 0..n-1 in draw order."""
    df = read_dataset(spark, filename)
    data_cols = [c for c in df.columns if c not in FILE_ORDER]
    if n_rows is None:
        return df.select(*data_cols)
    numbered = file_order_rank(df, "_pos")
    if not random_select:
        # Rows numbered in file order from per-split counts, a prefix kept by predicate.
        if n_rows < 0:  # as a slice: all but the last
            n_rows = max(0, numbered.count() + n_rows)
        return numbered.where(F.col("_pos") <= n_rows).select(*data_cols)
    order = HashOrder(numbered, "_pos", seed)
    if n_rows > order.count():
        raise ValueError(f"Cannot take a sample of {n_rows} from {order.count()} rows")
    picked = hash_rank(numbered.where(order.cut(n_rows)), "_pos", seed, "index")
    return picked.select((F.col("index") - 1).alias("index"), *data_cols)


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> str:
    """One folder per split name (``split=train`` ...)."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, name: str, split_col: str = "split") -> DataFrame:
    """One named split; the predicate prunes partitions at planning time."""
    return spark.read.parquet(path).where(F.col(split_col) == F.lit(name))
