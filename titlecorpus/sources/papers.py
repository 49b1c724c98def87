"""Paper-shaped views over the driver tables.

``documents`` stands in for the paper corpus: title = text before the first
newline, abstract = text after it (NULL when there is none), categories =
``'<lang> <source>'``; there is no journal reference. ``pages`` gives a second
(abstract, title) source: the ``<title>`` element and the visible body text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.functions.text import normalize_ws


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers_from_documents(docs: DataFrame) -> DataFrame:
    """``documents`` as papers: first line = title, the rest = abstract."""
    text = F.col("text")
    nl = F.instr(text, "\n")
    return docs.select(
        F.col("doc_id").alias("id"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(nl > 0, text.substr(nl + 1, F.lit(2147483647))).alias("abstract"),
        F.lit(None).cast("string").alias("journal_ref"),
        F.concat_ws(" ", "lang", "source").alias("categories"),
    )


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``papers(id, title, abstract, journal_ref, categories)``."""
    return papers_from_documents(read_table(spark, sf_dir, "documents"))


def pairs_from_pages(pages: DataFrame) -> DataFrame:
    """(id, input_text, target_text) from raw HTML: body text -> abstract,
    ``<title>`` -> title. Scripts, styles and tags are removed by regex."""
    html = F.col("html")
    title = F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)
    body = F.regexp_extract(html, "(?is)<body[^>]*>(.*)</body>", 1)
    body = F.regexp_replace(body, "(?is)<script[^>]*>.*?</script>", " ")
    body = F.regexp_replace(body, "(?is)<style[^>]*>.*?</style>", " ")
    body = F.regexp_replace(body, "<[^>]*>", " ")
    return pages.select(
        F.col("page_id").alias("id"),
        normalize_ws(body).alias("input_text"),
        normalize_ws(title).alias("target_text"),
    )
