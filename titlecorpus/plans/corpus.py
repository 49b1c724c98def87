"""Corpus build: JSON-lines dump -> filter -> first / random N -> papers table.

One lazy plan per step: filter, selection and numbering run on executors in
the scan stage. File order is numbered from per-split counts (no shuffle of
the lines); a random pick shuffles only the picked rows, by hash bucket.
"""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession

from titlecorpus.schema import DATASET_NAME_FORMAT
from titlecorpus.sources.jsonl import RANK, load_arxiv_metadata
from titlecorpus.sources.table import append_papers, first_papers, show_papers


def dataset_name(n_papers: int | None, category: str | None) -> str:
    """Name of a built corpus, from its parameters."""
    return DATASET_NAME_FORMAT.format(n=n_papers, category=category)


def build_corpus(spark: SparkSession, jsonl_path: str, table_path: str,
                 n_papers: int | None = None, random_select: bool = False,
                 categories_filter: str | None = None, seed=42, strict: bool = False,
                 print_result: int = 0) -> dict:
    """Select papers from the dump and append them to the table.

    Returns ``{"inserted": rows written, "found": lines matching the filter
    (None without a filter), "display": text of the first print_result
    papers of the table}``; asking to display more papers than the table
    holds raises after the rows are stored.
    """
    found = Observation("found") if categories_filter else None
    selected = load_arxiv_metadata(spark, jsonl_path, n_papers, random_select,
                                   categories_filter, seed, strict, observation=found)
    inserted = append_papers(spark, table_path, selected, rank_col=RANK)
    display = show_papers(first_papers(spark, table_path, print_result), print_result) if print_result else ""
    return {"inserted": inserted, "found": found.get["n_found"] if found else None,
            "display": display}


def load_into_table(spark: SparkSession, jsonl_path: str, table_path: str, n_papers: int,
                    random_select: bool = False, seed=42) -> int:
    """Direct load without a category filter; a random N larger than the
    dump is an error. Returns the true number of rows written."""
    return build_corpus(spark, jsonl_path, table_path, n_papers, random_select,
                        None, seed, strict=True)["inserted"]
