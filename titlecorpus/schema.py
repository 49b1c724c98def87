"""Schemas and fixed values of the paper corpus."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the behaviour being reproduced.
# Text stored for a key that is absent from a JSON record:
DEFAULT_TITLE = "No title available"
DEFAULT_ABSTRACT = "No abstract available"
DEFAULT_JOURNAL_REF = "No journal reference available"
DEFAULT_CATEGORIES = "No categories available"
# Error texts of the request path:
INVALID_INPUT_MESSAGE = "Invalid input. Please enter a valid abstract as text."
PREDICTION_ERROR_PREFIX = "Error during prediction: "
# Task prefix used for text-to-text training rows:
TASK_PREFIX = "summarize: "
# Name of a built corpus, from its size and category filter (None prints as "None"):
DATASET_NAME_FORMAT = "arxiv_papers_{n}n_{category}_cat"
# Name of a model saved without a name (its creation date):
MODEL_NAME_DATE_FORMAT = "%Y-%m-%d"
# Record display: heading, field labels in order, and the separator line.
DISPLAY_HEADING = "Paper {number}"
DISPLAY_LABELS = (("title", "Title"), ("abstract", "Abstract"),
                  ("journal_ref", "Journal Reference"), ("categories", "Categories"))
DISPLAY_SEPARATOR = "-" * 80
# Cells read as missing by pandas 2.3 CSV parsing (its default NA set):
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# JSON key -> column name, in output order.
JSON_FIELDS = (
    ("title", "title", DEFAULT_TITLE),
    ("abstract", "abstract", DEFAULT_ABSTRACT),
    ("journal-ref", "journal_ref", DEFAULT_JOURNAL_REF),
    ("categories", "categories", DEFAULT_CATEGORIES),
)

TEXT_FIELDS = ("title", "abstract", "journal_ref", "categories")

PAPER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("journal_ref", T.StringType(), True),
    T.StructField("categories", T.StringType(), True),
])

# File layout of a corpus export: the table without its key.
PAPER_FILE_SCHEMA = T.StructType([f for f in PAPER_SCHEMA.fields if f.name != "id"])

PAIR_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("input_text", T.StringType(), True),
    T.StructField("target_text", T.StringType(), True),
])
