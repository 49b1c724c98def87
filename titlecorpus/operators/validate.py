"""Request validation and per-record error capture (P6, P7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlecorpus.functions.text import is_blank, strip_ws
from titlecorpus.schema import INVALID_INPUT_MESSAGE


def validate_requests(requests: DataFrame, text_col: str = "abstract") -> DataFrame:
    """Adds ``clean`` (stripped text, NULL when invalid) and ``error``
    (the invalid-input message, NULL when valid). The original text is kept."""
    bad = is_blank(text_col)
    return requests.withColumns({
        "clean": F.when(~bad, strip_ws(text_col)),
        "error": F.when(bad, F.lit(INVALID_INPUT_MESSAGE)),
    })
