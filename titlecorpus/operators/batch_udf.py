"""Opt-in Python over rows: a batched user function (U1).

The only place where row data enters Python: Arrow batches through
``mapInPandas``. A user predictor runs per row with its own try/except, so
one failing record yields an error text, never a failed task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlecorpus.schema import PREDICTION_ERROR_PREFIX
from titlecorpus.session import ship_package


#: Handles of this Python process, by the key of the call that asked for them.
_HANDLES: dict[str, object] = {}


def worker_handle(key: str, setup: Callable[[], object]):
    """What ``setup`` returned in this Python worker: it runs once, the handle serves all later batches and tasks."""
    if key not in _HANDLES:
        _HANDLES[key] = setup()
    return _HANDLES[key]


def map_batches(df: DataFrame, fn: Callable, schema, setup: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``fn`` to every Arrow batch (columns in -> columns out).

    ``setup``: a factory for what is costly to make (a loaded model), run once
    per Python worker, not once a batch or task; ``fn`` then takes the batch
    and the handle. Both are shipped by value.
    """
    ship_package(df.sparkSession)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from titlecorpus.operators.batch_udf import worker_handle

        given = () if setup is None else (worker_handle(key, setup),)
        for pdf in batches:
            yield fn(pdf, *given)
    return df.mapInPandas(run, schema)


def word_counts(pdf: pd.DataFrame, text_col: str = "text", out_col: str = "n_words") -> pd.DataFrame:
    """Example batch function: whitespace-separated words per row."""
    n = pdf[text_col].map(lambda t: None if t is None else len(t.split()))
    return pdf.assign(**{out_col: n.astype("Int64")})


def predict_with(df: DataFrame, predict: Callable[[str], str] | None, text_col: str = "clean",
                 setup: Callable[[], Callable[[str], str]] | None = None) -> DataFrame:
    """``df`` (with ``error``, added if missing, NULL where the text is valid) plus
    ``predicted_title`` from a user predictor. Every row comes out once; a row
    that has an error, or whose prediction raises, has no title."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from titlecorpus.operators.batch_udf import worker_handle

        title_of = predict if setup is None else worker_handle(key, setup)
        for pdf in batches:
            titles, errors = [], []
            for text, error in zip(pdf[text_col], pdf["error"]):
                title = None
                if error is None:
                    try:
                        title = title_of(text)
                    except Exception as exc:  # noqa: BLE001 - per-record capture
                        error = f"{PREDICTION_ERROR_PREFIX}{exc}"
                titles.append(title)
                errors.append(error)
            yield pdf.assign(error=errors, predicted_title=titles)
    ship_package(df.sparkSession)
    if "error" not in df.columns:
        df = df.withColumn("error", F.lit(None).cast("string"))
    # Nullable integers reach pandas as objects, not as floats.
    numbers = [c for c, t in df.dtypes if t in ("bigint", "int", "smallint", "tinyint")]
    as_text = df.withColumns({c: df[c].cast("string") for c in numbers})
    fields = ", ".join([*(f"`{c}` {t}" for c, t in as_text.dtypes), "predicted_title string"])
    out = as_text.mapInPandas(run, fields)
    return out.withColumns({c: out[c].cast(dict(df.dtypes)[c]) for c in numbers})
