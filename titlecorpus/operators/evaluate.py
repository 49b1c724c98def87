"""Evaluation: held-out title loss (M5) and true vs predicted rows (M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlecorpus.functions.text import tokenize
from titlecorpus.operators.model import generate


def title_unigrams(train: DataFrame, target_col: str = "target_text") -> DataFrame:
    """(token, k): token counts over the training titles."""
    return (train.select(F.explode(tokenize(target_col)).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("k")))


def eval_loss(train: DataFrame, eval_rows: DataFrame, target_col: str = "target_text") -> DataFrame:
    """Mean -ln P(token) over eval title tokens under add-one unigrams of the
    training titles: P = (k + 1) / (T + V + 1); one row ``(eval_loss, n_tokens)``.

    Computed in one job: since -ln P = -ln(k + 1) + ln(T + V + 1), a single
    aggregation over the union of the training counts (giving T and V) and
    the eval tokens joined to them (giving sum m * ln(k + 1) and sum m) has
    everything. Both sides are aggregated by token before they meet, so the
    join moves one row per distinct token.
    """
    counts = title_unigrams(train, target_col)
    seen = (eval_rows.select(F.explode(tokenize(target_col)).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("m")))
    scored = seen.join(counts, "token", "left").select(
        F.lit(None).cast("long").alias("k"), "m",
        (F.col("m") * F.ln(F.coalesce("k", F.lit(0)) + 1)).alias("mlog"))
    both = counts.select("k", F.lit(None).cast("long").alias("m"),
                         F.lit(None).cast("double").alias("mlog")).unionByName(scored)
    t_plus_v = F.coalesce(F.sum("k"), F.lit(0)) + F.count("k")
    m_total = F.sum("m")
    loss = (-F.sum("mlog") / m_total) + F.ln(t_plus_v + 1)
    return both.agg(F.round(loss, 6).alias("eval_loss"),
                    F.coalesce(m_total, F.lit(0)).cast("long").alias("n_tokens"))


def _overlap():
    return F.size(F.array_intersect(tokenize("true_title"),
                                    F.coalesce(tokenize("predicted_title"),
                                               F.array().cast("array<string>"))))


def predict_side_by_side(eval_rows: DataFrame, model: DataFrame, max_length: int = 128,
                         n_model_rows: int | None = None) -> DataFrame:
    """Generate and compare in one plan: (id, true_title, predicted_title,
    abstract, overlap). The true title is carried through the scoring and
    the abstract is the scored text itself, so everything comes out of the
    generation's one id exchange (reused by its title join)."""
    pred = generate(eval_rows, model, max_length, n_model_rows=n_model_rows,
                    text_col="input_text", carry=("target_text",), text_as="abstract")
    return pred.select("id", F.col("target_text").alias("true_title"), "predicted_title",
                       "abstract", _overlap().alias("overlap"))


def side_by_side(eval_rows: DataFrame, predictions: DataFrame) -> DataFrame:
    """(id, true_title, predicted_title, abstract, overlap) where overlap is
    the number of distinct tokens the two titles share."""
    joined = eval_rows.join(predictions.select("id", "predicted_title"), "id", "left")
    overlap = F.size(F.array_intersect(tokenize("target_text"),
                                       F.coalesce(tokenize("predicted_title"),
                                                  F.array().cast("array<string>"))))
    return joined.select(
        "id",
        F.col("target_text").alias("true_title"),
        "predicted_title",
        F.col("input_text").alias("abstract"),
        overlap.alias("overlap"))
