"""Train / evaluate flow on the papers table, and training shards.

table -> first N (id order) -> pairs -> seeded split -> fit counted model ->
save -> held-out loss -> side-by-side for k random eval rows. Shards: the
encoded pairs written per split (and per epoch batch plan) for an external
trainer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.operators import encode as enc
from titlecorpus.operators import model as mdl
from titlecorpus.operators.evaluate import eval_loss, side_by_side
from titlecorpus.operators.sampling import draw_with_replacement, epoch_batches
from titlecorpus.operators.select import pair_projection, with_task_prefix
from titlecorpus.operators.splits import first_k_of_split, split_fraction, split_three_way
from titlecorpus.session import work_path
from titlecorpus.operators.rank import file_order_rank
from titlecorpus.sources.files import read_dataset, read_split, write_splits
from titlecorpus.sources.table import first_papers


def training_pairs(spark: SparkSession, table_path: str, limit: int | None = None) -> DataFrame:
    """(id, input_text, target_text) of all papers, or the first ``limit``."""
    return pair_projection(first_papers(spark, table_path, limit))


def file_pairs(spark: SparkSession, filename: str, n_rows: int | None = None) -> DataFrame:
    """(id, input_text, target_text) from a CSV / Parquet export: rows are
    numbered 0.. in file order (from per-split counts, no shuffle), the first
    ``n_rows`` kept by predicate, then projected to pairs."""
    numbered = file_order_rank(read_dataset(spark, filename), "_pos")
    if n_rows is not None and n_rows >= 0:
        numbered = numbered.where(F.col("_pos") <= n_rows)
    return pair_projection(numbered.withColumn("id", F.col("_pos") - 1))


def train_and_evaluate(spark: SparkSession, pairs: DataFrame, model_path: str,
                       eval_frac: float = 0.1, seed=42, eval_rows: int | None = None,
                       n_show: int = 5, draw_seed=7, max_length: int = 128,
                       num_beams: int = 1, no_repeat_ngram_size: int = 0, prefix: str | None = None) -> dict:
    """Fit on the train part, score held-out rows. Returns ``{"totals",
    "eval_loss", "shown"}`` where ``shown`` is a DataFrame of true vs
    predicted titles for ``n_show`` draws (with replacement) of eval rows.

    The split is written once, partitioned by name, to the shared folder:
    every later step reads only its own part (partition pruning) instead of
    rescanning all pairs to re-derive it.
    """
    split_path = write_splits(split_fraction(pairs, eval_frac, seed), work_path(spark, "split"))
    train = read_split(spark, split_path, "train").drop("split")
    ev = read_split(spark, split_path, "eval").drop("split")
    totals = mdl.save_model(mdl.fit(train), model_path)
    tokens, totals = mdl.load_model(spark, model_path)
    scored = ev if eval_rows is None else first_k_of_split(
        read_split(spark, split_path, "eval"), eval_rows, seed).drop("split")
    loss = eval_loss(train, scored).first()
    picked = draw_with_replacement(ev, n_show, draw_seed, order_seed=seed)
    pred = _titles(picked, tokens, max_length, num_beams, no_repeat_ngram_size, prefix)
    shown = side_by_side(picked.select("draw", "id", "input_text", "target_text"), pred)
    return {"totals": totals, "eval_loss": loss["eval_loss"], "shown": shown}


def _titles(picked: DataFrame, tokens: DataFrame, max_length: int, num_beams: int, no_repeat_ngram_size: int,
            prefix: str | None) -> DataFrame:
    """Titles of the drawn rows, the best of the beams; ``prefix``: a task prefix before the inputs."""
    texts = picked.select("id", "input_text").dropDuplicates(["id"])
    texts = with_task_prefix(texts, prefix=prefix) if prefix is not None else texts
    pred = mdl.generate(texts, tokens, max_length, num_beams, no_repeat_ngram_size, text_col="input_text")
    return pred.where(F.coalesce(F.col("beam"), F.lit(1)) == 1).drop("beam") if num_beams > 1 else pred


def evaluate_saved_model(spark: SparkSession, pairs: DataFrame, model_path: str,
                         frac: float = 0.9, seed=42, n_show: int = 5, draw_seed=7,
                         max_length: int = 128, num_beams: int = 1, no_repeat_ngram_size: int = 0,
                         prefix: str | None = None) -> DataFrame:
    """Held-out check of a saved model: an exact ``frac`` sample of the pairs,
    ``n_show`` draws (with replacement) from it, true vs predicted titles."""
    tokens, totals = mdl.load_model(spark, model_path)
    sample = split_fraction(pairs, frac, seed, part="sample").where(F.col("split") == "sample") \
        .drop("split")
    picked = draw_with_replacement(sample, n_show, draw_seed, order_seed=seed)
    pred = _titles(picked, tokens, max_length, num_beams, no_repeat_ngram_size, prefix)
    return side_by_side(picked.select("draw", "id", "input_text", "target_text"), pred)


def write_training_shards(spark: SparkSession, pairs: DataFrame, out_path: str,
                          held_frac: float = 0.1, seed=42, vocab_size: int | None = None,
                          input_len: int = 512, label_len: int = 128, mask_pad: bool = False,
                          three_way: bool = False, prefix: str | None = None) -> DataFrame:
    """Encode all pairs with a vocabulary of the train part and write them
    partitioned by split (train / eval, or train / validation / test);
    ``prefix`` (e.g. the task prefix) is put before each input text.
    The vocabulary is stored in ``<out_path>_vocab``, where ``load_vocab``
    finds it for decoding or later encoding; returns it."""
    if prefix is not None:
        pairs = with_task_prefix(pairs, "input_text", prefix)
    split = (split_three_way(pairs, held_frac, seed) if three_way
             else split_fraction(pairs, held_frac, seed))
    vocab = enc.save_vocab(enc.build_vocab(split.where(F.col("split") == "train"), ["input_text", "target_text"],
                                           vocab_size), f"{out_path}_vocab")
    encoded = enc.encode(split, vocab, input_len=input_len, label_len=label_len,
                         mask_pad=mask_pad, keep=("split",), vocab_size=vocab_size)
    write_splits(encoded, out_path)
    return vocab


def batch_plan(train: DataFrame, epochs: int, batch_size: int, seed=42) -> DataFrame:
    """(epoch, id, position, batch_id) for every epoch of training."""
    return epoch_batches(train.select("id"), epochs, batch_size, seed)


def write_batch_plan(train: DataFrame, out_path: str, epochs: int, batch_size: int,
                     seed=42) -> str:
    """Write the batch plan as one folder per epoch (``epoch=<e>``)."""
    batch_plan(train, epochs, batch_size, seed).write.mode("overwrite") \
        .partitionBy("epoch").parquet(out_path)
    return out_path
