"""Counted title model: fit, save / load, generate (M1-M4).

Content selection by counts (Banko, Mittal & Witbrock, ACL 2000): for each
token, how often a paper whose abstract has it also has it in the title.
The weight is an integer, ``floor(1e6 * (n_both + 0.5) / (n_abs + 1))``, so
sums do not depend on the order of addition. A title is the sentence span
of the abstract (or the window of ``max_length`` tokens of a longer one) with
the highest mean weight; ties go to the earlier one.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from titlecorpus.functions.text import SPAN_SPLIT, tokenize
from titlecorpus.operators.heavy import block_count, dealt, is_small, looked_up
from titlecorpus.schema import MODEL_NAME_DATE_FORMAT
from titlecorpus.sources import manifest


def weight_expr(n_both: str, n_abs: str):
    """floor(1e6 * (n_both + 0.5) / (n_abs + 1)) in exact integer arithmetic."""
    return F.expr(f"(2000000 * {n_both} + 1000000) div (2 * {n_abs} + 2)")


def fit(pairs: DataFrame, input_col: str = "input_text", target_col: str = "target_text") -> DataFrame:
    """(token, n_abs, n_both, weight) over the given (abstract, title) rows.

    One explode of each abstract's distinct tokens and one aggregation by
    token; partial (map-side) counts absorb very frequent tokens.
    """
    # Both lists hold distinct tokens: those of the abstract, then those of
    # them that the title has too (a hash-based intersection).
    per_paper = pairs.select(F.array_distinct(tokenize(input_col)).alias("a"), tokenize(target_col).alias("t"))
    both = per_paper.select(F.size("a").alias("n"), F.concat("a", F.array_intersect("a", F.coalesce("t", F.array().cast("array<string>")))).alias("x"))
    occ = both.select("n", F.posexplode("x").alias("p", "token"))
    counts = occ.groupBy("token").agg(F.count_if(F.col("p") < F.col("n")).alias("n_abs"),
                                      F.count_if(F.col("p") >= F.col("n")).alias("n_both"))
    return counts.withColumn("weight", weight_expr("n_both", "n_abs"))


def default_model_name(now: datetime | None = None) -> str:
    """Name of a model saved without one: its creation date."""
    return (now or datetime.now()).strftime(MODEL_NAME_DATE_FORMAT)


def save_model(model: DataFrame, path: str, vocab: DataFrame | None = None) -> dict:
    """Write the token table (and the vocabulary) as a new version; returns the totals.

    The parts lie under fresh names; the manifest that names them, with the
    totals, is published last. Whoever loads the model gets the parts of one
    version, whenever a writer stops.
    """
    spark = model.sparkSession
    after = max(manifest.versions(spark, path), default=0)
    name = uuid.uuid4().hex
    # Totals are observed while the rows are written: no second pass.
    obs = Observation("model_totals")
    model.observe(obs, F.count(F.lit(1)).alias("n_tokens")).write.parquet(f"{path}/tokens-{name}")
    parts = {"tokens": f"tokens-{name}"}
    if vocab is not None:
        vocab.write.parquet(f"{path}/vocab-{name}")
        parts["vocab"] = f"vocab-{name}"
    totals = {k: int(v) for k, v in obs.get.items()}
    manifest.publish(spark, path, {"parts": parts, "totals": totals}, after)
    return totals


def model_version(spark: SparkSession, path: str) -> int:
    """The newest version of a saved model (0: none)."""
    return max(manifest.versions(spark, path), default=0)


def load_part(spark: SparkSession, path: str, part: str, version: int | None = None) -> tuple[DataFrame, dict]:
    """(part, totals) of one version of a saved model, the newest unless given: ``tokens`` or ``vocab``."""
    _, state = manifest.load(spark, path, version)
    if state is None or part not in state["parts"]:
        raise FileNotFoundError(f"{path} holds no {part} of a model")
    return spark.read.parquet(f"{path}/{state['parts'][part]}"), state["totals"]


def load_model(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, dict]:
    """(token table, totals) of a model written by ``save_model``."""
    return load_part(spark, path, "tokens", version)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _window_tokens(text: Column, span_pos: Column, part: Column, max_length: int) -> Column:
    """Tokens of window ``part`` (of ``max_length`` tokens) of span ``span_pos`` (both 0-based) of ``text``."""
    span = F.element_at(F.split(text, SPAN_SPLIT), span_pos + 1)
    return F.slice(tokenize(span), part * max_length + 1, max_length)


def row_key(df: DataFrame) -> Column:
    """MD5 of all columns of a row, each with its length: tells apart rows that share an id, or have none."""
    fields = (F.col(f"`{c}`").cast("string") for c in df.columns)
    return F.md5(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in fields)))


def _repeats(toks: Column) -> Column:
    """Whether a pair of adjacent tokens (the list zipped with itself shifted by one) occurs twice."""
    m = F.greatest(F.size(toks) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(toks, 1, m), F.slice(toks, 2, m))
    return F.size(F.array_distinct(pairs)) < F.size(pairs)


def span_scores(rows: DataFrame, model: DataFrame, max_length: int = 128,
                no_repeat_ngram_size: int = 0, n_model_rows: int | None = None,
                carry=()) -> DataFrame:
    """(_key, span_pos, part, score) for every window of every span of every
    row of ``rows`` (partitioned by ``_key``). A span longer than
    ``max_length`` tokens is cut into windows, which are candidates each.
    ``score`` is NULL for a window without usable tokens; every row keeps at
    least one, so no row is lost.

    With a model that Spark broadcasts, explode, weight join and the (sum, count)
    hash aggregation stay inside the partitions; with a larger one, blocks of
    rows look up their different tokens (``block_scores``). ``n_model_rows`` is
    accepted and not needed: sizes are Spark's estimates. No token array is
    carried past the explode. ``carry`` names small columns (functions of the key) kept as extra grouping keys.
    Equal rows share a key; their tokens add to sum and count alike, which
    leaves the mean.
    """
    carry = list(carry)
    spans = rows.select("_key", *carry,
                        F.posexplode_outer(F.split("text", SPAN_SPLIT)).alias("span_pos", "span"))
    every = spans.select("_key", *carry, "span_pos", tokenize("span").alias("all"))
    last = F.greatest(F.lit(0), F.floor((F.size("all") - 1) / F.lit(max_length)).cast("int"))
    toks = every.select("_key", *carry, "span_pos", "all", F.explode(F.sequence(F.lit(0), last)).alias("part")).select(
        "_key", *carry, "span_pos", "part", F.slice("all", F.col("part") * max_length + 1, max_length).alias("toks"))
    if no_repeat_ngram_size == 2:
        # A window repeating a pair is not a candidate.
        toks = toks.withColumn("toks", F.when(_repeats(F.col("toks")), F.array().cast("array<string>"))
                               .otherwise(F.col("toks")))
    elif no_repeat_ngram_size:
        raise ValueError("no_repeat_ngram_size must be 0 or 2")
    tokens = toks.select("_key", *carry, "span_pos", "part", F.explode_outer("toks").alias("token"))
    window = ["_key", "span_pos", "part", *carry]
    weights = model.select("token", "weight")
    n = F.count("token")
    return tokens.join(weights, "token", "left").groupBy(*window).agg(F.when(n > 0, F.sum(F.coalesce("weight", F.when(F.col("token").isNotNull(), 0))) / n).alias("score"))


def block_scores(rows: DataFrame, model: DataFrame, max_length: int = 128, no_repeat_ngram_size: int = 0) -> DataFrame:
    """(_key, scores) of the different keys of ``rows`` (_key, text): structs of ``score``, ``span_pos`` and ``part`` as ``span_scores`` gives them.

    For a model too large to broadcast: the text crosses the network once and
    the different tokens of a block of rows twice (``looked_up``).
    """
    spans = F.transform(F.coalesce(F.split("text", SPAN_SPLIT), F.array(F.lit(None).cast("string"))), lambda s: F.coalesce(tokenize(s), F.array().cast("array<string>")))
    parts = lambda n: F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((n - 1) / F.lit(max_length)).cast("int")))
    windows = F.flatten(F.transform("_spans", lambda s, i: F.transform(parts(F.size(s)), lambda p: F.struct(
        i.alias("span_pos"), p.alias("part"), F.slice(s, p * max_length + 1, max_length).alias("toks")))))
    if no_repeat_ngram_size not in (0, 2):
        raise ValueError("no_repeat_ngram_size must be 0 or 2")
    usable = lambda w: w["toks"] if not no_repeat_ngram_size else F.when(~_repeats(w["toks"]), w["toks"]).otherwise(F.array().cast("array<string>"))
    keyed = rows.select("_key", spans.alias("_spans")).select("_key", windows.alias("_windows")).select(
        "_key", F.transform("_windows", lambda w: F.struct(w["span_pos"].alias("span_pos"), w["part"].alias("part"))).alias("_places"),
        F.transform("_windows", lambda w: F.array_join(usable(w), " ")).alias("keys"))
    blocks = dealt(keyed, "_key", block_count(rows, F.octet_length("text")))
    found = looked_up(blocks, blocks.dropDuplicates(["_block", "_key"]), model.select("token", "weight"), "token", "weight")
    total = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("long")))
    return found.select("_key", F.zip_with("values", "_places", lambda v, at: F.struct(
        F.when(F.size(v) > 0, total(v) / F.size(v)).alias("score"), at["span_pos"].alias("span_pos"), at["part"].alias("part"))).alias("scores"))


def best_windows(scores: DataFrame, k: int) -> DataFrame:
    """(_key, span_pos, part, score, beam) of the ``k`` best windows of each row of ``block_scores``; a row without a scored one keeps its first."""
    first = lambda x: F.struct((-F.coalesce(x["score"], F.lit(-1.0))).alias("low"), x["span_pos"].alias("span_pos"), x["part"].alias("part"), x["score"].alias("score"))
    ranked = scores.select("_key", F.slice(F.array_sort(F.transform("scores", first)), 1, k).alias("best"))
    best = ranked.select("_key", F.posexplode("best").alias("place", "w")).select(
        "_key", "w.span_pos", "w.part", "w.score", (F.col("place") + 1).alias("beam"))
    return best.where(F.col("score").isNotNull() | (F.col("beam") == 1))


def generate(abstracts: DataFrame, model: DataFrame, max_length: int = 128,
             num_beams: int = 1, no_repeat_ngram_size: int = 0,
             n_model_rows: int | None = None, id_col: str = "id",
             text_col="abstract", keep: dict | tuple = (), carry=(),
             text_as: str | None = None) -> DataFrame:
    """Best window per row: (id, *keep, *carry, [text_as], predicted_title,
    score); NULL title and score for rows without any usable token.
    ``num_beams`` > 1 keeps the k best per row (column ``beam``).

    Rows are told apart by all their columns (``row_key``), not by the id:
    repeated and NULL ids each get the title of their own text, and as many
    rows come out as go in (times the beams).

    ``text_col`` and the ``keep`` columns (names, or a name -> Column dict)
    are evaluated *after* the one hash-partitioning of the raw input rows by
    key. The scoring branch and the title branch read the same exchange
    (Spark reuses it), so the text crosses the network once; the best windows
    are picked over window-level rows inside the partitions, and their tokens
    are rebuilt from the text through a hash join. ``carry`` names small
    input columns to output as well: they ride along the scoring as grouping
    keys, as the id does, so both branches read the very same exchange.
    ``text_as`` also outputs the scored text under that name.
    """
    keep = dict(keep) if isinstance(keep, dict) else {k: F.col(k) for k in keep}
    base = abstracts.withColumn("_key", row_key(abstracts)).repartition("_key")
    carry = list(carry)
    rows = base.select("_key", F.col(id_col).alias("id"), _col(text_col).alias("text"), *carry, *(c.alias(n) for n, c in keep.items()))
    scored = F.col("score").isNotNull()
    if is_small(model.select("token", "weight")):
        scores = span_scores(rows, model, max_length, no_repeat_ngram_size, n_model_rows, ["id", *carry])
        w = Window.partitionBy("_key").orderBy(F.col("score").desc_nulls_last(), F.col("span_pos"), F.col("part"))
        ranked = scores.withColumn("beam", F.row_number().over(w))
        # Up to k scored windows; a row with none keeps one NULL entry.
        best = ranked.where(((F.col("beam") <= max(num_beams, 1)) & scored)
                            | ((F.col("beam") == 1) & ~scored)).drop("id", *carry)
    else:
        keyed = abstracts.withColumn("_key", row_key(abstracts)).select("_key", _col(text_col).alias("text"))
        best = best_windows(block_scores(keyed, model, max_length, no_repeat_ngram_size), max(num_beams, 1))
    titled = rows.join(best.hint("shuffle_hash"), "_key", "left")
    title = F.array_join(_window_tokens(F.col("text"), F.col("span_pos"), F.col("part"), max_length), " ")
    cols = ["id", *keep, *carry, *([F.col("text").alias(text_as)] if text_as else []),
            F.when(scored, title).alias("predicted_title"), "score"]
    if num_beams > 1:
        cols.append(F.when(scored, F.col("beam")).alias("beam"))
    return titled.select(*cols)
