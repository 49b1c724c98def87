"""Vocabulary and fixed-length id sequences (E1-E5).

Ids: 0 = padding, 1 = unknown token, 2.. = vocabulary by descending count,
ties by token. With a vocabulary that Spark
broadcasts, encoding explodes the (already truncated) token lists, joins it and
regroups by row id; the rows are hash-partitioned by id first, so the regrouping
needs no second shuffle. With a larger one, blocks of rows look their different
tokens up (``looked_up``): no row a token crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.functions.text import tokenize
from titlecorpus.operators.heavy import block_count, dealt, is_small, looked_up
from titlecorpus.operators.rank import global_rank

PAD_ID = 0
UNK_ID = 1
LABEL_IGNORE = -100


def build_vocab(df: DataFrame, text_cols, size: int | None = None) -> DataFrame:
    """(token, count, token_id) of all tokens, or the ``size`` most frequent."""
    toks = [tokenize(c) for c in text_cols]
    all_toks = toks[0] if len(toks) == 1 else F.concat(*toks)
    counts = (df.select(F.explode(all_toks).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("count")))
    ranked = global_rank(counts, [F.col("count").desc(), F.col("token")], "_rank")
    if size is not None:
        ranked = ranked.where(F.col("_rank") <= size)
    return ranked.select("token", "count", (F.col("_rank") + 1).cast("int").alias("token_id"))


def _pad(ids, length: int, value: int = PAD_ID):
    return F.concat(ids, F.array_repeat(F.lit(value), F.lit(length) - F.size(ids)))


def encode(df: DataFrame, vocab: DataFrame, input_col: str = "input_text",
           target_col: str = "target_text", input_len: int = 512, label_len: int = 128,
           mask_pad: bool = False, id_col: str = "id", keep=(),
           vocab_size: int | None = None) -> DataFrame:
    """(id, input_ids[input_len], labels[label_len]) with right padding.

    Tokens are cut to the length *before* the explode, so a row's fan-out is
    bounded. ``vocab_size`` is accepted and not needed: sizes are Spark's
    estimates. ``mask_pad`` turns padding in the labels into -100. ``keep``
    columns (functions of the id, e.g. the split name) are carried along as
    extra grouping keys, which the id partitioning already satisfies.
    """
    def toks(col, length):
        # A NULL text encodes like an empty one (all padding).
        return F.slice(tokenize(F.coalesce(F.col(col), F.lit(""))), 1, length)

    keep = list(keep)
    tokenized = df.select(F.col(id_col).alias("_id"), *keep, toks(input_col, input_len).alias("_in"),
                          toks(target_col, label_len).alias("_lab"))
    # Padding sits only on the right and real ids are never 0, so masking the
    # padding is padding with -100 directly.
    padded = [_pad(F.col("_in"), input_len).alias("input_ids"),
              _pad(F.col("_lab"), label_len, LABEL_IGNORE if mask_pad else PAD_ID).alias("labels")]
    table = vocab.select("token", "token_id")
    if not is_small(table):
        sides = tokenized.select("_id", *keep, F.array(F.array_join("_in", " "), F.array_join("_lab", " ")).alias("keys"))
        size = lambda col, length: F.coalesce(F.least(F.octet_length(col), F.lit(8 * length)), F.lit(0))
        blocks = dealt(sides, "_id", block_count(df, size(input_col, input_len) + size(target_col, label_len)))
        one = blocks.groupBy("_block", "_id", *keep).agg(F.flatten(F.collect_list("keys")).alias("keys"))
        found = looked_up(blocks, one, table, "token", "token_id")

        def merged(side):
            # Rows of one id merge: by position, then id.
            of_side = F.transform(F.filter("values", lambda v, i: i % 2 == side),
                                  lambda v: F.transform(v, lambda x, pos: F.struct(pos.alias("pos"), F.coalesce(x, F.lit(UNK_ID)).alias("tid"))))
            return F.when(F.size("values") == 2, F.transform(F.get("values", F.lit(side)), lambda x: F.coalesce(x, F.lit(UNK_ID)))) \
                .otherwise(F.array_sort(F.flatten(of_side)).getField("tid"))

        return found.select("_id", *keep, merged(0).alias("_in"), merged(1).alias("_lab")).select(F.col("_id").alias(id_col), *keep, *padded)
    # Inputs then labels in one array; the position tells the side apart.
    rows = tokenized.select("_id", *keep, F.concat("_in", "_lab").alias("_items"),
                            F.size("_in").alias("_n_in")).repartition("_id")
    exploded = rows.select("_id", *keep, "_n_in",
                           F.posexplode_outer("_items").alias("_p", "token"))
    is_label = F.col("_p") >= F.col("_n_in")
    # An empty text leaves one row with a NULL position: side stays NULL.
    exploded = exploded.select(
        "_id", *keep, "token",
        F.when(is_label, 1).when(~is_label, 0).alias("side"),
        F.when(is_label, F.col("_p") - F.col("_n_in")).otherwise(F.col("_p")).alias("pos"))
    joined = exploded.join(table, "token", "left")
    ids = joined.withColumn("tid", F.when(F.col("token").isNull(), F.lit(None))
                            .otherwise(F.coalesce("token_id", F.lit(UNK_ID))))

    def side_ids(side):
        picked = F.collect_list(F.when(F.col("side") == side, F.struct("pos", "tid")))
        # Sorted by position, then the id field of every element.
        return F.array_sort(picked).getField("tid")

    grouped = ids.groupBy("_id", *keep).agg(side_ids(0).alias("_in"), side_ids(1).alias("_lab"))
    return grouped.select(F.col("_id").alias(id_col), *keep, *padded)


def save_vocab(vocab: DataFrame, path: str) -> DataFrame:
    """Write the vocabulary and read it back: what was encoded with it can be decoded later."""
    vocab.write.mode("overwrite").parquet(path)
    return load_vocab(vocab.sparkSession, path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def decode(df: DataFrame, vocab: DataFrame, ids_col: str = "input_ids", id_col: str = "id",
           unknown: str | None = None, to: str = "text") -> DataFrame:
    """(id, text): the tokens of the ids, a space between. Padding and masked
    labels are left out, and unknown tokens too unless ``unknown`` names a text
    for them. Every row comes out; one without tokens has an empty text."""
    table = vocab.select("token", "token_id")
    given = df.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    if not is_small(table):
        ids = f"array<{dict(table.dtypes)['token_id']}>"
        keyed = given.select("_id", F.array(F.coalesce(F.col("_ids").cast(ids), F.array().cast(ids))).alias("keys"))
        blocks = dealt(keyed, "_id", block_count(given, 8 * F.size("_ids")))
        one = blocks.groupBy("_block", "_id").agg(F.flatten(F.collect_list("keys")).alias("keys")).withColumn("_ids", F.col("keys"))
        found = looked_up(blocks, one, table, "token_id", "token")
        name = lambda x, y: F.when(y == UNK_ID, F.lit(unknown)).when(y > UNK_ID, x)
        shown = F.zip_with("values", "_ids", lambda v, i: F.zip_with(v, i, name))
        merged = F.array_sort(F.flatten(F.transform("shown", lambda v: F.filter(F.transform(
            v, lambda x, pos: F.struct(pos.alias("pos"), x.alias("shown"))), lambda p: p["shown"].isNotNull())))).getField("shown")
        return found.select("_id", shown.alias("shown")).select(
            F.col("_id").alias(id_col), F.array_join(F.when(F.size("shown") == 1, F.get("shown", F.lit(0))).otherwise(merged), " ").alias(to))
    rows = given.repartition("_id")
    coded = rows.select("_id", F.posexplode_outer("_ids").alias("pos", "token_id"))
    coded = coded.withColumn("token_id", F.when(F.col("token_id") > UNK_ID, F.col("token_id")).when(F.col("token_id") == UNK_ID, UNK_ID))
    # Padding and unknown ids are no tokens: their rows have no key and match nothing.
    known = coded.withColumn("_unknown", F.col("token_id") == UNK_ID).withColumn("token_id", F.when(F.col("token_id") > UNK_ID, F.col("token_id")))
    named = known.join(table, "token_id", "left")
    shown = F.when(F.col("_unknown"), F.lit(unknown)).otherwise(F.col("token"))
    named = named.withColumn("shown", shown)
    picked = F.collect_list(F.when(F.col("shown").isNotNull(), F.struct("pos", "shown")))
    return named.groupBy("_id").agg(F.array_join(F.array_sort(picked).getField("shown"), " ").alias(to)).withColumnRenamed("_id", id_col)
