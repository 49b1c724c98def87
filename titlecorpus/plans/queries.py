"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables. Queries that need files (JSON dump, CSV export, table, model, stream
input) write them with Spark under a fresh folder of the shared folder.
Model queries fit on the train part and score the eval part of the same
seeded split, so nothing is scored by a model fitted on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.operators import batch_udf, encode, evaluate, model, sampling, select, splits
from titlecorpus.operators.rank import file_order_rank
from titlecorpus.operators.validate import validate_requests
from titlecorpus.plans import corpus, fixtures
from titlecorpus.session import work_path
from titlecorpus.sources import files, jsonl, papers, table
from titlecorpus.streaming.predict import predict_batch_with, start_predict_stream

SEED = 42
DRAW_SEED = 7
EVAL_FRAC = 0.1
HELD_FRAC = 0.1
CATEGORY = "src1"
HEAD_N = 100
SAMPLE_N = 100
SCAN_LIMIT = 10
PAIRS_LIMIT = 100
RECORD_INDEX = 41
EVAL_FIRST_K = 5
DRAWS = 5
EPOCHS = 2
BATCH_SIZE = 4
INPUT_LEN = 512
LABEL_LEN = 128
UNKNOWN = "<unk>"
TITLE_LEN = 128
BEAM_TITLE_LEN = 50
BEAMS = 4


# -- shared inputs --------------------------------------------------------------
def _papers(spark: SparkSession, sf: str) -> DataFrame:
    return papers.papers(spark, sf)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return select.pair_projection(_papers(spark, sf))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.split_fraction(_pairs(spark, sf), EVAL_FRAC, SEED)


def _train_eval(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = _split(spark, sf)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "eval").drop("split"))


def _fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, dict, DataFrame, DataFrame]:
    train, ev = _train_eval(spark, sf)
    path = work_path(spark, "model")
    model.save_model(model.fit(train), path)
    tokens, totals = model.load_model(spark, path)
    return tokens, totals, train, ev


def _json_dump(spark: SparkSession, sf: str) -> str:
    """The documents as a JSON-lines dump (absent / null / present keys)."""
    return fixtures.write_json_dump(papers.read_table(spark, sf, "documents"),
                                    work_path(spark, "jsonl"))


# -- sources and sinks --------------------------------------------------------------
def q_json_extract_defaults(spark, sf):
    path = _json_dump(spark, sf)
    parsed = jsonl.parse_records(jsonl.read_json_lines(spark, path))
    return jsonl.extract_fields(file_order_rank(parsed, "line_no"), keep=("line_no",))


def q_json_select(spark, sf):
    path = _json_dump(spark, sf)
    return jsonl.load_arxiv_metadata(spark, path, HEAD_N, categories_filter=CATEGORY).drop(jsonl.RANK)


def q_json_count(spark, sf):
    path = _json_dump(spark, sf)
    return jsonl.match_count(spark, path, CATEGORY)


def q_corpus_build(spark, sf):
    path = _json_dump(spark, sf)
    tpath = work_path(spark, corpus.dataset_name(HEAD_N, CATEGORY))
    corpus.build_corpus(spark, path, tpath, HEAD_N, categories_filter=CATEGORY)
    return table.read_table(spark, tpath)


def q_csv_roundtrip(spark, sf):
    base = work_path(spark, "papers")
    path = files.save_dataset(_papers(spark, sf), base, "csv")
    return files.load_dataset(spark, path)


def q_csv_split_read(spark, sf):
    """The rows of CSV files in file order, each file read in splits."""
    base = work_path(spark, "ordered")
    src = _papers(spark, sf)
    path = files.save_dataset(src.repartitionByRange(fixtures.file_count(src), "id").sortWithinPartitions("id"), base, "csv")
    return file_order_rank(files.read_dataset(spark, path), "row_no").drop("_file", "_block", "_row")


def q_parquet_roundtrip(spark, sf):
    base = work_path(spark, "papers")
    path = files.save_dataset(_papers(spark, sf), base, "parquet")
    return files.load_dataset(spark, path)


def q_append_ids(spark, sf):
    path = work_path(spark, "table")
    src = _papers(spark, sf).withColumnRenamed("id", "doc_id")
    table.append_papers(spark, path, src, ["doc_id"])
    table.append_papers(spark, path, src, ["doc_id"])
    return table.read_table(spark, path)


def _thrice(spark, sf) -> tuple[str, int]:
    """A table of three appends of the papers, and the papers of one."""
    path = work_path(spark, "table")
    src = _papers(spark, sf).withColumnRenamed("id", "doc_id")
    return path, [table.append_papers(spark, path, src, ["doc_id"]) for _ in range(3)][0]


def q_table_first_n(spark, sf):
    path, n = _thrice(spark, sf)
    return table.first_papers(spark, path, n + HEAD_N)


def q_table_record_at(spark, sf):
    path, n = _thrice(spark, sf)
    return table.paper_by_position(spark, path, n + RECORD_INDEX)


def q_scan_limit(spark, sf):
    return table.fetch_papers(_papers(spark, sf), SCAN_LIMIT)


def q_pairs_limit(spark, sf):
    return table.fetch_papers_for_training(_papers(spark, sf), PAIRS_LIMIT)


def q_record_at(spark, sf):
    return table.paper_at(_papers(spark, sf), RECORD_INDEX)


def q_pages_pairs(spark, sf):
    return papers.pairs_from_pages(papers.read_table(spark, sf, "pages"))


# -- filters and projections ---------------------------------------------------------
def q_category_filter(spark, sf):
    return select.category_filter(_papers(spark, sf), CATEGORY)


def q_category_count(spark, sf):
    return select.category_count(_papers(spark, sf), CATEGORY)


def q_normalize_ws(spark, sf):
    docs = papers.read_table(spark, sf, "documents")
    return select.normalize_text(docs.select(F.col("doc_id").alias("id"), "text"), ["text"])


def q_pair_projection(spark, sf):
    return _pairs(spark, sf)


def q_task_prefix(spark, sf):
    return select.with_task_prefix(_pairs(spark, sf))


def q_validate_request(spark, sf):
    return validate_requests(_papers(spark, sf).select("id", "abstract"))


# -- limits, samples, splits -----------------------------------------------------------
def q_head_n(spark, sf):
    return select.first_n(_papers(spark, sf), ["id"], HEAD_N)


def q_sample_n(spark, sf):
    return sampling.sample_n(_papers(spark, sf), SAMPLE_N, SEED)


def q_sample_strict(spark, sf):
    return sampling.sample_n_strict(_papers(spark, sf), SAMPLE_N, SEED)


def q_direct_load(spark, sf):
    """The first lines of the dump, without a category, loaded into a table."""
    path = work_path(spark, "table")
    corpus.load_into_table(spark, _json_dump(spark, sf), path, HEAD_N)
    return table.read_table(spark, path)


def _ordered_export(spark, sf) -> str:
    """Parquet export whose files follow the ids."""
    src = _papers(spark, sf)
    return files.save_dataset(src.repartitionByRange(fixtures.file_count(src), "id").sortWithinPartitions("id"),
                              work_path(spark, "export"), "parquet")


def q_file_head(spark, sf):
    return files.load_dataset(spark, _ordered_export(spark, sf), HEAD_N)


def q_file_sample(spark, sf):
    return files.load_dataset(spark, _ordered_export(spark, sf), SAMPLE_N, random_select=True, seed=SEED)


def q_sample_n_reindexed(spark, sf):
    return sampling.sample_n_reindexed(_papers(spark, sf), SAMPLE_N, SEED)


def q_split_fraction(spark, sf):
    return _split(spark, sf)


def q_split_complement(spark, sf):
    s = _split(spark, sf)
    return splits.complement(s.drop("split"), s.where(F.col("split") == "eval"))


def q_split_three_way(spark, sf):
    return splits.split_three_way(_pairs(spark, sf), HELD_FRAC, SEED)


def q_split_read(spark, sf):
    path = files.write_splits(splits.split_three_way(_pairs(spark, sf), HELD_FRAC, SEED),
                              work_path(spark, "splits"))
    return files.read_split(spark, path, "validation")


def q_eval_first_k(spark, sf):
    return splits.first_k_of_split(_split(spark, sf), EVAL_FIRST_K, SEED)


def q_draw_with_replacement(spark, sf):
    _, ev = _train_eval(spark, sf)
    return sampling.draw_with_replacement(ev, DRAWS, DRAW_SEED, order_seed=SEED)


def q_batch_groups(spark, sf):
    train, _ = _train_eval(spark, sf)
    return sampling.epoch_batches(train.select("id"), EPOCHS, BATCH_SIZE, SEED)


# -- encoding ---------------------------------------------------------------------
def _vocab(spark, sf):
    train, _ = _train_eval(spark, sf)
    return encode.build_vocab(train, ["input_text", "target_text"])


def q_vocab(spark, sf):
    return _vocab(spark, sf)


def q_encode_padded(spark, sf):
    return encode.encode(_pairs(spark, sf), _vocab(spark, sf), input_len=INPUT_LEN,
                         label_len=LABEL_LEN)


def q_encode_masked_labels(spark, sf):
    return encode.encode(_pairs(spark, sf), _vocab(spark, sf), input_len=INPUT_LEN,
                         label_len=LABEL_LEN, mask_pad=True)


def q_decode_ids(spark, sf):
    """Encoded inputs decoded again: the first INPUT_LEN tokens, unknown ones marked."""
    pairs = _pairs(spark, sf)
    vocab = encode.save_vocab(_vocab(spark, sf), work_path(spark, "vocab"))
    path = work_path(spark, "encoded")
    encode.encode(pairs, vocab, input_len=INPUT_LEN, label_len=LABEL_LEN).write.parquet(path)
    return encode.decode(spark.read.parquet(path), vocab, unknown=UNKNOWN)


def q_sample_nine_tenths(spark, sf):
    return splits.split_fraction(_pairs(spark, sf), 0.9, SEED, part="sample").where(F.col("split") == "sample").drop("split")


def q_split_80_10_10(spark, sf):
    return splits.split_three_way(_pairs(spark, sf), 0.2, SEED)


def q_json_sample(spark, sf):
    """Random lines of the dump, drawn by line number."""
    return jsonl.load_arxiv_metadata(spark, _json_dump(spark, sf), SAMPLE_N, random_select=True, seed=SEED).withColumnRenamed(jsonl.RANK, "place")


def q_predict_with_failures(spark, sf):
    """A predictor that fails on some records: titles, error texts and invalid requests side by side."""
    requests = _papers(spark, sf).select("id", "abstract")
    return predict_batch_with(requests, first_words)


def first_words(text: str) -> str:
    words = text.split()
    if len(words) % 7 == 3:
        raise ValueError(f"{len(words)} words")
    return " ".join(words[:5])


# -- title model ---------------------------------------------------------------------
def q_model_fit(spark, sf):
    train, _ = _train_eval(spark, sf)
    return model.fit(train)


def q_predict_titles(spark, sf):
    tokens, totals, _, ev = _fitted(spark, sf)
    return model.generate(ev, tokens, TITLE_LEN, n_model_rows=totals["n_tokens"],
                          text_col="input_text")


def q_predict_topk(spark, sf):
    tokens, totals, _, ev = _fitted(spark, sf)
    return model.generate(ev, tokens, BEAM_TITLE_LEN, num_beams=BEAMS, no_repeat_ngram_size=2,
                          n_model_rows=totals["n_tokens"], text_col="input_text")


def q_eval_loss(spark, sf):
    train, ev = _train_eval(spark, sf)
    return evaluate.eval_loss(train, ev)


def q_side_by_side(spark, sf):
    tokens, totals, _, ev = _fitted(spark, sf)
    return evaluate.predict_side_by_side(ev, tokens, TITLE_LEN, n_model_rows=totals["n_tokens"])


def q_predict_conversations(spark, sf):
    """Titles for every conversation turn (long multi-sentence texts) from the
    model fitted on the documents' train split; key ``'<conv_id>:<turn>'``."""
    tokens, totals, _, _ = _fitted(spark, sf)
    turns = papers.read_table(spark, sf, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("id"), "role", "text")
    return model.generate(turns, tokens, TITLE_LEN, n_model_rows=totals["n_tokens"],
                          text_col="text", carry=("role",))


# -- stream and user functions -----------------------------------------------------------
def q_stream_predict(spark, sf):
    tokens, totals, _, _ = _fitted(spark, sf)
    src = work_path(spark, "requests")
    n_files = fixtures.write_requests(papers.read_table(spark, sf, "documents"), src)
    out, chk = work_path(spark, "predictions"), work_path(spark, "stream-checkpoint")
    # About four micro-batches at any data size.
    q = start_predict_stream(spark, src, tokens, totals["n_tokens"], out, chk,
                             max_length=TITLE_LEN, max_files_per_trigger=max(1, n_files // 4))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out).drop("batch_id")


def q_map_batches(spark, sf):
    docs = papers.read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return batch_udf.map_batches(docs, batch_udf.word_counts, "id long, text string, n_words long") \
        .select("id", "n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_extract_defaults": q_json_extract_defaults,
    "json_select": q_json_select,
    "json_count": q_json_count,
    "corpus_build": q_corpus_build,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_split_read": q_csv_split_read,
    "direct_load": q_direct_load,
    "file_head": q_file_head,
    "file_sample": q_file_sample,
    "sample_strict": q_sample_strict,
    "table_first_n": q_table_first_n,
    "table_record_at": q_table_record_at,
    "parquet_roundtrip": q_parquet_roundtrip,
    "append_ids": q_append_ids,
    "scan_limit": q_scan_limit,
    "pairs_limit": q_pairs_limit,
    "record_at": q_record_at,
    "pages_pairs": q_pages_pairs,
    "category_filter": q_category_filter,
    "category_count": q_category_count,
    "normalize_ws": q_normalize_ws,
    "pair_projection": q_pair_projection,
    "task_prefix": q_task_prefix,
    "validate_request": q_validate_request,
    "head_n": q_head_n,
    "sample_n": q_sample_n,
    "sample_n_reindexed": q_sample_n_reindexed,
    "split_fraction": q_split_fraction,
    "split_complement": q_split_complement,
    "split_three_way": q_split_three_way,
    "split_read": q_split_read,
    "eval_first_k": q_eval_first_k,
    "draw_with_replacement": q_draw_with_replacement,
    "batch_groups": q_batch_groups,
    "vocab": q_vocab,
    "encode_padded": q_encode_padded,
    "encode_masked_labels": q_encode_masked_labels,
    "decode_ids": q_decode_ids,
    "sample_nine_tenths": q_sample_nine_tenths,
    "split_80_10_10": q_split_80_10_10,
    "json_sample": q_json_sample,
    "predict_with_failures": q_predict_with_failures,
    "model_fit": q_model_fit,
    "predict_titles": q_predict_titles,
    "predict_topk": q_predict_topk,
    "predict_conversations": q_predict_conversations,
    "eval_loss": q_eval_loss,
    "side_by_side": q_side_by_side,
    "stream_predict": q_stream_predict,
    "map_batches": q_map_batches,
}

