"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised and closed by an end token; only longer ones than a
sequence are cut, the remainder first. Which fillings to use is decided on the
histogram of piece lengths (at most ``capacity`` rows reach the driver) by bin
completion (``bins``); the pieces then take the places of their length by their
rank in it. Ranks are exact and spread: row numbers within (block, length),
blocks by a hash of the document, plus the counts of the blocks before.

Defined results: a NULL text is an empty one (the end token alone); repeated
rows are packed each; without documents there are no sequences. Other columns
of the input are not read.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlecorpus.llm.bins import pack_sizes
from titlecorpus.llm.common import steps, stored, table

CAPACITY, END = 1024, 2
#: Pieces of a block, about: no window of a rank is larger.
BLOCK_ROWS = 4096
SPACES = r"[\pZ\x09-\x0D\x1c-\x1f\x{85}]"
#: White space next to white space, or a NUL: such a text is encoded whole.
UNSAFE = SPACES + SPACES + r"|\x00"
#: Words of which a task keeps the ids; beyond that it starts anew (this bounds memory, not results).
KEPT_WORDS = 1_000_000
#: Words encoded as one text, a line feed between.
JOINED = 2000


@cache
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


class Words:
    """Ids of words: a number for each word, and for each number where its ids lie in ``store``."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.between = self.tokenizer.token_to_id("\u010a")  # the line feed in the byte alphabet
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start = self.size = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    def numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > KEPT_WORDS:
            self.clear()
            new = words
        if new:
            self.learn(new)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def learn(self, words: list[str]) -> None:
        """Encode many words as one text. A line feed between two words is a token of its own unless white space touches it."""
        alone = [w for w in words if not w or w[-1:].isspace() or "\n" in w or w[0] != " " and w[0].isspace()]
        odd = set(alone)
        joined = [w for w in words if w not in odd]
        groups = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)]
        stores, sizes = [self.store], [self.size]
        for e in self.tokenizer.encode_batch(["\n".join(g) for g in groups] + alone, add_special_tokens=False):
            ids = np.array(e.ids, np.int32)
            if len(sizes) <= len(groups):
                at = np.concatenate([[-1], np.flatnonzero(ids == self.between), [len(ids)]])
                sizes.append(np.diff(at) - 1)
                ids = ids[ids != self.between]
            else:
                sizes.append(np.array([len(ids)]))
            stores.append(ids)
        self.number.update(zip(joined + alone, range(len(self.number), len(self.number) + len(words))))
        self.store, self.size = np.concatenate(stores), np.concatenate(sizes)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])


@cache
def kept_words(path: str) -> Words:
    return Words(path)


def encode(texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (an Arrow string array without nulls) in a row, and the offsets of each text.

    In the vocabulary's pattern a token ends where letters or digits do, and
    single white space begins one; so a text without neighbouring white space
    is the sum of its parts split there, and each distinct part is encoded
    once. Texts with it are encoded whole.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    words = kept_words(path)
    unsafe = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
    marked = pc.if_else(pa.array(unsafe), "", texts)
    marked = pc.replace_substring(pc.replace_substring(marked, " ", "\0 "), "\n", "\0\n\0")
    parts = pc.split_pattern(pc.replace_substring_regex(marked, r"([\pL\pN])([^\pL\pN\x00])", "\\1\0\\2"), "\0")
    known = parts.values.dictionary_encode()
    number = words.numbers(known.dictionary.to_pylist())[known.indices.to_numpy(zero_copy_only=False)]
    n = words.size[number]
    end = np.concatenate([[0], np.cumsum(n)])
    flat = words.store[np.repeat(words.start[number] - end[:-1], n) + np.arange(end[-1])]
    offsets = end[parts.offsets.to_numpy()]
    if unsafe.any():
        whole = words.tokenizer.encode_batch(texts.filter(pa.array(unsafe)).to_pylist(), add_special_tokens=False)
        whole = {i: np.array(e.ids, np.int32) for i, e in zip(np.flatnonzero(unsafe).tolist(), whole)}
        each = [whole[i] if i in whole else flat[offsets[i]:offsets[i + 1]] for i in range(len(texts))]
        flat, offsets = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
    return flat, offsets


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the remainder first, then full ones."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 [, ids]) of every document."""

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in steps(batches, "t"):
            flat, offsets = encode(pc.fill_null(b.column("t"), ""), path)
            key, made = [], []
            for i, k in enumerate(b.column("k").to_pylist()):
                ids = np.append(flat[offsets[i]:offsets[i + 1]], np.int32(end)).astype("<u4")
                for p, (s, n) in enumerate(cut(len(ids), capacity)):
                    key.append(k)
                    made.append((p, s, n, zlib.crc32(ids[s:s + n].tobytes()), ids[s:s + n] if with_ids else None))
            columns = [pa.array(c) for c in list(zip(*made))[:4]] if made else [pa.array([], pa.int64())] * 4
            columns = [pa.array(key, b.schema.field("k").type), columns[0].cast(pa.int32()), *(c.cast(pa.int64()) for c in columns[1:])]
            if with_ids:
                columns.append(pa.array([m[4] for m in made], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        rows, f"doc_id {dict(docs.dtypes)[key]}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def places(fillings: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): of a length, ranks from the first on go to sequences from the first on."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for filling, bins in sorted(fillings, reverse=True):
        offset = 0
        for length in filling:
            rank = taken.get(length, 0)
            out.append((length, rank, sequence, offset))
            taken[length], offset = rank + bins, offset + length
        sequence += bins
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with doc_id, piece, length) with sequence_id and offset."""
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = places(pack_sizes(lengths, capacity))
    blocks = -(-sum(lengths.values()) // BLOCK_ROWS) or 1
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    ranked = dealt.withColumn("rank", F.row_number().over(W.partitionBy("block", "length").orderBy("doc_id", "piece", "start", "ids_crc32")))
    before = (dealt.groupBy("block", "length").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n"))

    def place(batches):
        import pyarrow as pa

        # One number per (length, rank): lengths are at most the capacity, ranks below 2 ** 48.
        first = (plan[:, 0] << 48) | plan[:, 1]
        for b in batches:
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(first, (b.column("length").to_numpy() << 48) | rank, "right") - 1
            columns = dict(zip(b.schema.names, b.columns)) | {
                "sequence_id": pa.array(plan[at, 2] + rank - plan[at, 1]), "offset": pa.array(plan[at, 3])}
            columns.pop("rank")
            yield pa.RecordBatch.from_pydict(columns)

    fields = [f"{c} {t}" for c, t in pieces.dtypes]
    return (ranked.join(before, ["block", "length"]).select(*pieces.columns, (F.col("rank") + F.col("before") - 1).alias("rank"))
            .mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"])))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with their ids: pieces joined in order; a group is one sequence."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda x: x["ids"])).alias("ids"))


def best_fit_packing(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(stored(token_pieces(docs, str(path), with_ids=with_ids), "token_pieces"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)
