"""Toxicity by cumulative-link ordinal regression over sparse word counts.

Grades 0 (clean) to 3: a text labelled clean has grade 0; one labelled toxic
has grade 1, 2 or 3 by how often markers occur in it (GRADE_STEPS). Markers
are words and beginnings of words whose presence goes with the toxic label (smoothed log odds
and their z score over a bounded labelled sample, near copies counted once).
The model P(grade >= k) = logistic(w.x - theta_k) shares the weights w between
the ordered thresholds theta; x holds each marker's count and rate (``features``). It gives
the expected severity, the sum of P(grade >= k); a text is toxic if grade 0 is
less likely than not.

Fitted on at most SAMPLE_LABELS labelled documents, chosen by a hash of their
id. Scoring reads every whole text.

Defined results: NULL and empty texts have no words and get the base rate.
Without labels, or with one class only, every severity is 0. Repeated rows
score alike; repeated labels of an id count as toxic if one of them is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import let, steps, stored, table

#: Bound of the labelled sample and of the vocabulary.
SAMPLE_LABELS, MARKERS = 10_000, 256
#: A marker is in so many sampled texts at least, with such log odds and z score.
MIN_TEXTS, MIN_LOG_ODDS, MIN_Z = 5, 1.5, 4.0
#: Marker occurrences (a word counts once for each of its markers) from which a toxic text has grade 2, 3.
GRADE_STEPS = (6, 18)
GAPS = r"[^\pL\pM\pN]+"
#: Kinds of marker and how many letters of a word they hold (0: all).
TAGS = {"w:": 0, "4:": 4, "5:": 5}


@dataclass
class Model:
    markers: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def of(self, text) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... of each text: a column each."""
        x = features(*counts(text, self.markers)) if self.markers else np.zeros((len(text), 0))
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds[None, :], -40, 40)))


def counts(text, markers: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of each marker in each text (an Arrow string array), a dense matrix of bounded width; words per text.

    A marker is a tag and a token: ``w:`` a word, ``4:`` and ``5:`` the first
    letters of a word.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(text, "")), GAPS)
    words, offsets = lists.values, lists.offsets.to_numpy()
    found = np.zeros((len(text), len(markers)), np.int64)
    for tag, cut in TAGS.items():
        columns = [i for i, m in enumerate(markers) if m.startswith(tag)]
        if columns:
            tokens = pc.utf8_slice_codeunits(words, 0, cut) if cut else words
            at = pc.index_in(tokens, value_set=pa.array([markers[i][len(tag):] for i in columns], pa.string()))
            hit = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
            place = at.take(pa.array(hit)).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.searchsorted(offsets, hit, "right") - 1
            found[:, columns] = np.bincount(row * len(columns) + place, minlength=len(text) * len(columns)).reshape(len(text), -1)
    return found, np.diff(offsets)


def features(n: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of each marker: the count and the count per hundred words, both as log2(1 + x)."""
    return np.log2(1.0 + np.concatenate([n, 100 * n / np.maximum(words, 1)[:, None]], axis=1))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the cumulative-link model, by full-batch Adam on the weighted likelihood."""
    k = len(GRADE_STEPS) + 1
    p = np.concatenate([np.zeros(x.shape[1]), [2.0], np.zeros(k - 1)])  # weights, first threshold, log gaps
    m = v = np.zeros_like(p)
    total = weight.sum()
    edge = np.arange(k + 2)[None, :] == grade[:, None]
    for step in range(1, rounds + 1):
        gaps = np.exp(p[x.shape[1] + 1:])
        theta = p[x.shape[1]] + np.concatenate([[0], np.cumsum(gaps)])
        over = 1 / (1 + np.exp(-np.clip((x @ p[:x.shape[1]])[:, None] - theta, -40, 40)))
        full = np.concatenate([np.ones((len(x), 1)), over, np.zeros((len(x), 1))], axis=1)
        chance = np.maximum((full[:, :-1] * edge[:, :-1] - full[:, 1:] * edge[:, :-1]).sum(1), 1e-12)
        slope = over * (1 - over)
        # d(log likelihood) / d(eta - theta_j): +1 where the grade starts at j, -1 where the next one does
        part = (edge[:, 1:k + 1].astype(float) - edge[:, :k]) * slope / chance[:, None] * weight[:, None]
        by_theta = -part.sum(0)
        grad = np.concatenate([x.T @ part.sum(1), [by_theta.sum()], [gaps[j] * by_theta[j + 1:].sum() for j in range(k - 1)]]) / total
        grad[:x.shape[1]] -= ridge * p[:x.shape[1]]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p + 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:x.shape[1]], p[x.shape[1]] + np.concatenate([[0], np.cumsum(np.exp(p[x.shape[1] + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_LABELS) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    chosen = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    row = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    # Near copies share the least hash of three words in a row nearly always: they are one voice in the counts.
    # (The least hash of single words is that of a common word, which most texts of a language share.)
    window = lambda ws, i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
    voice = let(row, lambda ws: F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - 3, F.lit(0))), lambda i: window(ws, i))))
    tagged = [f"transform(words, w -> '{tag}' || {f'left(w, {cut})' if cut else 'w'})" for tag, cut in TAGS.items()]
    tokens = F.expr(f"array_distinct(concat({', '.join(tagged)}))")
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("*", F.array_distinct(row).alias("words"), voice.alias("voice")), "toxicity_sample")
    voices = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.countDistinct("voice").alias("n")).collect()}
    none = Model([], np.zeros(0), np.full(len(GRADE_STEPS) + 1, 40.0))
    if len(voices) < 2 or not min(voices.values()):
        return none
    pos, neg = F.col("p") + 0.5, F.col("n") + 0.5
    odds = F.log(pos / (voices[1] - F.col("p") + 0.5)) - F.log(neg / (voices[0] - F.col("n") + 0.5))
    z = odds / F.sqrt(1 / pos + 1 / neg)
    marked = (sample.select(F.explode(tokens).alias("word"), "voice", "toxic").distinct()
              .groupBy("word").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
              .where((F.col("p") + F.col("n") >= MIN_TEXTS) & (odds >= MIN_LOG_ODDS) & (z >= MIN_Z))
              .orderBy(z.desc(), "word").limit(MARKERS))
    markers = sorted(r["word"] for r in marked.select("word").collect())
    if not markers:
        return none

    def rows(batches):
        import pyarrow as pa
        for b in steps(batches, "text"):
            n, words = counts(b.column("text"), markers)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), b.column("voice"), pa.array(words.astype(np.int32)), pa.array(list(n.astype(np.int32)), pa.list_(pa.int32()))],
                                             ["doc_id", "toxic", "voice", "words", "n"])

    # At most SAMPLE_LABELS rows of MARKERS counts; ordered, so that the fit repeats exactly.
    got = sample.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.coalesce("voice", F.lit(0)).alias("voice"), "text").mapInArrow(
        rows, "doc_id long, toxic int, voice long, words int, n array<int>").orderBy("doc_id", "n").toPandas()
    n = np.array(got["n"].tolist()).reshape(len(got), len(markers))
    grade = np.where(got["toxic"] == 1, 1 + np.searchsorted(GRADE_STEPS, n.sum(1), "right"), 0)
    weight = 1 / got.groupby(["voice", "toxic"])["doc_id"].transform("size").to_numpy(dtype=float)
    return Model(markers, *fit_ordinal(features(n, got["words"].to_numpy()), grade, weight))


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, expected_severity, severity, toxic) of every row of ``df``; severity is the highest grade likelier reached than not."""

    def rows(batches):
        import pyarrow as pa
        for b in steps(batches, "t"):
            over = model.of(b.column("t"))
            grade = (over >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(over.sum(1)), pa.array(grade.astype(np.int32)), pa.array(grade > 0)],
                                             ["k", "expected_severity", "severity", "toxic"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        rows, f"k {dict(df.dtypes)[key]}, expected_severity double, severity int, toxic boolean").withColumnRenamed("k", key)


def keep_clean(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of ``df`` that are not toxic, all columns as given."""

    def rows(batches):
        import pyarrow as pa
        for b in steps(batches, text):
            yield b.filter(pa.array(model.of(b.column(text))[:, 0] < 0.5))

    return df.mapInArrow(rows, df.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, fit(docs, table(spark, sf_dir, "labels")))
