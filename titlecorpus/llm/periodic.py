"""Periodic runs of words: maximal stretches that repeat with a smallest period.

Scales: a tile is a piece of a document's words that is searched for the
periods of some octaves [P, 2P). Fine octaves (P up to FINE) share tiles of
CORE words, each coarser octave has tiles of 8P words of its own; tiles overlap
by 2P words to the left and 4P to the right (for the smallest periods a little
more), so each is searched alone. In a
tile every multiple of P is a boundary: words that agree with those p further
on, for p of the octave, make a stretch of p words at least around a boundary,
and Z-functions to both sides of it tell how far the stretch reaches (2P words
or so at most each). Boundaries without any stretch are ruled out by a few words;
in octaves up to TOGETHER the Z-values of all boundaries are counted in lockstep.

A document's first tile is searched where its text is read; all other tiles
are dealt to tasks of their own. The fragments are shuffled by document and
period and those that touch are stitched; of equal stretches that several
periods give the smallest period counts, since the others are its multiples.

Defined results: words are split at ASCII white space. A NULL or empty text has
no words, no runs and an empty collapsed text. Rows equal in id and text are
one document with the same result each; a NULL id is an id. Only the named id
and text columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlecorpus.llm.common import steps, table

#: Words of a tile of the fine octaves, the largest of these, and words of a shortest run.
CORE, FINE, SHORTEST = 1 << 15, 1 << 11, 12
#: Word pairs compared at once, words of a boundary looked at before its Z-functions, and the largest octave whose boundaries advance together.
PAIRS, LOOKS, TOGETHER = 1 << 20, 8, 64
RUNS = "array<struct<start:long,length:long,period:long>>"


def z_function(s: list) -> list:
    """For each place of ``s`` how many elements from there on agree with its start."""
    n, z, left, right = len(s), [0] * len(s), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def agreeing(pattern: list, text: list) -> list:
    """For each place of ``text`` how many elements from there on agree with the start of ``pattern``."""
    return z_function([*pattern, None, *text])[len(pattern) + 1:]


def reach_of(octave: int) -> int:
    """Words that a stretch is followed to either side of a boundary: any that is long enough is then found long enough."""
    return max(2 * octave, SHORTEST)


def tiles_of(n: int, core: int, fine: int):
    """(begin, end, first, last, low, high): the tiles of a document of ``n`` words; boundaries lie in [first, last), octaves in low to high."""
    low, high, words = 1, fine, core
    while 2 * low <= n or low == 1:
        for first in range(0, n, words):
            yield max(0, first - reach_of(high)), min(n, first + words + reach_of(high) + 2 * high), first, min(n, first + words), low, high
        low = high = 2 * high
        words = 8 * high


def around(w: np.ndarray, c: int, begin: int, end: int, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, first, last) of the stretches of an octave's periods around boundary ``c`` of a tile."""
    n = min(octave, end - c - octave)
    reach = reach_of(octave)
    high = min(c + 2 * octave - 1, end)
    ahead = agreeing(w[c:min(c + reach, end)].tolist(), w[c + octave:min(high + reach, end)].tolist())[:n]
    back = agreeing(w[max(begin, c - reach):c][::-1].tolist(), w[max(begin, c + octave - reach):high][::-1].tolist()) if c > begin else [0] * (high - c)
    period = octave + np.arange(n)
    ahead, back = np.array(ahead, np.int64), np.array(back, np.int64)[high - c - period]
    fit = (ahead > 0) & (ahead + back >= np.maximum(period, SHORTEST - period))
    return period[fit], c - back[fit], c + ahead[fit]


def agreed(w: np.ndarray, a: np.ndarray, b: np.ndarray, edge: np.ndarray, octave: int, step: int) -> np.ndarray:
    """Z-values of short octaves, all in lockstep: how many words from ``a`` on equal those from ``b`` on, ahead (``step`` 1, ``b`` below ``edge``) or back (-1, ``a`` from ``edge`` on)."""
    count, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
    for k in range(reach_of(octave)):
        inside = b[open_] + k < edge[open_] if step > 0 else a[open_] - k >= edge[open_]
        open_ = open_[inside]
        open_ = open_[w[a[open_] + step * k] == w[b[open_] + step * k]]
        count[open_] += 1
    return count


def fragments(w: np.ndarray, begin, end, first, last, low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, x, y) of tiles that stand one after the other in ``w`` (places in ``w``): each word of [x, y) equals that a period on.

    ``y`` - ``x`` is the period at least; fragments of a tile that touch are one.
    """
    found = []
    octave = 1
    while octave <= high.max(initial=0):
        own = np.flatnonzero((low <= octave) & (octave <= high) & (end - begin >= max(2 * octave, SHORTEST)))
        count = -(-(last - first)[own] // octave)
        tile = np.repeat(own, count)
        c = first[tile] + (np.arange(len(tile)) - np.repeat(np.cumsum(count) - count, count)) * octave
        inside = c + octave < end[tile]
        tile, c = tile[inside], c[inside]
        step = max(1, PAIRS // octave)
        looks = np.unique(np.linspace(0, max(6, octave) // 2 - 1, LOOKS).astype(np.int64))
        for s in range(0, len(c), step):
            at, of = c[s:s + step], tile[s:s + step]
            there = at[:, None] + np.arange(octave, 2 * octave)[None, :]
            i, j = np.nonzero((w[np.minimum(there, len(w) - 1)] == w[at][:, None]) & (there < end[of][:, None]))
            # A stretch of that length reaches half of it to one side at least.
            a, b = at[i], there[i, j]
            ahead = np.arange(len(i))
            for k in looks[1:]:
                ahead = ahead[b[ahead] + k < end[of[i[ahead]]]]
                ahead = ahead[w[a[ahead] + k] == w[b[ahead] + k]]
            back = np.arange(len(i))
            for k in looks + 1:
                back = back[a[back] - k >= begin[of[i[back]]]]
                back = back[w[a[back] - k] == w[b[back] - k]]
            alive = np.union1d(ahead, back)
            if octave <= TOGETHER:
                p = b[alive] - a[alive]
                x = a[alive] - agreed(w, a[alive] - 1, b[alive] - 1, begin[of[i[alive]]], octave, -1)
                y = a[alive] + agreed(w, a[alive], b[alive], end[of[i[alive]]], octave, 1)
                fit = y - x >= np.maximum(p, SHORTEST - p)
                found.append((of[i[alive]][fit], p[fit], x[fit], y[fit]))
                continue
            for k in np.unique(i[alive]):
                p, x, y = around(w, int(at[k]), int(begin[of[k]]), int(end[of[k]]), octave)
                found.append((np.full(len(p), of[k]), p, x, y))
        octave *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    tile, period, x, y = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((y, x, period, tile))
    tile, period, x, y = tile[order], period[order], x[order], y[order]
    # Of one tile and period, fragments come in the order of both their ends.
    fresh = np.ones(len(tile), bool)
    fresh[1:] = (tile[1:] != tile[:-1]) | (period[1:] != period[:-1]) | (x[1:] > y[:-1])
    starts = np.flatnonzero(fresh)
    return tile[starts], period[starts], x[starts], y[np.append(starts[1:], len(y)) - 1] if len(starts) else y


def numbered_words(text) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word of an Arrow binary array of texts (equal words alike), and the offsets of the texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    words = [x.split() if x else [] for x in text.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
    flat = pa.array([y for x in words for y in x], pa.binary())
    return pc.dictionary_encode(flat).indices.to_numpy().astype(np.int32), offsets


SEARCHED = "doc_id {}, _text binary, period long, x long, y long, words binary, tile array<long>"


def searched(docs: DataFrame, core: int, fine: int) -> DataFrame:
    """Rows of SEARCHED: fragments of the documents' first tiles, and their other tiles with their words."""

    def rows(batches):
        import pyarrow as pa

        for b in steps(batches, "text"):
            w, offsets = numbered_words(b.column("text"))
            count = np.diff(offsets)
            ones = np.ones(len(count), np.int64)
            begin = offsets[:-1]
            over = reach_of(fine) + 2 * fine
            tile, period, x, y = fragments(w, begin, begin + np.minimum(count, core + over), begin, begin + np.minimum(count, core), ones, ones * fine)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").take(pa.array(tile)), b.column("_text").take(pa.array(tile)), pa.array(period), pa.array(x - begin[tile]), pa.array(y - begin[tile]),
                pa.nulls(len(tile), pa.binary()), pa.nulls(len(tile), pa.list_(pa.int64()))], ["doc_id", "_text", "period", "x", "y", "words", "tile"])
            for d in np.flatnonzero(count > min(core, 4 * fine - 1)):
                for t in list(tiles_of(int(count[d]), core, fine))[1:]:
                    empty = pa.nulls(1, pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        b.column("doc_id").slice(d, 1), b.column("_text").slice(d, 1), empty, empty, empty, pa.array([w[begin[d] + t[0]:begin[d] + t[1]].tobytes()], pa.binary()),
                        pa.array([list(t)], pa.list_(pa.int64()))], ["doc_id", "_text", "period", "x", "y", "words", "tile"])

    given = docs.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("_text"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(rows, SEARCHED.format(dict(docs.dtypes)["doc_id"]))


def stretches(docs: DataFrame, core: int, fine: int) -> DataFrame:
    """(doc_id, _text, period, x, y): all fragments."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches):
        import pyarrow as pa

        for b in batches:
            words = b.column("words").to_pylist()
            given = [k for k, x in enumerate(words) if x is None]
            yield b.select(["doc_id", "_text", "period", "x", "y"]).take(pa.array(given, pa.int64()))
            for k, x in enumerate(words):
                if x is not None:
                    t = b.column("tile")[k].as_py()
                    begin, end, first, last, low, high = (np.array([v]) for v in t)
                    _, period, x, y = fragments(np.frombuffer(x, np.int32), begin * 0, end - begin, first - begin, last - begin, low, high)
                    doc = pa.array(np.full(len(period), k))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(doc), b.column("_text").take(doc), pa.array(period), pa.array(x + t[0]), pa.array(y + t[0])],
                                                     ["doc_id", "_text", "period", "x", "y"])

    dealt = searched(docs, core, fine).repartition("doc_id", "_text", "tile", "period")
    return dealt.mapInArrow(rows, f"doc_id {kind}, _text binary, period long, x long, y long")


def runs(docs: DataFrame, core: int = CORE, fine: int = FINE) -> DataFrame:
    """(doc_id, _text, runs) of the documents (doc_id, text) that have runs, in order of start and period; ``_text`` is the MD5 of the text."""
    found = stretches(docs, core, fine)
    doc = ["doc_id", "_text"]
    before = Window.partitionBy(*doc, "period").orderBy("x", "y")
    reached = F.max("y").over(before.rowsBetween(Window.unboundedPreceding, -1))
    stretch = F.sum(F.when(F.col("x") <= F.col("reached"), 0).otherwise(1)).over(before.rowsBetween(Window.unboundedPreceding, 0))
    whole = found.withColumn("reached", reached).withColumn("stretch", stretch).groupBy(*doc, "period", "stretch").agg(F.min("x").alias("start"), F.max("y").alias("y"))
    long = whole.where(F.col("y") - F.col("start") >= F.greatest(F.col("period"), SHORTEST - F.col("period")))
    smallest = long.groupBy(*doc, "start", (F.col("y") - F.col("start") + F.col("period")).alias("length")).agg(F.min("period").alias("period"))
    inner = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return smallest.groupBy(*doc).agg(F.transform(inner, lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))


def periodic_runs(docs: DataFrame, core: int = CORE, fine: int = FINE) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of (doc_id, text): the words that no run holds after its first period, joined by a space."""

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in steps(batches, "text"):
            out = []
            found = b.column("runs")
            held = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
            for k, x in enumerate(b.column("text").to_pylist()):
                words = x.split() if x else []
                if held[k]:
                    some = found.slice(k, 1).flatten()
                    start, length, period = (pc.struct_field(some, f).to_numpy() for f in ("start", "length", "period"))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start + period, 1)
                    np.add.at(edge, start + length, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), found, pa.array(out, pa.binary())], ["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    named = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("_text"))
    found = runs(docs, core, fine).select(F.col("doc_id").alias("_id"), F.col("_text").alias("_found"), "runs")
    joined = named.join(found, named["doc_id"].eqNullSafe(found["_id"]) & (named["_text"] == found["_found"]), "left")
    collapsed = joined.select("doc_id", F.col("text").cast("binary").alias("text"), "runs").mapInArrow(rows, f"doc_id {kind}, runs {RUNS}, collapsed binary")
    return collapsed.select("doc_id", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), F.col("collapsed").cast("string").alias("collapsed"))


def repeating(documents: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, chosen by the CRC-32 of its id, goes on from some word with a period of its own."""

    def rows(batches):
        import pyarrow as pa

        for b in steps(batches, "text"):
            out = []
            for h, text in zip(b.column("h").to_pylist(), b.column("text").to_pylist()):
                words = text.split() if text and h is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    unit = words[a:a + p]
                    text = b" ".join((words[:a] + unit * -(-(n - a) // p))[:n])
                out.append(text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "text"])

    kind = dict(documents.dtypes)["doc_id"]
    given = documents.select("doc_id", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(rows, f"doc_id {kind}, text binary").select("doc_id", F.col("text").cast("string").alias("text"))


def digest(documents: DataFrame, core: int = CORE, fine: int = FINE) -> DataFrame:
    """The rows of the query from (doc_id, text)."""
    found = periodic_runs(repeating(documents), core, fine)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div (-top.period)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"))
