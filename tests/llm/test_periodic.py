"""Periodic runs: against the comparison of all words at all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from titlecorpus.llm import periodic


def brute_runs(w, shortest=12):
    """(start, period, length) of all runs."""
    n, best = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i - start >= p and i - start + p >= shortest:
                best.setdefault((start, i - start + p), p)
            i += 1
    return sorted((s, p, length) for (s, length), p in best.items())


def brute_digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if n and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, p, length in runs for i in range(s + p, s + length)}
    top = max(((length, -s, -p) for s, p, length in runs), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *((-top[1], top[0], -top[2], 1000 * top[0] // -top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{length},{p}\n" for s, p, length in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def words_with_runs(r):
    n, k = r.randint(1, 160), r.choice([1, 2, 2, 3, 5])
    w = [r.randrange(k) for _ in range(n)]
    if r.random() < 0.5:
        unit = w[:r.randint(1, max(1, n // 3))]
        w = (unit * n)[:n]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(n)] = 9
    return w


def tiled(w, core, fine):
    """Runs of ``w`` from its tiles, each searched alone; the fragments are stitched here word by word."""
    arr, held = np.array(w, np.int32), {}
    one = lambda x: np.array([x])
    for b, e, first, last, low, high in periodic.tiles_of(len(w), core, fine):
        _, period, x, y = periodic.fragments(arr[b:e], one(0), one(e - b), one(first - b), one(last - b), one(low), one(high))
        for p, i, j in zip(period.tolist(), x.tolist(), y.tolist()):
            held.setdefault(p, set()).update(range(b + i, b + j))
    best = {}
    for p in sorted(held):
        for i in sorted(held[p]):
            if i - 1 not in held[p]:
                j = i
                while j in held[p]:
                    j += 1
                if j - i >= max(p, 12 - p):
                    best.setdefault((i, j - i + p), p)
    return sorted((s, p, length) for (s, length), p in best.items())


@pytest.mark.parametrize("core, fine", [(8, 1), (16, 2), (32, 4), (64, 4), (8, 4), (periodic.CORE, periodic.FINE)])
def test_tiles_find_all_runs(core, fine):
    r = random.Random(core + fine)
    for _ in range(250):
        w = words_with_runs(r)
        assert tiled(w, core, fine) == brute_runs(w), w


def test_z_function():
    r = random.Random(5)
    for _ in range(200):
        s = [r.randrange(2) for _ in range(r.randint(0, 30))]
        want = [0] * min(len(s), 1) + [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))]
        assert periodic.z_function(s) == want


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    some = [x for x in rows if x[1] is None or len(x[1]) < 12000]
    assert len(some) > 0.9 * len(rows)
    got = sorted(tuple(r) for r in periodic.digest(spark.createDataFrame(some, "doc_id long, text string")).collect())
    assert got == sorted(brute_digest(*x) for x in some)
    whole = sorted(tuple(r) for r in periodic.digest(docs).collect())
    assert whole == sorted(tuple(r) for r in periodic.digest(docs, 64, 4).collect()) and len(whole) == len(rows)


def test_odd_texts(spark):
    unit = "a b c d e"
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, " ".join([unit] * 9)), (5, " ".join([unit] * 9)), (5, "x " * 40), (None, "y " * 30), (None, "y " * 30), (None, None),
            (6, "é ü\x1cz " * 13), (7, "w " * 5000 + "v " * 5000), (-8, "p q " * 6)]
    rows += [(i, " ".join(random.Random(i).choices("abcdefgh", k=90))) for i in ids] + [(ids[0], None), (ids[1], "only")]
    df = spark.createDataFrame([(*x, "a", 1, "b", "c") for x in rows], "doc_id long, text string, runs string, period int, _text string, tile string")
    key = lambda x: tuple((v is not None, v) for v in x)
    want = sorted((brute_digest(*x) for x in rows if x[0] != 7), key=key)
    assert sorted((tuple(r) for r in periodic.digest(df.where("doc_id is null or doc_id <> 7")).collect()), key=key) == want
    for core, fine in ((periodic.CORE, periodic.FINE), (64, 4)):
        long = periodic.digest(df.where("doc_id = 7"), core, fine).first()
        assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (2, 0, 5000, 1, 5000000)
        assert long.collapsed_sha256 == hashlib.sha256(b"w v").hexdigest()
    assert periodic.digest(df.limit(0)).count() == 0
    op = periodic.periodic_runs(df.where("doc_id = -8")).first()
    assert (op.runs[0].start, op.runs[0].length, op.runs[0].period, op.collapsed) == (0, 12, 2, "p q")
