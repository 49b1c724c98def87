"""Property checks of the exact hash-order operators against brute force."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from titlecorpus.operators import rank as rank_mod
from titlecorpus.operators.rank import HashOrder, hash_rank


def brute(ids, seed):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    return {i: r + 1 for r, i in enumerate(order)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 300), seed=st.integers(0, 10**6), data=st.data())
def test_cut_rank_and_rows_at(spark, monkeypatch, n, seed, data):
    monkeypatch.setattr(rank_mod, "_BUCKET_DIGITS", 1)
    monkeypatch.setattr(rank_mod, "_EXACT_LIMIT", 7)
    ids = data.draw(st.lists(st.integers(-10**9, 10**9), min_size=n, max_size=n, unique=True))
    k = data.draw(st.integers(0, n + 3))
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    ref = brute(ids, seed)
    order = HashOrder(df, "id", seed)
    assert order.count() == n
    assert {r.id for r in df.where(order.cut(k)).collect()} == {i for i, r in ref.items() if r <= k}
    assert {r.id: r["rank"] for r in hash_rank(df, "id", seed).collect()} == ref
    pos = data.draw(st.lists(st.integers(1, max(n, 1)), max_size=4))
    got = {r["rank"]: r.id for r in order.rows_at(pos).collect()}
    assert got == {r: i for i, r in ref.items() if r in set(pos)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 400), seed=st.integers(0, 1000), data=st.data())
def test_several_cuts_in_one_job(spark, monkeypatch, n, seed, data):
    monkeypatch.setattr(rank_mod, "_BUCKET_DIGITS", 1)
    monkeypatch.setattr(rank_mod, "_EXACT_LIMIT", data.draw(st.sampled_from([5, 10_000])))
    df = spark.range(n)
    ref = brute(list(range(n)), seed)
    ks = data.draw(st.lists(st.integers(-1, n + 2), min_size=1, max_size=4))
    order = HashOrder(df, "id", seed)
    for k, pred in zip(ks, order.cuts(ks)):
        assert {r.id for r in df.where(pred).collect()} == {i for i, r in ref.items() if r <= k}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(0, 400), min_size=1, max_size=4),
       split_bytes=st.sampled_from([512, 2048, 1 << 20]), keep_mod=st.integers(1, 4))
def test_file_order_numbering_after_filter(spark, tmp_path_factory, sizes, split_bytes, keep_mod):
    from pyspark.sql import functions as F
    from titlecorpus.operators.rank import file_order_rank, with_file_order
    d = tmp_path_factory.mktemp("lines")
    lines = []
    for f, n in enumerate(sizes):
        part = [f"f{f}-l{i:04d}" for i in range(n)]
        (d / f"part-{f:02d}.txt").write_text("".join(x + "\n" for x in part))
        lines += part
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        tagged = with_file_order(spark.read.text(str(d)))
        kept = tagged.where(F.substring("value", -1, 1).cast("int") % keep_mod == 0)
        ranked = file_order_rank(kept.withColumn("_row", F.monotonically_increasing_id()), "pos")
        got = [r.value for r in ranked.orderBy("pos").collect()]
        pos = sorted(r.pos for r in ranked.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [x for x in lines if int(x[-1]) % keep_mod == 0]
    assert got == expected and pos == list(range(1, len(expected) + 1))
